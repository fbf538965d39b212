"""Shared helpers: shared-folder tables, Arrow text blocks, vectorised word hashing, bounded Bloom bitmaps."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflux.session import scratch_path

# Text handed to a Python worker at once, and worked on at once.  Both bound
# a task's memory; neither changes a result.
ARROW_ROWS = 1000
BLOCK_BYTES = 1 << 19

M64 = (1 << 64) - 1
ASCII_SPACE = bytes([0x20, *range(0x09, 0x0E)])


# ---------------------------------------------------------------------------
# tables
# ---------------------------------------------------------------------------

def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on: small Arrow batches, so that long texts stay within a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder in the shared checkpoint folder and read it back.

    Cuts the lineage at a table that every executor can read again, so a
    lost executor never repeats the work before it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cf_path = path
    return out


SALTS = 4096


def spread_join(rows: DataFrame, keys: list[str], by: str, totals: DataFrame) -> DataFrame:
    """Inner join of ``rows`` with ``totals``, which holds a key once; a key of very many rows is spread over tasks by ``by``.

    The totals meet one row for each (key, salt) that occurs, at most
    ``SALTS`` a key, and the rows meet those.  Null keys find nothing.
    """
    salted = rows.withColumn("__cf_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)))
    cells = salted.select(*keys, "__cf_salt").distinct().join(totals, keys)
    return salted.join(cells, [*keys, "__cf_salt"]).drop("__cf_salt")


def discard(df: DataFrame) -> None:
    """Delete a table of ``materialise`` that nothing reads any more."""
    path = getattr(df, "_cf_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def smallest(df: DataFrame, hash_: Column, size: int, *then: str) -> DataFrame:
    """At most ``size`` rows: those with the smallest hash (ties by the columns ``then``).

    Rows far above the place of the last one are left out before the sort,
    so about twice ``size`` rows reach its last task however many there are.
    """
    n = df.count()
    h = F.shiftrightunsigned(hash_, 1)
    df = df.withColumn("__cf_h", h)
    if n > 4 * size:
        df = df.where(F.col("__cf_h") < F.lit(int((1 << 63) * (2 * size / n + 64 / n))))
    return df.orderBy("__cf_h", *then).limit(size).drop("__cf_h")


def text_key() -> Column:
    """With doc_id, names a row of documents: rows equal in both are copies and get equal results."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.col("text").isNull())


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


# ---------------------------------------------------------------------------
# Arrow text -> byte blocks
# ---------------------------------------------------------------------------

def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array, and the n + 1 offsets of its rows in them (null: empty)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets * 0
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(data: np.ndarray, bounds: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of up to ``most`` bytes (a longer row alone): first row, row after the last, bytes, offsets."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + most, side="right")) - 1)
        yield i, j, data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
        i = j


# ---------------------------------------------------------------------------
# vectorised words and hashes
# ---------------------------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """Murmur3's 64-bit finaliser."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Roller:
    """Hashes of any spans of a byte block by prefix sums (polynomial over random byte codes, modulo 2**64)."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.code = rng.integers(0, M64, 256, np.uint64, endpoint=True)
        self.r = (int(rng.integers(0, M64, dtype=np.uint64, endpoint=True)) | 1) & M64
        self.inv = pow(self.r, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def __getstate__(self):
        return {"code": self.code, "r": self.r, "inv": self.inv}

    def __setstate__(self, s):
        self.__dict__.update(s)
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n + 1:
            n = max(n, BLOCK_BYTES)
            for name, base in (("up", self.r), ("down", self.inv)):
                a = np.full(n + 1, base, np.uint64)
                a[0] = 1
                setattr(self, name, np.cumprod(a, dtype=np.uint64))

    def prefix(self, data: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
        """``fold``: a byte table applied first (lower case)."""
        self.grow(len(data))
        code = self.code if fold is None else self.code[fold]
        h = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(code[data] * self.up[: len(data)], dtype=np.uint64, out=h[1:])
        return h

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (prefix[end] - prefix[start]) * self.down[start]
        return mix(x + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def byte_class(members: bytes, invert: bool = False) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(members)] = True
    return ~t if invert else t


NOT_SPACE = byte_class(ASCII_SPACE, invert=True)


def words(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every maximal run of word bytes (never across rows), and for each row the index of its first."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    m = is_word[data]
    before = np.zeros(n, bool)
    before[1:] = m[:-1]
    before[bounds[:-1][bounds[:-1] < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = m[1:]
    last = bounds[1:] - 1
    after[last[last >= 0]] = False
    start = np.flatnonzero(m & ~before)
    end = np.flatnonzero(m & ~after) + 1
    return start, end, np.searchsorted(start, bounds)


def grams(wh: np.ndarray, k: int, seed: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hash of every k consecutive word hashes (the caller drops those that cross rows)."""
    n = len(wh) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    g = wh[:n].copy()
    for j in range(1, k):
        g *= np.uint64(seed)
        g += wh[j : n + j]
    return mix(g)


# ---------------------------------------------------------------------------
# Bloom bitmaps of fixed size
# ---------------------------------------------------------------------------

BITMAP_BITS = 32768  # bits in one value of bitmap_construct_agg


def bloom_bits(n: int, per_key: int = 16, most_log2: int = 27) -> int:
    """Bits (a power of two, 64 KB to 16 MB): what is broadcast never exceeds 2**most_log2 bits, whatever n is."""
    return 1 << min(most_log2, max(19, math.ceil(math.log2(max(1, n) * per_key))))


def bloom(keys: DataFrame, col: str, bits: int) -> np.ndarray:
    """Two-probe Bloom bitmap of a long column: a bit array of ``bits`` bits, built by partial aggregates."""
    k = F.col(col)
    at = F.explode(F.array(k.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(k, 32).bitwiseAND(F.lit(bits - 1)))).alias("at")
    rows = (
        keys.select(at)
        .groupBy(F.bitmap_bucket_number(F.col("at") + 1).alias("b"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("at") + 1)).alias("bits"))
        .collect()  # bits / 32768 rows of 4 KB at most
    )
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        start = (r["b"] - 1) * BITMAP_BITS  # buckets count from 1, and value 1 has position 0
        got = np.flatnonzero(np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8), bitorder="little")) + start
        np.bitwise_or.at(out, got >> 3, (1 << (got & 7)).astype(np.uint8))
    return out


def in_bloom(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    mask = np.uint64(len(bitmap) * 8 - 1)
    out = np.ones(len(keys), bool)
    for at in (keys & mask, (keys >> np.uint64(32)) & mask):
        out &= (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out
