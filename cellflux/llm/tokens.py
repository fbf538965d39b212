"""Token ids in training order: fixed-stride binary shards.

1. Encode.  Every input partition is a token stream: its documents in order,
   each followed by the end-of-text id, cut into sequences of ``seq_len`` ids
   (the last one padded).  Sequences are written once, compressed, in blocks
   of a fixed number, with the place of every document that ends in a block.
2. Number.  Sequence counts per partition (one row each) give every
   partition its first sequence number, so sequences are numbered 0 ... n - 1.
3. Permute.  A keyed Feistel network on the next even number of bits,
   cycle-walked into [0, n), gives each sequence its global slot.
4. Write.  Sequences are dealt to shards of ``shard_slots`` slots by their
   slot, one task a shard; a shard is sorted and written in order.  Every
   record takes ``seq_len`` little-endian uint16 ids and a newline byte, so
   slot s starts at byte (s mod shard_slots) * (2 * seq_len + 1) of shard
   s div shard_slots: reads are sequential, and a reader resumes at any slot
   by a seek.

Texts are read and encoded once.  Between the steps sequences are kept
compressed (zstd), which keeps disk and shuffle below the size of the texts.
The blocks are a committed table, so numbers never depend on how partitions
would be cut again; shards go through Spark's writer, so a lost executor's
tasks are simply run again.

Tokens: byte-level BPE from a public vocabulary (path is a parameter).

Defined results: null or empty text is the end-of-text id alone; an empty
table gives no shards and no rows; rows that repeat are written as often;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellflux.llm.common import discard, materialise, prepare, table
from cellflux.session import scratch_path

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the word pattern that belongs to this vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEQ_LEN, SHARD_SLOTS = 2048, 2048
BLOCK_SEQUENCES, LEVEL = 256, 6  # sequences compressed together; zstd level
KEY = 0x5EED_0F_0DE5
ROUNDS = 6


# ---------------------------------------------------------------------------
# permutation
# ---------------------------------------------------------------------------

def permute(x: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The slots of sequence numbers x in [0, n): a bijection of [0, n)."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = np.random.default_rng(key).integers(0, 1 << 63, ROUNDS).astype(np.uint64)

    def once(v):
        left, right = v >> half, v & mask
        for k in keys:
            f = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(29)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f >> np.uint64(32)) & mask)
        return (left << half) | right

    out = once(x.astype(np.uint64))
    while (walk := np.flatnonzero(out >= n)).size:  # the domain is below 4n, so few walks are long
        out[walk] = once(out[walk])
    return out.astype(np.int64)


# ---------------------------------------------------------------------------
# tokens
# ---------------------------------------------------------------------------

class Encoder:
    """Texts to ids; the end-of-text id is the vocabulary's first free one."""

    def __init__(self, vocabulary: str):
        import base64

        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.end = len(ranks)
        bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.ids = lambda text: bpe.encode_ordinary(text) if text else []


def _part() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


BLOCKS = "part int, block long, n_sequences int, payload binary, docs array<struct<doc_id: {}, at: long, n_tokens: long>>"


def encoded(rows: DataFrame, vocabulary: str, seq_len: int) -> DataFrame:
    """Blocks of whole sequences of ``rows`` (doc_id, text): part, block, n_sequences, payload (compressed ids), docs.

    docs: the documents that end in the block, with their first token's place in the part's stream and their tokens (with the end).
    """
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import zstandard

        part, enc, pack = _part(), Encoder(vocabulary), zstandard.ZstdCompressor(level=LEVEL)
        held, docs, at, block = bytearray(), [], 0, 0
        full = 2 * seq_len * BLOCK_SEQUENCES
        doc_type = None

        def out(raw, ended):
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int64()), pa.array([len(raw) // (2 * seq_len)], pa.int32()), pa.array([pack.compress(raw)], pa.binary()),
                 pa.array([ended], pa.list_(pa.struct([("doc_id", doc_type), ("at", pa.int64()), ("n_tokens", pa.int64())])))],
                names=["part", "block", "n_sequences", "payload", "docs"])

        for b in batches:
            doc_type = b.column("doc_id").type
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                ids = np.array([*enc.ids(t), enc.end], "<u2")
                held += ids.tobytes()
                docs.append({"doc_id": d, "at": at, "n_tokens": len(ids)})
                at += len(ids)
                while len(held) >= full:
                    yield out(bytes(held[:full]), docs)
                    held, docs, block = held[full:], [], block + 1
        if held or docs:
            pad = -(len(held) // 2) % seq_len
            yield out(bytes(held) + np.full(pad, enc.end, "<u2").tobytes(), docs)

    return rows.mapInArrow(run, BLOCKS.format(kind))


def sequences(blocks: DataFrame, seq_len: int, first: dict[int, int], n: int, key: int) -> DataFrame:
    """slot, packed (the compressed ids of one sequence).  first: of each part, its first sequence number."""
    starts = blocks.sparkSession.sparkContext.broadcast(first)  # a number for each input partition

    def run(batches):
        import zstandard

        pack, unpack = zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()
        stride = 2 * seq_len
        for b in batches:
            for part, block, payload in zip(*(b.column(c).to_pylist() for c in ("part", "block", "payload"))):
                raw = unpack.decompress(payload)
                k = len(raw) // stride
                numbers = starts.value[part] + block * BLOCK_SEQUENCES + np.arange(k)
                packed = [pack.compress(raw[i * stride : (i + 1) * stride]) for i in range(k)]
                yield pa.RecordBatch.from_arrays([pa.array(permute(numbers, n, key), pa.int64()), pa.array(packed, pa.binary())], names=["slot", "packed"])

    return blocks.select("part", "block", "payload").mapInArrow(run, "slot long, packed binary")


def unpacked(dealt: DataFrame) -> DataFrame:
    """shard, slot, ids of dealt sequences."""

    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for i in range(0, len(b), 256):
                part = b.slice(i, 256)
                ids = pa.array([unpack.decompress(x) for x in part.column("packed").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("shard"), part.column("slot"), ids], names=["shard", "slot", "ids"])

    return dealt.select("shard", "slot", "packed").mapInArrow(run, "shard int, slot long, ids binary")


# ---------------------------------------------------------------------------
# shards
# ---------------------------------------------------------------------------

def write_shards(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, seq_len: int = SEQ_LEN, shard_slots: int = SHARD_SLOTS, key: int = KEY) -> DataFrame:
    """Writes ``path``/shard=k/ (one text-format file of fixed-stride records each) and returns the index of documents.

    One row per document: doc_id, n_tokens (with the end), n_sequences (that
    hold a token of it), slot (of the sequence of its first token), shard,
    byte (where that sequence starts in the shard), skip (tokens before the
    document in it).
    """
    spark = docs.sparkSession
    prepare(spark)
    blocks = materialise(encoded(docs.select("doc_id", "text"), vocabulary, seq_len), "token-blocks")
    of = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.sum("n_sequences").alias("n")).collect()}  # one row for each input partition
    first, n = {}, 0
    for p in sorted(of):
        first[p], n = n, n + of[p]
    index = materialise(blocks.select("part", F.explode("docs").alias("d")).select("part", "d.*"), "token-index")
    if n:
        shard = F.floor(F.col("slot") / shard_slots).cast("int")
        dealt = sequences(blocks, seq_len, first, n, key).withColumn("shard", shard).repartitionById(-(-n // shard_slots), F.col("shard"))
        raw = unpacked(dealt).sortWithinPartitions("shard", "slot")
        raw.select("shard", F.col("ids").cast("string").alias("value")).write.partitionBy("shard").text(path)
    discard(blocks)
    starts = spark.createDataFrame(list(first.items()), "part int, first long")
    out = index.join(starts, "part").withColumn("seq", F.col("first") + F.floor(F.col("at") / seq_len))

    def slots(batches):
        for b in batches:
            yield b.append_column("slot", pa.array(permute(b.column("seq").to_numpy(), n, key), pa.int64()))

    out = out.mapInArrow(slots, T.StructType([*out.schema.fields, T.StructField("slot", T.LongType())]))
    return out.select(
        "doc_id", "n_tokens", (F.floor((F.col("at") + F.col("n_tokens") - 1) / seq_len) - F.floor(F.col("at") / seq_len) + 1).cast("long").alias("n_sequences"),
        "slot", F.floor(F.col("slot") / shard_slots).cast("long").alias("shard"), (F.pmod("slot", F.lit(shard_slots)) * (2 * seq_len + 1)).cast("long").alias("byte"),
        F.pmod("at", F.lit(seq_len)).cast("long").alias("skip"))


def read_slots(shard_file: str, seq_len: int = SEQ_LEN, first: int = 0) -> np.ndarray:
    """The sequences of a shard from the ``first``-th on (a local copy of the file): one row each."""
    raw = np.fromfile(shard_file, np.uint8, offset=first * (2 * seq_len + 1))
    return np.ascontiguousarray(raw.reshape(-1, 2 * seq_len + 1)[:, :-1]).view("<u2")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_shards(table(spark, sf_dir, "documents"), scratch_path(spark, "shards"))
