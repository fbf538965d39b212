"""URL rules by Bloom filter cascades: exact membership without joining pages to lists.

A rule is (verdict, host, path).  It fits a url whose host is the rule's or a
subdomain of it and whose path starts with the rule's; of the rules that fit,
the longest (host and path together; at a tie the longer host) decides.  So
a url has a bounded set of keys that could be listed: its host's suffixes at
label borders, each with those beginnings of its path whose lengths occur
among the rules.

For the keys of a list, a cascade of Bloom bitmaps is built over the distinct
keys of the whole corpus: the first holds the listed keys, the second those
other keys of the corpus that the first lets through, the third the listed
keys that the second lets through, and so on until a level would be empty.  A
key of the corpus is listed just if the number of levels in a row that hold it
is odd, so verdicts have no false hits and no misses.  Pages are then judged
in passes with no shuffle.

Each bitmap has 2**27 bits at most, whatever the list's size.  Keys are dealt
by their hash to as many parts as the list has times ``MOST_KEYS`` keys, each
with cascades of its own; a pass judges the keys of one part and keeps the
longest listed so far, so the bitmaps of one part are all that is broadcast
at a time.  A list of up to ``MOST_KEYS`` is one part and one pass.

Defined results: a null url or one without ``://`` has an empty host and
path; without a fitting rule the verdict is ``allow`` and the rule null; rows
that repeat are judged alike; a url of any length is judged whole; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellflux.llm.common import bloom, bloom_bits, in_bloom, materialise, prepare, table

DEFAULT = "allow"
MOST_KEYS = 1 << 23  # listed keys in one part
PART_SHIFT = 40  # the hash's bits above choose the part
#: The rules of the registered query (fixed by its contract).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def host(url: Column) -> Column:
    got = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(got, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def keys(lengths: list[int]) -> Column:
    """The keys (text, two hashes) of the columns host and path, the longest first."""
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    def key(s):
        return F.transform(starts, lambda n: F.struct((-F.length(s) - n).alias("size"), (-F.length(s)).alias("hs"), F.concat(s, F.substring(F.col("path"), F.lit(1), n)).alias("key")))
    every = F.array_sort(F.flatten(F.transform(suffixes, key)))
    return F.transform(every, lambda k: F.struct(k["key"].alias("key"), F.xxhash64(k["key"]).alias("h1"), F.xxhash64(F.lit(1), k["key"]).alias("h2")))


def level_hash(h1, h2, level: int):
    """An own hash of a key for every level: h1 xor h2 rotated (of numpy arrays, or Columns)."""
    r = (7 * level + 1) % 64
    if isinstance(h1, np.ndarray):
        return h1 ^ ((h2 << np.uint64(r)) | (h2 >> np.uint64(64 - r)))
    return h1.bitwiseXOR(F.shiftleft(h2, r).bitwiseOR(F.shiftrightunsigned(h2, 64 - r)))


def build(universe: DataFrame, listed: str, per_key: int = 16, least_log2: int = 19) -> list[np.ndarray]:
    """The bitmaps of a cascade for the keys of ``universe`` (h1, h2) where the column ``listed`` is true."""
    spark = universe.sparkSession
    levels: list[np.ndarray] = []
    inside, outside = universe.where(F.col(listed)).select("h1", "h2"), universe.where(~F.col(listed)).select("h1", "h2")
    n = inside.count()
    while n:
        k = len(levels)
        bits = max(64, bloom_bits(n, per_key, 27) if least_log2 == 19 else 1 << least_log2)
        levels.append(bloom(inside.select(level_hash(F.col("h1"), F.col("h2"), k).alias("h")), "h", bits))
        known = spark.sparkContext.broadcast(levels[-1])

        def through(batches, known=known, k=k):
            for b in batches:
                h1, h2 = (b.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
                yield b.filter(pa.array(in_bloom(known.value, level_hash(h1, h2, k))))

        inside, outside = materialise(outside.mapInArrow(through, outside.schema), "cascade"), inside
        n = inside.count()
    return levels


def member(levels: list[np.ndarray], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether keys of the cascade's universe are listed."""
    out, at = np.zeros(len(h1), bool), np.arange(len(h1))
    for k, bitmap in enumerate(levels):
        at = at[in_bloom(bitmap, level_hash(h1[at], h2[at], k))]
        out[at] = k % 2 == 0
    return out


def judged(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", most_keys: int = MOST_KEYS, per_key: int = 16, least_log2: int = 19) -> DataFrame:
    """Per row: the id, host, path, rule (null: none), verdict.  rules: verdict, host, path."""
    spark = pages.sparkSession
    prepare(spark)
    # a path that starts otherwise fits no url; a rule listed both ways blocks
    rules = rules.where("path = '' OR path LIKE '/%'").groupBy(F.concat("host", "path").alias("key"), F.length("path").alias("n")).agg(F.max("verdict").alias("verdict"))
    rules = materialise(rules, "rules")
    lengths = sorted(r["n"] for r in rules.select("n").distinct().collect())  # path lengths: as many as the longest path has characters
    verdicts = sorted(r["verdict"] for r in rules.select("verdict").distinct().limit(3).collect())
    if set(verdicts) - {"allow", "block"}:
        raise ValueError("verdicts are allow or block")
    rows = pages.select(F.col(id_column).alias("id"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rows = rows.withColumn("keys", keys(lengths))
    universe = rows.select(F.explode("keys").alias("k")).select("k.key", "k.h1", "k.h2").distinct()
    universe = universe.join(rules.select("key", "verdict"), "key", "left").select("h1", "h2", *[F.coalesce(F.col("verdict") == v, F.lit(False)).alias(v) for v in verdicts])
    universe = materialise(universe, "url-keys")
    parts = max(1, -(-rules.count() // most_keys))
    keys_type, id_type, text, whole = rows.schema["keys"], rows.schema["id"].dataType, T.StringType(), T.LongType()
    state = rows.select("id", "host", "path", "keys", F.lit(-1).cast("long").alias("best"), F.lit(DEFAULT).alias("verdict"))
    for part in range(parts):
        mine = universe.where(F.pmod(F.shiftrightunsigned("h1", PART_SHIFT), F.lit(parts)) == part)
        cascades = spark.sparkContext.broadcast({v: build(mine, v, per_key, least_log2) for v in verdicts})
        last = part == parts - 1
        names = [(id_column, id_type), ("host", text), ("path", text), *([("rule", text)] if last else [("keys", keys_type.dataType), ("best", whole)]), ("verdict", text)]
        state = state.mapInArrow(_pass(cascades, part, parts, [n for n, _ in names], last), T.StructType([T.StructField(*f) for f in names]))
        if not last:
            state = materialise(state.withColumnRenamed(id_column, "id"), "url-pass")
            cascades.unpersist()
    return state


def _pass(cascades, part: int, parts: int, names: list[str], last: bool):
    """Judges the keys of one part: keeps each row's longest listed key (its place in ``keys``) and that one's verdict."""

    def run(batches):
        for b in batches:
            every = b.column("keys")
            flat = every.flatten()
            size = every.value_lengths().to_numpy()
            begin = np.cumsum(size) - size
            row = np.repeat(np.arange(len(b)), size)
            h1, h2 = (flat.field(c).to_numpy().view(np.uint64) for c in (1, 2))
            mine = np.flatnonzero((h1 >> np.uint64(PART_SHIFT)) % np.uint64(parts) == part)
            best = b.column("best").to_numpy().copy()
            verdict = np.array(b.column("verdict").to_pylist(), object)
            for v, levels in cascades.value.items():
                hit = mine[member(levels, h1[mine], h2[mine])]
                first = hit[np.flatnonzero(np.diff(row[hit], prepend=-1))]  # the longest listed key of each row
                at = first - begin[row[first]]
                sooner = (best[row[first]] < 0) | (at < best[row[first]])
                best[row[first[sooner]]] = at[sooner]
                verdict[row[first[sooner]]] = v
            if last:
                found = [flat.field(0).take(pa.array(np.where(best < 0, 0, begin + best), pa.int64(), mask=best < 0))]
            else:
                found = [every, pa.array(best, pa.int64())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("id", "host", "path")), *found, pa.array(verdict, pa.string())], names=names)

    return run


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "verdict string, host string, path string"))


ORACLE = r"""
WITH u AS (
  SELECT row_number() OVER () AS k, page_id,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rules(verdict, rh, rp) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fit AS (
  SELECT k, rh || rp AS rule, verdict, row_number() OVER (PARTITION BY k ORDER BY length(rh || rp) DESC, length(rh) DESC) AS n
  FROM u JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN (SELECT * FROM fit WHERE n = 1) f USING (k)
"""
