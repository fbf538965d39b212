"""Benchmark decontamination by winnowing.

A window is ``window`` consecutive words of a benchmark item; an item of
fewer words, but not none, is one window of its own length.  Every window
is named by a fingerprint: the smallest hash of its ``gram``-word grams.
Equal windows have equal fingerprints, so a span of ``window`` or more
words that a document shares with an item always shares one.

The documents are read once.  A task takes the minimum over each sliding
window, looks it up in a Bloom bitmap of the benchmark's fingerprints (16 MB at
most, whatever the benchmark's size; false hits cost only rows) and extends
hits to the whole window.  A join on (fingerprint, window words) with the
distinct windows of the benchmark then decides, so results are exact.  A
document window meets at most one distinct benchmark window: the join never
multiplies, however common a passage is.

Defined results: null or empty text has no words and no hits; an item of
several windows counts once; items without an id hit words but are not
listed; rows equal in doc_id and text get equal results; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellflux.llm.common import (
    LOWER, Roller, blocks, bloom, bloom_bits, byte_class, grams, in_bloom, materialise, prepare, same, table, text_bytes, text_key, words,
)

#: Words: runs of bytes that are not ASCII, or are letters and digits.
IS_WORD = byte_class(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + bytes(range(0x80, 0x100)))
WINDOW, GRAM = 10, 5
ROLL = Roller(7)

HIT = T.ArrayType(T.StructType([T.StructField("len", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("fp", T.LongType()), T.StructField("words", T.StringType())]))
HIT_ARROW = pa.list_(pa.struct([("len", pa.int32()), ("start", pa.int64()), ("fp", pa.int64()), ("words", pa.string())]))


def fingerprints(wh: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Of each window of ``length`` consecutive words: the smallest hash of its grams (winnowing)."""
    k = min(gram, length)
    g = grams(wh, k)
    n = len(g) - (length - k)
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = g[:n].copy()
    for j in range(1, length - k + 1):
        np.minimum(out, g[j : n + j], out=out)
    return out


def _windows(data: np.ndarray, bounds: np.ndarray, pick) -> tuple[np.ndarray, list[list]]:
    """Words per row, and per row the windows that ``pick(word count of the row, length, fingerprints)`` keeps.

    ``pick`` is called with None first, for the lengths to look at.
    """
    start, end, first = words(data, bounds, IS_WORD)
    wh = ROLL.spans(ROLL.prefix(data, LOWER), start, end)
    n_words = np.diff(first)
    out: list[list] = [[] for _ in n_words]
    row_of = np.repeat(np.arange(len(n_words)), n_words)
    for length in pick(None, None, None):
        fp = fingerprints(wh, length, GRAM)
        if not len(fp):
            continue
        row = row_of[: len(fp)]
        inside = row == row_of[length - 1 : length - 1 + len(fp)]
        for i in np.flatnonzero(inside & pick(n_words[row], length, fp)):
            text = b" ".join(LOWER[data[start[j] : end[j]]].tobytes() for j in range(i, i + length))
            out[row[i]].append({"len": length, "start": int(i - first[row[i]]), "fp": int(fp[i].astype(np.int64)), "words": text.decode("utf-8", "replace")})
    return n_words, out


def _scan(df: DataFrame, keep: list[T.StructField], pick_of) -> DataFrame:
    """Per row of ``df``: the columns ``keep``, n_words, and the windows kept (a list of HIT)."""
    names = [f.name for f in keep]

    def run(batches):
        pick = pick_of()
        for b in batches:
            data, bounds = text_bytes(b.column("text"))
            for i, j, d, o in blocks(data, bounds):
                n, hits = _windows(d, o, pick)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).slice(i, j - i) for c in names), pa.array(n, pa.int64()), pa.array(hits, HIT_ARROW)], names=[*names, "n_words", "hits"])

    return df.mapInArrow(run, T.StructType([*keep, T.StructField("n_words", T.LongType()), T.StructField("hits", HIT)]))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct windows of the benchmark: len, fp, words, items (ids as strings)."""

    def pick_of():
        def pick(n_words, length, _):
            if n_words is None:
                return range(1, WINDOW + 1)
            return np.full(len(n_words), True) if length == WINDOW else n_words == length
        return pick

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    got = _scan(items, [T.StructField("item", T.StringType())], pick_of)
    return got.select("item", F.explode("hits").alias("h")).groupBy("h.len", "h.fp", "h.words").agg(F.collect_set("item").alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, key (``text_key``), n_words, n_hit, items (sorted list of item ids as strings)."""
    spark = docs.sparkSession
    prepare(spark)
    bench = materialise(benchmark_windows(benchmark), "bench-windows")
    size = bench.agg(F.count("*").alias("n"), F.collect_set("len").alias("lens")).first()  # ten lengths at most
    bits = bloom_bits(size["n"])
    known = spark.sparkContext.broadcast(bloom(bench, "fp", bits))
    lengths = sorted(size["lens"])

    def pick_of():
        bitmap = known.value

        def pick(n_words, _, fp):
            return lengths if n_words is None else in_bloom(bitmap, fp)
        return pick

    rows = docs.select("doc_id", text_key().alias("key"), "text")
    scan = materialise(_scan(rows, [rows.schema["doc_id"], T.StructField("key", T.LongType())], pick_of), "doc-windows")
    hits = scan.where(F.size("hits") > 0).dropDuplicates(["doc_id", "key"]).select("doc_id", "key", F.explode("hits").alias("h")).select("doc_id", "key", "h.*")
    hits = hits.join(bench, ["len", "fp", "words"])
    # length of the union of the hit windows: what each adds past those that start before it
    until = F.max(F.col("start") + F.col("len")).over(W.partitionBy("doc_id", "key").orderBy("start", "len").rowsBetween(W.unboundedPreceding, -1))
    more = F.greatest(F.lit(0), F.col("start") + F.col("len") - F.greatest("start", F.coalesce(until, F.lit(0))))
    per = hits.select("doc_id", "key", "items", more.cast("long").alias("more")).groupBy("doc_id", "key").agg(
        F.sum("more").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    a, b = scan.drop("hits").alias("a"), per.alias("b")
    return a.join(b, same(F.col("a.doc_id"), F.col("b.doc_id")) & (F.col("a.key") == F.col("b.key")), "left").select(
        "a.doc_id", "a.key", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a word inside a benchmark window, with all their columns."""
    bad = contamination(docs, benchmark).where("n_hit > 0").select(F.col("doc_id").alias("__cf_id"), F.col("key").alias("__cf_key")).distinct()
    return docs.join(bad, same(F.col("doc_id"), F.col("__cf_id")) & (text_key() == F.col("__cf_key")), "left_anti")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH w AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), bl AS (
  SELECT id, ws, least(len(ws), 10) AS l FROM w WHERE side = 'b' AND len(ws) > 0
), bw AS (
  SELECT DISTINCT l, array_to_string(ws[i : i + l - 1], ' ') AS t, id AS item FROM (SELECT id, ws, l, unnest(range(1, len(ws) - l + 2)) AS i FROM bl)
), dl AS (
  SELECT w.id, w.ws, l.l FROM w, (SELECT DISTINCT l FROM bl) l WHERE w.side = 'd' AND len(w.ws) >= l.l
), dw AS (
  SELECT id, i, l, array_to_string(ws[i : i + l - 1], ' ') AS t FROM (SELECT id, ws, l, unnest(range(1, len(ws) - l + 2)) AS i FROM dl)
), hit AS (
  SELECT dw.id, dw.i, dw.l, bw.item FROM dw JOIN bw ON bw.l = dw.l AND bw.t = dw.t
), pos AS (
  SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(i, i + l)) AS p FROM hit) GROUP BY id
), its AS (
  SELECT id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item::VARCHAR, ',' ORDER BY item::VARCHAR) AS items FROM hit GROUP BY id
)
SELECT w.id AS doc_id, len(w.ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN pos USING (id) LEFT JOIN its USING (id) WHERE w.side = 'd'
"""
