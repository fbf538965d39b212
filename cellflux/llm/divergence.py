"""Source divergence audit: which terms a source says more often than its language, and how far sources are apart.

1. Count.  Tasks count every text's terms (numpy, one row for each term of a
   group and batch); the counts are dealt by (lang, term) once, summed for (lang, term,
   source), and those sums for (lang, term) in the same partitions.  Terms in
   fewer than ``MIN_DOCS`` documents of their language go.
2. Shares.  p = 1 + floor(10^9 (count + 5) / (N + 5 V)) by long division in
   64-bit steps: exact for up to 9 * 10^15 words.
3. Terms of a group.  p grows with the group's count and q with the language's,
   so a term is never ranked above another of the group with no smaller count
   there, no larger count in the language and an earlier UTF-8 form.  Each
   partition keeps the terms that fewer than ``TOP`` others dominate so (its
   skyband); the skybands are merged, first in slices of a group's terms, and
   what is left is ranked exactly by value.
4. Pairs of sources.  Sum of |p - q| over the terms that either source has,
   less |p0 - q0| (the shares of a count of 0) for each, plus V |p0 - q0|.
   The sums are taken in cells of about ``BLOCK_TERMS`` terms by two tiles of
   about ``TILE_SOURCES`` sources, whatever the numbers of terms and sources;
   a cell emits one row a pair, never one a pair and term.

No group is hot: after step 1 a group has at most one row a kept term, and a
cell or a slice holds a bounded number of rows.

Defined results: null text, lang and source count as ''; a group without terms
has pairs and no terms; a language without kept terms has pairs of value 0;
a lone source has no pairs; rows that repeat are documents of their own; ties
go by the item's UTF-8 bytes; texts are read whole, whatever their length; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellflux.llm.common import LOWER, byte_class, materialise, prepare, table, text_bytes, words

MIN_DOCS, TOP, PRIOR = 30, 50, 5
BLOCK_TERMS, TILE_SOURCES = 512, 128
SLICES = 16  # of a group's terms when skybands are merged
HELD = 1 << 18  # rows a task holds before it prunes its skybands
COMPARED = 512  # rows compared with a skyband at once

TERM = byte_class(bytes([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))


# ---------------------------------------------------------------------------
# counts
# ---------------------------------------------------------------------------

def term_counts(groups: list, text: pa.Array) -> list[tuple[list, pa.Array, np.ndarray, np.ndarray]]:
    """Of a batch of texts and their (lang, source): groups, terms, counts and numbers of documents, one of each a row."""
    data, bounds = text_bytes(text)
    s, e, at = words(data, bounds, TERM)
    if not len(s):
        return []
    low = LOWER[data]
    offsets = np.zeros(len(s) + 1, np.int64)
    np.cumsum(e - s, out=offsets[1:])
    terms = pa.Array.from_buffers(pa.large_binary(), len(s), [None, pa.py_buffer(offsets), pa.py_buffer(low[TERM[data]])]).dictionary_encode()
    n_terms = len(terms.dictionary)
    doc = np.repeat(np.arange(len(groups)), np.diff(at))
    pair, count = np.unique(doc * n_terms + terms.indices.to_numpy(), return_counts=True)  # (document, term)
    names = list(dict.fromkeys(groups))
    number = {g: i for i, g in enumerate(names)}
    of = np.array([number[g] for g in groups])
    key, inverse = np.unique(of[pair // n_terms] * n_terms + pair % n_terms, return_inverse=True)  # (group, term)
    total = np.bincount(inverse, count, len(key)).astype(np.int64)
    return [([names[i] for i in key // n_terms], terms.dictionary.take(pa.array(key % n_terms)), total, np.bincount(inverse, minlength=len(key)))]


def counted(docs: DataFrame) -> DataFrame:
    """lang, source, term, count, docs: sums of one batch in one row for each."""

    def run(batches):
        for b in batches:
            groups = list(zip(b.column("lang").to_pylist(), b.column("source").to_pylist()))
            for names, terms, count, n in term_counts(groups, b.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in names], pa.string()), pa.array([g[1] for g in names], pa.string()), terms.cast(pa.large_string()).cast(pa.string()), pa.array(count), pa.array(n.astype(np.int64))],
                    names=["lang", "source", "term", "count", "docs"])

    return docs.mapInArrow(run, "lang string, source string, term string, count long, docs long")


def share(count: Column, total: Column, v: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (total + 5 v)), exactly."""
    d = total + PRIOR * v
    p, rest = F.lit(0).cast("long"), count + PRIOR
    div = lambda a: F.call_function("div", a, d)
    p, rest = div(rest), rest % d
    for _ in range(3):
        p, rest = p * 1000 + div(rest * 1000), (rest * 1000) % d
    return p + 1


# ---------------------------------------------------------------------------
# skybands
# ---------------------------------------------------------------------------

def skyband(high: np.ndarray, low: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """The rows that fewer than k others dominate: no smaller ``high``, no larger ``low``, smaller ``place`` (distinct).

    Rows are taken in an order in which dominators come first.  A row with k
    dominators has k in the skyband (those of its dominators that come first),
    so comparing with the skyband so far and the rows beside it is exact.
    """
    order = np.lexsort((place, low, -high))
    kept_low, kept_place, kept = np.zeros(0, low.dtype), np.zeros(0, place.dtype), []
    for i in range(0, len(order), COMPARED):
        at = order[i : i + COMPARED]
        lo, pl = low[at], place[at]
        beside = (lo[None, :] <= lo[:, None]) & (pl[None, :] < pl[:, None]) & (np.arange(len(at))[None, :] < np.arange(len(at))[:, None])
        n = beside.sum(1) + ((kept_low[None, :] <= lo[:, None]) & (kept_place[None, :] < pl[:, None])).sum(1)
        good = n < k
        kept.append(at[good])
        kept_low, kept_place = np.concatenate((kept_low, lo[good])), np.concatenate((kept_place, pl[good]))
    return np.sort(np.concatenate(kept)) if kept else order


def skybands(rows: DataFrame, k: int) -> DataFrame:
    """The rows (lang, source, term, count, lang_count, value) in the skyband of their group's rows in the same partition."""

    def prune(held: pa.Table) -> pa.Table:
        both = pa.array([f"{a}\0{b}" for a, b in zip(held["lang"].to_pylist(), held["source"].to_pylist())]).dictionary_encode()
        group = both.indices.to_numpy()
        order = np.argsort(group, kind="stable")
        bounds = np.searchsorted(group[order], np.arange(len(both.dictionary) + 1))
        high, low = held["count"].to_numpy(), held["lang_count"].to_numpy()
        terms = np.array([t.encode() for t in held["term"].to_pylist()], object)
        keep = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            at = order[a:b]
            place = np.empty(len(at), np.int64)
            place[np.argsort(terms[at], kind="stable")] = np.arange(len(at))
            keep.append(at[skyband(high[at], low[at], place, k)])
        return held.take(pa.array(np.concatenate(keep)))

    def run(batches):
        held, least = [], HELD
        for b in batches:
            held.append(pa.table(b))
            if sum(t.num_rows for t in held) >= least:
                held = [prune(pa.concat_tables(held))]
                least = max(HELD, 2 * held[0].num_rows)
        if held and (all_ := pa.concat_tables(held)).num_rows:
            yield from prune(all_).combine_chunks().to_batches(max_chunksize=10_000)

    return rows.select("lang", "source", "term", "count", "lang_count", "value").mapInArrow(run, "lang string, source string, term string, count long, lang_count long, value long")


# ---------------------------------------------------------------------------
# pairs of sources
# ---------------------------------------------------------------------------

def cell_sums(cell: pa.Table) -> pa.Table:
    """Of a cell's rows (lang, i, j, source, tile, p0, term, p; term null: a source of the cell): a, b, p0_a, p0_b and their sum."""
    head = cell.filter(pa.compute.is_null(cell["term"]))
    rows = cell.filter(pa.compute.is_valid(cell["term"]))
    source, tile, p0 = head["source"].to_pylist(), head["tile"].to_numpy(), head["p0"].to_numpy()
    i, j = cell["i"][0].as_py(), cell["j"][0].as_py()
    left, right = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
    number = {s: k for k, s in enumerate(source)}
    terms = rows["term"].combine_chunks().dictionary_encode()
    share_of = np.repeat(p0[:, None], len(terms.dictionary), 1)
    share_of[[number[s] for s in rows["source"].to_pylist()], terms.indices.to_numpy()] = rows["p"].to_numpy()
    a, b, total = [], [], []
    for x in left:
        y = right[right > x] if i == j else right
        a.append(np.full(len(y), x))
        b.append(y)
        total.append(np.abs(share_of[y] - share_of[x]).sum(1) - share_of.shape[1] * np.abs(p0[y] - p0[x]))
    a, b, total = (np.concatenate(z).astype(np.int64) if z else np.zeros(0, np.int64) for z in (a, b, total))
    return pa.table({
        "lang": pa.array([cell["lang"][0].as_py()] * len(a), pa.string()), "a": pa.array([source[x] for x in a], pa.string()), "b": pa.array([source[x] for x in b], pa.string()),
        "p0_a": pa.array(p0[a]), "p0_b": pa.array(p0[b]), "more": pa.array(total)})


def pair_values(groups: DataFrame, kept: DataFrame, block_terms: int, tile_sources: int) -> DataFrame:
    """lang, source, item, value of every ordered pair of sources of a language.  groups: with v, sources, p0; kept: with p, p0, v, sources."""
    tiles = F.greatest(F.lit(1), F.ceil(F.col("sources") / tile_sources)).cast("int")
    n_blocks = F.greatest(F.lit(1), F.ceil(F.col("v") / block_terms)).cast("int")

    def cells(df: DataFrame) -> DataFrame:
        df = df.withColumn("tile", F.pmod(F.xxhash64("source"), tiles).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
        return df.select("lang", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "block", "source", "tile", "p0", "term", "p")

    head = groups.withColumn("block", F.explode(F.sequence(F.lit(0), n_blocks - 1))).withColumn("term", F.lit(None).cast("string")).withColumn("p", F.lit(None).cast("long"))
    rows = kept.withColumn("block", F.pmod(F.xxhash64("term"), n_blocks).cast("int"))
    sums = cells(head).unionByName(cells(rows)).groupBy("lang", "i", "j", "block").applyInArrow(cell_sums, "lang string, a string, b string, p0_a long, p0_b long, more long")
    pairs = sums.groupBy("lang", "a", "b").agg(F.max("p0_a").alias("p0_a"), F.max("p0_b").alias("p0_b"), F.sum("more").alias("more"))
    langs = groups.groupBy("lang").agg(F.max("v").alias("v"))
    pairs = pairs.join(langs, "lang").withColumn("value", F.col("more") + F.col("v") * F.abs(F.col("p0_a") - F.col("p0_b")))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return pairs.select("lang", both.alias("x"), "value").select("lang", "x.source", "x.item", "value")


# ---------------------------------------------------------------------------
# the audit
# ---------------------------------------------------------------------------

def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, block_terms: int = BLOCK_TERMS, tile_sources: int = TILE_SOURCES) -> DataFrame:
    """lang, source, part, item, value, rank: ``pair`` has every other source of the language, ``term`` the group's ``top`` terms."""
    prepare(docs.sparkSession)
    docs = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    by_group = counted(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")  # at most one row a source, already in one place
    kept = by_group.withColumn("lang_count", F.sum("count").over(of_term)).withColumn("docs", F.sum("docs").over(of_term)).where(F.col("docs") >= min_docs).drop("docs")
    kept = materialise(kept, "kept-terms")

    of_lang = kept.groupBy("lang", "term").agg(F.max("lang_count").alias("n")).groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("lang_total"))
    of_group = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = docs.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("__n")).drop("__n")
    sources = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    groups = groups.join(sources, "lang").join(of_lang, "lang", "left").join(of_group, ["lang", "source"], "left").na.fill(0, ["v", "lang_total", "total"])
    zero = F.lit(0).cast("long")
    groups = materialise(groups.withColumn("p0", F.when(F.col("v") > 0, share(zero, F.col("total"), F.col("v"))).otherwise(zero)), "groups")

    kept = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("count"), F.col("total"), F.col("v")))
    more = kept.withColumn("value", F.col("p") - share(F.col("lang_count"), F.col("lang_total"), F.col("v"))).where("value > 0")
    slices = skybands(more, top).repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(SLICES)))
    ranked = lambda item: F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), item))
    terms = skybands(slices, top).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", ranked("term").alias("rank")).where(F.col("rank") <= top)
    pairs = pair_values(groups, kept, block_terms, tile_sources)
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", ranked("item").alias("rank"))
    return pairs.unionByName(terms)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_count FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 30),
l AS (SELECT lang, count(*) AS v, sum(lang_count) AS lang_total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, k.term, k.lang_count, coalesce(c.n, 0) AS n
  FROM g JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (
  SELECT dense.*, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY dense.lang, source) + 5 * v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (lang_count + 5)) // (lang_total + 5 * v)::HUGEINT AS q
  FROM dense JOIN l ON dense.lang = l.lang),
far AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(far.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
x AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, p - q FROM s WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM x)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 50
"""
