"""Mixing sources to target weights by hash-threshold histograms (DataFrame and SQL functions only).

Sources in order of code point (null last) weigh 1, 2, 3, 1, 2, 3, ... and
share the sum of all document sizes by weight.  No target exceeds
``MOST_REPEATS`` times its source's size; what is above goes to the other
sources by weight, until none is above.

A source with target r times its size takes every document floor(r) times
and a fraction more, picked by a hash of the document against a threshold,
so larger budgets take supersets of smaller ones.  The threshold comes from
histograms: sizes are summed by (source, hash digit); the bucket in which
the running sum meets the budget is refined by the next digit, and only that
bucket's documents are looked at again.  Nothing is sorted, and a hot source is
reduced to at most 4096 rows per task before the shuffle.

A threshold is put at the nearest sum that whole documents allow.  Equal
rows (doc_id and text) share a hash and go together.  The hash is an MD5
prefix, so reruns and SQL agree.

Defined results: null text has size 0 and is taken 0 words; a source of
size 0 has target 0; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellflux.llm.common import materialise, same, table

WEIGHTS, MOST_REPEATS = (1, 2, 3), 3
DIGIT_BITS, DIGITS = 12, 5  # 60 bits of hash


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hash60(doc_id: Column, text: Column) -> Column:
    """15 hex digits of MD5 as a number."""
    own = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(own), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target: one row per source (so the windows over all of them are small)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = W.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(every) - 1, F.lit(len(WEIGHTS)))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (turn + 1).cast("int")).cast("double")
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size").cast("double") * MOST_REPEATS)
    # Shares rise together until a cap stops one: in the order of cap / weight, the sources before some point
    # stop at their caps and the others share what is left by weight.
    total = F.sum("source_size").over(W.partitionBy())
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    per = per.withColumn("level", (total - before) / left)
    # the level is the first whose own share fits under its cap
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    per = per.withColumn("level", F.first(fits, ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    return per.select("source", "source_size", F.round(F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.lit(0.0)), 6).alias("target"))


def thresholds(sizes: DataFrame, target: DataFrame) -> DataFrame:
    """source, times (whole takes of every document), limit (documents with a smaller hash are taken once more)."""
    state = target.select(
        "source", F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)).cast("long").alias("times"),
        F.col("source_size"), "target",
    ).withColumn("budget", F.col("target") - F.col("times") * F.col("source_size")).select("source", "times", "budget", F.lit(0).cast("long").alias("prefix"))
    state = materialise(state.withColumn("open", F.col("budget") > 0), "mix-state")
    for level in range(DIGITS):
        low = DIGIT_BITS * (DIGITS - 1 - level)
        s, d = state.where("open").alias("s"), sizes.alias("d")
        inside = F.lit(True) if level == 0 else F.shiftright(F.col("d.hash"), low + DIGIT_BITS) == F.col("prefix")
        rows = d.join(s, same(F.col("d.source"), F.col("s.source")) & inside).select("s.source", "budget", F.shiftright("d.hash", low).alias("digit"), "size")
        hist = rows.groupBy("source", "budget", "digit").agg(F.sum("size").alias("size"))
        upto = F.sum("size").over(W.partitionBy("source").orderBy("digit"))
        hist = hist.select("source", "budget", "digit", "size", upto.alias("upto"))
        # the boundary bucket: the first at which the running sum reaches the budget
        edge = hist.where(F.col("upto") >= F.col("budget")).groupBy("source").agg(
            F.min("digit").alias("digit"), F.min(F.struct("digit", (F.col("budget") - F.col("upto") + F.col("size")).alias("rest"), "size")).alias("e"))
        edge = edge.select(F.col("source").alias("es"), "digit", F.col("e.rest").alias("rest"), F.col("e.size").alias("held"))
        got = state.join(edge, same(F.col("source"), F.col("es")), "left")
        nearest_up = F.col("rest") * 2 >= F.col("held")
        if level == DIGITS - 1:  # one hash value is left: it goes in if that is nearer
            after = F.when(F.col("digit").isNull(), F.lit(1 << DIGIT_BITS * DIGITS)).otherwise(F.col("digit") + nearest_up.cast("long"))
            new = got.select("source", "times", "budget", F.when(F.col("open"), after).otherwise(F.col("prefix")).alias("prefix"), F.lit(False).alias("open"))
        else:
            # no boundary (all that rounding left is above every sum): all documents
            goes = F.col("open") & F.col("digit").isNotNull()
            done = F.when(F.col("open"), F.lit(1 << DIGIT_BITS * DIGITS)).otherwise(F.col("prefix"))
            new = got.select("source", "times", F.when(goes, F.col("rest")).otherwise(F.col("budget")).alias("budget"), F.when(goes, F.col("digit")).otherwise(done).alias("prefix"), goes.alias("open"))
        state = materialise(new, "mix-state")
    return state.select("source", "times", F.col("prefix").alias("limit"))


def mix(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, hash, source, size, source_size, target, takes (how often), taken (words)."""
    sizes = docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), hash60(F.col("doc_id"), F.col("text")).alias("hash"))
    sizes = materialise(sizes, "mix-sizes")
    target = materialise(targets(sizes), "mix-targets")
    limit = thresholds(sizes, target)
    t, m, d = target.alias("t"), limit.alias("m"), sizes.alias("d")
    out = d.join(t, same(F.col("d.source"), F.col("t.source"))).join(m, same(F.col("d.source"), F.col("m.source")))
    takes = F.col("times") + (F.col("d.hash") < F.col("limit")).cast("long")
    return out.select("doc_id", "d.hash", "d.source", "size", "source_size", "target", takes.alias("takes"), (takes * F.col("size")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix with all their columns, each as often as the mix takes it."""
    plan = mix(docs).select(F.col("doc_id").alias("__cf_id"), F.col("hash").alias("__cf_hash"), F.col("source").alias("__cf_source"), F.col("takes").alias("__cf_takes"))
    plan = plan.where("__cf_takes > 0").dropDuplicates(["__cf_id", "__cf_hash", "__cf_source"])
    on = same(F.col("doc_id"), F.col("__cf_id")) & (hash60(F.col("doc_id"), F.col("text")) == F.col("__cf_hash")) & same(F.col("source").cast("string"), F.col("__cf_source"))
    cols = docs.columns
    return docs.join(plan, on).withColumn("__cf_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__cf_takes")))).select(*cols)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, '')))[1:15])::BIGINT AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w FROM d GROUP BY source
), fill AS (
  -- resharing in rounds: sources above their cap stop there, the rest share what is left
  SELECT 0 AS k, source, source_size, w, false AS stopped FROM s
  UNION ALL
  SELECT k + 1, source, source_size, w, stopped OR share > 3.0 * source_size FROM (
    SELECT *, w * (sum(source_size) OVER () - coalesce(sum(3.0 * source_size) FILTER (stopped) OVER (), 0)) / sum(w) FILTER (NOT stopped) OVER () AS share FROM fill
  ) WHERE k < 40
), t AS (
  SELECT source, source_size, round(CASE WHEN stopped THEN 3.0 * source_size
    ELSE w * (sum(source_size) OVER () - coalesce(sum(3.0 * source_size) FILTER (stopped) OVER (), 0)) / sum(w) FILTER (NOT stopped) OVER () END, 6) AS target
  FROM fill WHERE k = 40
), b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS times FROM t
), r AS (
  SELECT d.*, b.source_size, b.target, b.times, b.target - b.times * b.source_size AS budget,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto,
    sum(d.size) OVER (PARTITION BY d.source, d.h) AS held
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
  ((times + CASE WHEN budget > 0 AND (upto < budget OR upto - held < budget AND 2 * (budget - (upto - held)) >= held) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM r
"""
