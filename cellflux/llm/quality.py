"""Quality rules: in-document counts, and line frequency across the documents of a host.

A line (split at newline) is normalised: A-Z lower-cased, runs of ASCII
space made one, ends trimmed; lines without a word don't count.  For every
(host, line) the distinct documents that hold it are counted.  Copies must
not make a line look like boilerplate, so documents are told apart by a
digest of their whole normalised text, which copies share.  A line is
frequent in a host if at least ``MIN_DOCS`` distinct documents hold it, and
either more than ``SHARE`` of the host's or at least ``MANY_DOCS``: the limit
doesn't fade as hosts grow.  A
document that would lose more than ``DEPLETED`` of its words with its
frequent lines is rejected; one whose own counts fail is rejected anyway.
``accepted`` returns the kept documents with their frequent lines cut from
the text; the counts are those of the text before.

The texts are read once; (host, line) counts shuffle one row per document
and distinct line, reduced before the shuffle, so a host with a third of
all rows is no burden on one task.

Defined results: null or empty text has no words and fails; a null host is
a host of its own; rows equal in doc_id and text get equal verdicts; a text of
any length is one row of a task; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellflux.llm.common import (
    LOWER, NOT_SPACE, Roller, blocks, byte_class, grams, materialise, mix, prepare, same, table, text_bytes, text_key, words,
)

MIN_WORDS, MOST_REPEATED = 50, 50  # words; per cent of words in repeated 3-word windows
MIN_DOCS, MANY_DOCS, SHARE, DEPLETED = 20, 200, 0.1, 0.5
SYMBOLS = byte_class(b"#*$%&|<>")
HEAD = byte_class(bytes(range(0x80, 0xC0)), invert=True)  # first bytes of code points
NEWLINE = byte_class(b"\n", invert=True)
LOWER_TABLE = bytes(LOWER)
ROLL = Roller(5)

LINE = T.ArrayType(T.StructType([T.StructField("h", T.LongType()), T.StructField("n", T.LongType())]))
LINE_ARROW = pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())]))


def line_hash(line: bytes) -> int:
    """Of a normalised line: the first 8 bytes of its MD5 (the same in SQL)."""
    return int.from_bytes(hashlib.md5(b" ".join(line.translate(LOWER_TABLE).split())).digest()[:8], "big")


def counts(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray | list]:
    """Per row: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and its distinct lines (hash, words) and the digest of all of them in order."""
    rows = len(bounds) - 1
    start, end, first = words(data, bounds, NOT_SPACE)
    n_words = np.diff(first)
    prefix = ROLL.prefix(data)

    def per_row(mask):
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[bounds])

    word_chars = per_row(NOT_SPACE[data] & HEAD[data])
    n_symbols = per_row(SYMBOLS[data])

    row_of = np.repeat(np.arange(rows), n_words)
    g = grams(ROLL.spans(prefix, start, end), 3)
    inside = np.flatnonzero(row_of[: len(g)] == row_of[2:])
    g = mix(g[inside] + row_of[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, back, times = np.unique(g, return_inverse=True, return_counts=True)
    twice = np.zeros(len(start) + 2, bool)
    at = inside[times[back] > 1]
    for j in range(3):
        twice[at + j] = True
    n_repeat = np.diff(np.concatenate([[0], np.cumsum(twice[: len(start)])])[first])

    # lines with a word: those that hold the start of one
    ls, le, lfirst = words(data, bounds, NEWLINE)
    in_line = np.diff(np.searchsorted(start, np.append(ls, len(data))))
    full = in_line > 0
    raw = ROLL.spans(prefix, ls, le)
    n_dup, lines, digest = [], [], []
    for r in range(rows):
        own = np.arange(lfirst[r], lfirst[r + 1])[full[lfirst[r] : lfirst[r + 1]]]
        n_dup.append(len(own) - len(set(raw[own].tolist())))
        got: dict[int, int] = {}
        whole = hashlib.md5()
        for i in own:
            h = line_hash(data[ls[i] : le[i]].tobytes())
            whole.update(h.to_bytes(8, "big"))
            got[h] = got.get(h, 0) + int(in_line[i])
        lines.append([{"h": h - (1 << 64) if h >> 63 else h, "n": n} for h, n in got.items()])
        digest.append(int.from_bytes(whole.digest()[:8], "big", signed=True) if got else None)
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": np.array(n_dup, np.int64), "n_repeat_words": n_repeat, "lines": lines, "digest": digest}


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measured(docs: DataFrame, host: str) -> DataFrame:
    """Per row: doc_id, key, host, the counts, lines, digest (null without lines)."""
    rows = docs.select("doc_id", text_key().alias("key"), F.col(host).cast("string").alias("host"), "text")
    keep = ["doc_id", "key", "host"]

    def run(batches):
        for b in batches:
            data, bounds = text_bytes(b.column("text"))
            for i, j, d, o in blocks(data, bounds):
                got = counts(d, o)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).slice(i, j - i) for c in keep), *(pa.array(got[c], pa.int64()) for c in COUNTS), pa.array(got["lines"], LINE_ARROW), pa.array(got["digest"], pa.int64())],
                    names=[*keep, *COUNTS, "lines", "digest"])

    schema = T.StructType([*(rows.schema[c] for c in keep), *(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("lines", LINE), T.StructField("digest", T.LongType())])
    return rows.mapInArrow(run, schema)


def verdicts(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE, depleted: float = DEPLETED, many_docs: int = MANY_DOCS) -> DataFrame:
    """Per row: doc_id, key, the counts, n_frequent (words in its frequent lines), base_failed, kept."""
    return judged(docs, host, min_docs, share, depleted, many_docs).drop("cut")


def judged(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE, depleted: float = DEPLETED, many_docs: int = MANY_DOCS) -> DataFrame:
    """``verdicts``, and cut: the hashes of the row's frequent lines (null: none)."""
    prepare(docs.sparkSession)
    got = materialise(measured(docs, host), "quality")
    lines = got.select("doc_id", "key", "host", "digest", F.explode("lines").alias("l")).select("doc_id", "key", "host", "digest", "l.h", "l.n")
    of_host = got.where("digest IS NOT NULL").select("host", "digest").distinct().groupBy("host").agg(F.count("*").alias("docs"))
    of_line = lines.select("host", "h", "digest").distinct().groupBy("host", "h").agg(F.count("*").alias("held"))
    f = of_line.where(F.col("held") >= min_docs).alias("f")
    frequent = f.join(of_host.alias("o"), same(F.col("f.host"), F.col("o.host"))).where((F.col("held") > F.col("docs") * share) | (F.col("held") >= many_docs)).select(F.col("f.host").alias("fh"), F.col("h").alias("fl"))
    # one row for each distinct (doc_id, key), as equal rows have equal lines
    hit = lines.dropDuplicates(["doc_id", "key", "host", "h"]).join(frequent, same(F.col("host"), F.col("fh")) & (F.col("h") == F.col("fl")))
    hit = hit.groupBy(F.col("doc_id").alias("__cf_id"), F.col("key").alias("__cf_key"), F.col("host").alias("__cf_host")).agg(F.sum("n").alias("n_frequent"), F.collect_list("h").alias("cut"))
    out = got.drop("lines", "digest").join(hit, same(F.col("doc_id"), F.col("__cf_id")) & (F.col("key") == F.col("__cf_key")) & same(F.col("host"), F.col("__cf_host")), "left")
    out = out.withColumn("n_frequent", F.coalesce("n_frequent", F.lit(0)))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    kept = ~failed & (F.col("n_frequent") <= F.col("n_words") * depleted)
    return out.select("doc_id", "key", "host", *COUNTS, "n_frequent", failed.alias("base_failed"), kept.alias("kept"), "cut")


def without(texts: pa.Array, cuts: pa.Array) -> pa.Array:
    """Each text without the lines whose hashes are in its cut; the others stay in order, as they are."""
    out = []
    for t, cut in zip(texts.to_pylist(), cuts.to_pylist()):
        if t is not None and cut:
            gone = {h & ((1 << 64) - 1) for h in cut}
            t = b"\n".join(x for x in t.encode().split(b"\n") if not x.strip() or line_hash(x) not in gone).decode()
        out.append(t)
    return pa.array(out, pa.string())


def accepted(docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents that the rules keep, with all their columns; their texts without the frequent lines of their host."""
    # rows equal in doc_id, key and host have equal verdicts and lines
    touched = judged(docs, host).where("NOT kept OR cut IS NOT NULL").groupBy(F.col("doc_id").alias("__cf_id"), F.col("key").alias("__cf_key"), F.col("host").alias("__cf_host")).agg(
        F.first("kept").alias("__cf_kept"), F.first(F.when(F.col("kept"), F.col("cut"))).alias("__cf_cut"))
    on = same(F.col("doc_id"), F.col("__cf_id")) & (text_key() == F.col("__cf_key")) & same(F.col(host).cast("string"), F.col("__cf_host"))
    rows = docs.join(touched, on, "left").where(F.coalesce("__cf_kept", F.lit(True)))
    cut = F.col("__cf_cut")
    # only texts that lose a line go to Python
    shorter = F.arrow_udf(without, T.StringType())(F.when(cut.isNotNull(), F.col("text")), cut)
    return rows.withColumn("text", F.when(cut.isNull(), F.col("text")).otherwise(shorter)).select(*docs.columns)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "documents")).select("doc_id", *COUNTS, "base_failed", "kept")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), ln AS (
  SELECT doc_id, source, i, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n,
    md5(trim(regexp_replace(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ')) AS h
  FROM (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS l, unnest(range(1, len(string_split(t, chr(10))) + 1)) AS i FROM d)
), full_ln AS (
  SELECT * FROM ln WHERE n > 0
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup FROM full_ln GROUP BY doc_id
), g AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)
), g2 AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_rep FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g2) GROUP BY doc_id
), sk AS (
  SELECT doc_id, source, string_agg(h[1:16], '' ORDER BY i) AS s FROM full_ln GROUP BY doc_id, source
), hosts AS (
  SELECT source, count(DISTINCT s) AS docs FROM sk GROUP BY source
), held AS (
  SELECT f.source, f.h[1:16] AS h, count(DISTINCT sk.s) AS held FROM full_ln f JOIN sk USING (doc_id) GROUP BY f.source, f.h[1:16]
), frequent AS (
  SELECT held.source, h FROM held JOIN hosts ON held.source IS NOT DISTINCT FROM hosts.source WHERE held >= 20 AND (held > docs * 0.1 OR held >= 200)
), lost AS (
  SELECT f.doc_id, sum(f.n) AS n_lost FROM full_ln f JOIN frequent q ON q.source IS NOT DISTINCT FROM f.source AND q.h = f.h[1:16] GROUP BY f.doc_id
), c AS (
  SELECT d.doc_id, len(ws) AS n_words, coalesce(length(array_to_string(ws, '')), 0) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_rep, 0) AS n_repeat_words, coalesce(n_lost, 0) AS n_lost
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_lost <= n_words * 0.5 AS kept
FROM c
"""
