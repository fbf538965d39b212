"""Licence paragraphs: sparse word n-gram logistic regression, an unknown class, and templates that confirm (DataFrame and SQL functions only).

A paragraph is a sentence of a run of non-blank lines: line breaks inside the
run are spaces, and a full stop, question or exclamation mark before white
space ends it.  So a wrapped notice is judged whole, whatever its margins.
Words are runs of letters and digits, lower case.  Families and their fixed
template sentences: ``TEMPLATES``.

1. Labels.  The distinct paragraphs that hold whole sentences of exactly one
   family are labelled with it.  Ordinary paragraphs, ``none``, are the last
   ones of documents without a word of ``CUES``; those with one, and no
   template's sentence, are ``unknown`` licences.  At most ``SAMPLE`` of either
   kind (smallest hashes) train, beside the templates themselves and cues
   among ordinary words, so that no class lacks examples.
2. Features.  The words and word pairs of the templates and the cues.
3. Model.  Multinomial logistic regression (L2) on the sparse counts; applied
   by a join of the features with the weight table (its size is bounded by the
   templates' words) and a sum per paragraph and family.
4. Which paragraphs.  The commonest features can't beat ``none`` even together;
   texts without a word of any other feature are not cut up.  This follows from
   the model's weights and loses no finding.
5. Unknown.  A class of its own, trained as above.  On the held-out part of the sample the threshold is the smallest
   probability that keeps the share of wrong families under ``WRONG``.  A
   paragraph for which ``none`` is likeliest is no finding; one that is likeliest
   unknown, whose family stays below the threshold, or that no template of
   the family confirms, is ``unknown``: a licence, but none of these.
6. Confirmation.  A family is confirmed if the paragraph shares enough of the
   words of one of its templates (``CONFIRM`` of the template's distinct words).

Defined results: null or empty text has no paragraphs and no findings; a
paragraph that repeats in a text counts each time; rows equal in doc_id and
text get equal results; a text of any length is cut up whole; an empty table
gives no rows; extra columns are ignored; without training rows the templates
alone train.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflux.llm.common import materialise, prepare, same, smallest, table, text_key

#: Well-known licence sentences by family.
TEMPLATES = {
    "apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "mit": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "gpl-3": ["This work is licensed under the GNU General Public License, version 3."],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "bsd-3-clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "proprietary": ["All rights reserved."],
}
FAMILIES = sorted(TEMPLATES)
#: Words that licences of all kinds use and ordinary paragraphs hardly do.
CUES = ["licence", "license", "licensed", "licenses", "licensing", "sublicense", "copyright", "copyrighted", "copyleft", "spdx", "warranty", "warranties", "redistribution", "redistribute", "reserved", "royalty"]
SAMPLE, WRONG, CONFIRM = 4000, 0.01, 0.8


def tokens(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def features(words: list[str]) -> set[str]:
    """Words and word pairs."""
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))}


def vocabulary() -> list[str]:
    """The words and word pairs of the templates, and the cues: the features."""
    return sorted({x for ts in TEMPLATES.values() for t in ts for x in features(tokens(t))} | set(CUES))


def word_list(text) -> F.Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def holds(keys: list[str]) -> F.Column:
    """Whether one of these words (lower case) is among the text's words; the text is lowered and gone through once."""
    if not keys:
        return F.lit(False)
    first = "".join(sorted({k[0] for k in keys}))
    return F.rlike(F.lower("text"), F.lit(rf"(?<![\p{{L}}\p{{N}}])(?=[{first}])(?:{'|'.join(keys)})(?![\p{{L}}\p{{N}}])"))


def sentences(text) -> F.Column:
    """The paragraphs of a text, in order."""
    runs = F.regexp_replace(text, r"\n[ \t\r\x0B\f]*(?=\n)", "\n\n")  # a blank line is empty
    ends = F.regexp_replace(F.regexp_replace(runs, r"\n{2,}", "\u0001"), r"([.!?])\s+", "$1\u0001")
    return F.split(ends, "\u0001", -1)


def paragraphs(docs: DataFrame, keys: list[str]) -> DataFrame:
    """doc_id, key, at (which paragraph), text and words of the paragraphs that hold one of these words.

    The key is taken before the text is cut up, else each paragraph carries the whole text with it.  No text here is null,
    so the outer form gives the same rows; the plain one cuts every text twice more, to see that it has a paragraph.
    """
    line = F.posexplode_outer(sentences(F.col("text"))).alias("at", "text")
    rows = docs.where(holds(keys)).select("doc_id", text_key().alias("key"), "text").select("doc_id", "key", line)
    rows = rows.where(holds(keys))  # words are cut out of these only
    return rows.withColumn("words", word_list(F.col("text")))


# ---------------------------------------------------------------------------
# training (on the driver, on a bounded sample)
# ---------------------------------------------------------------------------

def grams(words) -> F.Column:
    """Words and word pairs, each once."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1))), lambda i: F.array_join(F.slice(words, i, F.lit(2)), " "))
    return F.array_distinct(F.concat(words, pairs))  # the last of the pairs is the last word alone


def sample_lines(docs: DataFrame, sample: int = SAMPLE) -> list[tuple[set[str], str, int]]:
    """(features, family or none, part) of at most ``sample`` labelled licence paragraphs and as many ``none`` paragraphs.

    Only features reach the driver.
    """
    stated = {" ".join(tokens(t)): f for f, ts in TEMPLATES.items() for t in ts}
    names = F.array(*map(F.lit, vocabulary()))
    flat = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    found = F.array_compact(F.array_distinct(F.array(*[F.when(F.contains(flat, F.lit(f" {t} ")), F.lit(f)) for t, f in stated.items()])))

    def collected(df, label):
        h = F.xxhash64("text")
        got = smallest(df.select(h.alias("h"), label.alias("family"), "text", "words"), F.col("h"), sample, "text")
        rows = got.select("h", "family", F.array_intersect(grams(F.col("words")), names).alias("x")).collect()
        return [(set(r["x"]), r["family"], r["h"] % 4) for r in rows]

    rare = sorted({max(t.split(), key=len) for t in stated})  # one word of each sentence
    known = paragraphs(docs, rare).dropDuplicates(["text"]).withColumn("f", found).where(F.size("f") == 1)
    known = materialise(known.select("text", "words", "f"), "licence-known")
    # the last paragraph of as many documents (those with the smallest hash): with a cue an unknown licence, else an ordinary one
    last = docs.where("text IS NOT NULL").select(F.element_at(sentences(F.col("text")), -1).alias("text"))
    rest = smallest(last, F.xxhash64("text"), sample, "text").withColumn("words", word_list(F.col("text")))
    rest = materialise(rest.where(F.size(found) == 0), "licence-rest")
    return collected(known, F.get("f", 0)) + collected(rest, F.when(F.arrays_overlap("words", F.array(*map(F.lit, CUES))), "unknown").otherwise("none"))


class Model:
    """weights: feature -> one weight for each family, unknown and none; threshold: probability for a family; keys: words without one of which none is likeliest."""

    def __init__(self, sample: list[tuple[set[str], str, int]]):
        none = [x for x, f, _ in sample if f == "none"]
        seen: dict[str, int] = {}
        for xs in none:
            for w in xs:
                seen[w] = seen.get(w, 0) + 1
        names = vocabulary()
        # templates always train; a single word that is no cue names no family; nor does an empty paragraph
        alone = sorted({w for n in names for w in n.split()} - set(CUES))
        rows = [(features(tokens(t)), f, 1) for f in FAMILIES for t in TEMPLATES[f]] * 5 + [({w}, "none", 1) for w in alone] + [(set(), "none", 1)] * 20 + sample
        # a cue speaks for a licence among any other words
        among = [set(), *sorted({frozenset(x) for x in none}, key=sorted)[:: max(1, len(none) // 40)], *(frozenset(alone[i::k]) for k in (1, 4, 12) for i in range(k))]
        rows += [({c, *x}, "unknown", 1) for c in CUES for x in among] * 9 + [(set(x), "none", 1) for x in among] * 9 * len(CUES)
        index = {n: i for i, n in enumerate(names)}
        self.classes = [*FAMILIES, "unknown", "none"]
        x = np.zeros((len(rows), len(names)), np.float32)
        for i, (xs, _, _) in enumerate(rows):
            x[i, [index[n] for n in xs if n in index]] = 1
        y = np.array([self.classes.index(f) for _, f, _ in rows])
        part = np.array([k for _, _, k in rows])
        # rows without features carry nothing but the bias
        w, b = softmax_fit(x[part != 0], y[part != 0], len(self.classes))
        b[:-1] = np.minimum(b[:-1], b[-1])  # a paragraph without features is ordinary
        self.weights = {n: w[i] for n, i in index.items()}
        self.bias = b
        # A class beats none if its features' margins over none sum to more than none's lead without features.  The commonest
        # features whose positive margins stay below every lead together can't do that alone, so a finding holds one of the others.
        lead, common = b[-1] - b[:-1], np.zeros(len(self.classes) - 1)
        self.keys = set()
        for n in sorted(names, key=lambda n: (-seen.get(n, 0), n)):
            margin = np.maximum(self.weights[n][:-1] - self.weights[n][-1], 0)
            if (common + margin <= lead).all():
                common += margin
            else:  # of a pair, the rarer word stands for both
                self.keys.add(min(n.split(), key=lambda v: (seen.get(v, 0), -len(v), v)))
        self.keys = sorted(self.keys)
        p = softmax(x[part == 0] @ w + b)
        self.threshold = calibrated(p, y[part == 0], len(FAMILIES))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def softmax_fit(x: np.ndarray, y: np.ndarray, classes: int, ridge: float = 1e-4, rounds: int = 3000, rate: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression by gradient steps with momentum; equal rows are taken together."""
    both, back = np.unique(np.hstack([x, y[:, None]]), axis=0, return_inverse=True)
    n = np.bincount(back.reshape(-1), minlength=len(both)).astype(float)
    n = np.sqrt(n)  # a line that thousands of documents repeat doesn't drown the others
    x, y = both[:, :-1].astype(float), both[:, -1].astype(int)
    target = np.eye(classes)[y]
    w, b = np.zeros((x.shape[1], classes)), np.zeros(classes)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(rounds):
        d = (softmax(x @ w + b) - target) * (n / n.sum())[:, None]
        vw = 0.9 * vw - rate * (x.T @ d + ridge * w)
        vb = 0.9 * vb - rate * d.sum(axis=0)
        w, b = w + vw, b + vb
    return w, b


def calibrated(p: np.ndarray, y: np.ndarray, families: int) -> float:
    """The smallest probability from 0.5 on at which at most ``WRONG`` of the held-out rows get a wrong family."""
    best, at = p[:, :families].max(axis=1, initial=0), p[:, :families].argmax(axis=1) if len(p) else np.zeros(0, int)
    for t in np.arange(0.5, 0.96, 0.05):
        if not len(p) or ((best >= t) & (at != y)).mean() <= WRONG:
            return float(t)
    return 0.95


# ---------------------------------------------------------------------------
# applying
# ---------------------------------------------------------------------------

def licence_paragraphs(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per licence paragraph: doc_id, key, at, family (or unknown), p, confirmed."""
    spark = docs.sparkSession
    prepare(spark)
    model = Model(sample_lines(docs, sample))
    lines = materialise(paragraphs(docs, model.keys).drop("text"), "licence-lines")
    words = F.col("words")
    every = lines.select("doc_id", "key", "at", F.explode(grams(words)).alias("gram"))
    table_ = spark.createDataFrame([(n, *map(float, w)) for n, w in model.weights.items()], "gram string, " + ", ".join(f"w{k} double" for k in range(len(model.classes))))
    score = every.join(F.broadcast(table_), "gram")  # as many rows as the templates have words and pairs, about
    score = score.dropDuplicates(["doc_id", "key", "at", "gram"]).groupBy("doc_id", "key", "at").agg(*[(F.sum(f"w{k}") + F.lit(float(model.bias[k]))).alias(f"z{k}") for k in range(len(model.classes))])
    z = [F.col(f"z{k}") for k in range(len(model.classes))]
    top = F.greatest(*z)
    total = sum((F.exp(c - top) for c in z[1:]), F.exp(z[0] - top))
    best = F.greatest(*z[:-1])
    family = F.coalesce(*[F.when(z[k] == best, F.lit(f)) for k, f in enumerate(FAMILIES)])
    score = score.where(best > z[-1])  # else it is an ordinary paragraph
    score = score.select("doc_id", "key", "at", family.alias("family"), (F.exp(best - top) / total).alias("p"))
    # templates: the share of a template's distinct words that the paragraph holds
    share = {f: F.greatest(F.lit(0.0), *[F.size(F.array_intersect(words, F.array(*map(F.lit, sorted(set(tokens(t))))))) / F.lit(float(len(set(tokens(t))))) for t in TEMPLATES[f]]) for f in FAMILIES}
    a, s = lines.dropDuplicates(["doc_id", "key", "at"]).alias("a"), score.alias("s")
    got = a.join(s, same(F.col("a.doc_id"), F.col("s.doc_id")) & (F.col("a.key") == F.col("s.key")) & (F.col("a.at") == F.col("s.at")))
    match = F.coalesce(*[F.when(F.col("family") == f, c) for f, c in share.items()])
    sure = (F.col("p") >= model.threshold) & (match >= CONFIRM)
    return got.select("a.doc_id", "a.key", "a.at", F.when(sure, F.col("family")).otherwise("unknown").alias("family"), "p", F.coalesce(sure, F.lit(False)).alias("confirmed"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_licence (confirmed paragraphs), n_unknown (licence paragraphs of no family), families (sorted, comma-joined)."""
    docs = table(spark, sf_dir, "documents")
    found = licence_paragraphs(docs).groupBy(F.col("doc_id").alias("__cf_id"), F.col("key").alias("__cf_key")).agg(
        F.sum(F.col("confirmed").cast("long")).alias("n_licence"), F.sum((~F.col("confirmed")).cast("long")).alias("n_unknown"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))), ",").alias("families"))
    rows = docs.select("doc_id", text_key().alias("key"))
    out = rows.join(found, same(F.col("doc_id"), F.col("__cf_id")) & (F.col("key") == F.col("__cf_key")), "left")
    return out.select("doc_id", F.coalesce("n_licence", F.lit(0)).alias("n_licence"), F.coalesce("n_unknown", F.lit(0)).alias("n_unknown"), F.coalesce("families", F.lit("")).alias("families"))
