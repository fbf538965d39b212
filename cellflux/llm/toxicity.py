"""Toxicity by a weighted finite-state grammar over clauses.

Four small transducers are composed: a lexicon that maps words to the
symbols insult, threat, target, negation and report (insults by weighted
word stems learned from labels, the others by fixed lists); a negation
machine, which marks the few words after a negation; a reported-speech
machine, which marks the rest of a clause after a verb of saying; and a
target machine, which looks for a person in the clause.  A clause is what
stands between clause marks.  Every insult or threat in a clause gives one
weighted match of a kind (plain, targeted, negated, reported insult; plain,
softened threat); a document's score is a logistic function of the matches
by kind, with arc weights fitted to labels.

Training uses labelled rows with crc32(doc_id as text) mod 4 other than 2
only, at most ``SAMPLE`` of them (those with the smallest hash of the id; a
bound on what reaches the driver).  Three quarters give the stems, by counts
of distinct texts that hold words with that stem; the other quarter the arc
weights, so stems that only fit the first part carry little weight.  Scores
depend on the text alone.

Defined results: null or empty text has no matches and scores as such; with
no labels of both kinds every score is the share of toxic ones (0 without
labels); a null doc_id is not held out and never trains; rows that repeat
are scored alike; extra columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellflux.llm.common import materialise, prepare, smallest, table

SAMPLE = 20_000
STEM, LEAST_DOCS, LEAST_SHARE, LEAST_ODDS = range(3, 13), 6, 0.02, 3.0  # stem lengths; toxic documents, share of them, and log odds that a stem needs
NEGATION_SPAN = 3  # words that a negation reaches
THRESHOLD = 0.3

#: Word lists of the grammar (English, German, Spanish, French).
THREATS = ["kill", "murder", "hurt", "destroy", "töten", "umbringen", "vernichten", "matar", "destruir", "tuer", "détruire"]
TARGETS = ["you", "your", "he", "she", "they", "him", "them", "du", "dich", "euch", "tú", "usted", "ustedes", "toi", "vous", "elles"]
NEGATIONS = ["not", "never", "without", "nicht", "kein", "keine", "nie", "nunca", "jamás", "sin", "jamais", "sans"]
REPORTS = ["said", "says", "wrote", "called", "quoted", "sagte", "schrieb", "nannte", "dijo", "escribió", "llamó", "disait", "écrit", "appelé"]

KINDS = ["insult", "targeted", "negated", "reported", "threat", "softened", "density"]  # the last: unsoftened matches in 100 words
WORD = re.compile(r"[^\W\d_]+|[.!?;:\n]")


class Grammar:
    """The composed transducers.  stems: insult stem -> weight."""

    def __init__(self, stems: dict[str, float]):
        self.stems = stems
        self.fixed = {w: s for s, ws in (("threat", THREATS), ("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS)) for w in ws}
        self.spotter = None

    def __getstate__(self):
        return {"stems": self.stems, "fixed": self.fixed, "spotter": None}

    def spots(self, text: str) -> bool:
        """Whether the (lower-case) text holds a stem or threat at all; most texts end here."""
        if self.spotter is None:
            import ahocorasick

            self.spotter = ahocorasick.Automaton()
            for w in [*self.stems, *THREATS]:
                self.spotter.add_word(w, len(w))
            self.spotter.make_automaton()
        for end, n in self.spotter.iter(text) if len(self.spotter) else ():
            if end == n - 1 or not text[end - n].isalpha():
                return True
        return False

    def symbol(self, word: str) -> tuple[str | None, float]:
        """Lexicon: a word's symbol and weight."""
        if word in self.fixed:
            return self.fixed[word], 1.0
        for n in STEM:
            if n > len(word):
                break
            if (w := self.stems.get(word[:n])) is not None:
                return "insult", w
        return None, 0.0

    def clause(self, symbols: list[tuple[str | None, float]]) -> list[tuple[str, float]]:
        """Negation, report and target machines over one clause: weighted matches (kind, weight)."""
        negated, reported, out = 0, False, []
        target = any(s == "target" for s, _ in symbols)
        for s, w in symbols:
            if s == "negation":
                negated = NEGATION_SPAN + 1
            elif s == "report":
                reported = True
            elif s in ("insult", "threat"):
                soft = "negated" if negated else "reported" if reported else None
                if s == "threat":
                    if target:  # a threat needs someone
                        out.append(("softened" if soft else "threat", w))
                else:
                    out.append((soft or ("targeted" if target else "insult"), w))
            negated = max(0, negated - 1)
        return out

    def matches(self, text: str | None) -> list[float]:
        """Weight of the matches of each kind in a text."""
        total = dict.fromkeys(KINDS, 0.0)
        low = (text or "").lower()
        if self.spots(low):
            symbols: list[tuple[str | None, float]] = []
            n = 0
            for m in WORD.finditer(low + "\n"):
                word = m.group()
                if word in ".!?;:\n":
                    for kind, w in self.clause(symbols):
                        total[kind] += w
                    n += len(symbols)
                    symbols = []
                else:
                    symbols.append(self.symbol(word))
            total["density"] = 100 * (total["insult"] + total["targeted"] + total["threat"]) / max(n, 1)
        return [math.log1p(total[k]) for k in KINDS]


# ---------------------------------------------------------------------------
# learning
# ---------------------------------------------------------------------------

def held_out() -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text, toxic, part (0 ... 3) of at most ``sample`` labelled rows that aren't held out."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = materialise(known.withColumn("turn", F.xxhash64(F.col("doc_id").cast("long"))), "toxic-labels")
    some = smallest(known, F.col("turn"), sample, "doc_id")  # so it may be broadcast
    return docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), "toxic", F.pmod("turn", F.lit(4)).cast("int").alias("part"))


def learn_stems(rows: DataFrame) -> dict[str, float]:
    """Insult stems with their log odds of standing in a toxic document."""
    rows = rows.dropDuplicates(["text"])
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return {}
    word = F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("word")
    per = rows.select("toxic", word).where("word <> ''").groupBy("word").agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg"))
    stem = F.explode(F.array(*[F.when(F.length("word") >= k, F.substring("word", 1, k)) for k in STEM])).alias("stem")
    per = per.select(stem, "pos", "neg").where("stem IS NOT NULL").groupBy("stem").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    odds = F.log((F.col("pos") + 0.5) / n[1]) - F.log((F.col("neg") + 0.5) / n[0])
    found = per.where(F.col("pos") >= max(LEAST_DOCS, LEAST_SHARE * n[1])).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    found = {r["stem"]: (r["pos"], r["odds"]) for r in found.orderBy(F.desc("pos"), "stem").collect()}  # of a bounded sample's words
    stems: dict[str, float] = {}
    for s in sorted(found, key=len):
        if any(s[:k] in stems for k in range(1, len(s))):
            continue
        # the longest continuation that nearly all of these words share says more than the shortest stem
        while (longer := [x for x in found if len(x) == len(s) + 1 and x.startswith(s) and found[x][0] >= 0.95 * found[s][0]]):
            s = longer[0]
        stems[s] = min(found[s][1], 8.0) / 4
    return stems


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 60) -> np.ndarray:
    """Logistic regression (Newton steps): the bias, then a weight for each column."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(a.shape[1])
    keep = np.full(a.shape[1], ridge)
    keep[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(keep) + 1e-9 * np.eye(len(w)), a.T @ (y - p) - keep * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Grammar, np.ndarray]:
    """The grammar with learned stems, and the arc weights (bias first)."""
    rows = materialise(training_rows(docs, labels, sample), "toxic-training")
    grammar = Grammar(learn_stems(rows.where("part > 0")))
    got = _matched(rows.where("part = 0").select("toxic", "text"), ["toxic"], grammar).collect()  # a quarter of the sample
    y = np.array([r["toxic"] for r in got], float)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        bias = math.log(share / (1 - share)) if 0 < share < 1 else 30.0 if share else -30.0
        return grammar, np.array([bias, *[0.0] * len(KINDS)])
    w = fit(np.array([r["matches"] for r in got]), y)
    return grammar, np.concatenate([w[:1], np.maximum(w[1:], 0.0)])  # no match makes a text less toxic than none


def _matched(rows: DataFrame, keep: list[str], grammar: Grammar) -> DataFrame:
    """The columns ``keep`` and the match weights by kind."""

    def run(batches):
        for b in batches:
            got = [grammar.matches(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(got, pa.list_(pa.float64()))], names=[*keep, "matches"])

    return rows.mapInArrow(run, T.StructType([*(rows.schema[c] for c in keep), T.StructField("matches", T.ArrayType(T.DoubleType()))]))


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row: doc_id, matches (weights by kind), score."""
    prepare(docs.sparkSession)
    grammar, w = learn(docs, labels, sample)
    got = _matched(docs.select("doc_id", "text"), ["doc_id"], grammar)
    z = F.lit(float(w[0]))
    for k in range(len(KINDS)):
        z = z + F.lit(float(w[k + 1])) * F.element_at("matches", k + 1)
    return got.withColumn("score", 1 / (1 + F.exp(-z)))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return got.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
