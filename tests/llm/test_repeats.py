import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cellflux.llm import repeats

from corpora import SF_SMALL, documents


def brute(rows, length):
    """(doc_id, n_bytes, n_removed, n_spans, kept sha256) of every row."""
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        out.append((d, len(t), sum(gone), runs, hashlib.sha256(bytes(x for x, y in zip(t, gone) if not y)).hexdigest()))
    return sorted(out, key=str)


def ours(docs, length, most):
    found = repeats.repeats(docs, length, most)
    cut = {(r.doc_id, r.key): (r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in repeats.cut(docs, found).collect()}
    return sorted([(r.doc_id, r.n_bytes, *cut.get((r.doc_id, r.key), (0, 0, r.sha))) for r in found.collect()], key=str)


def corpus():
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdé \n") for _ in range(700)) for _ in range(4)]
    rows = [(i, t) for i, t in enumerate(["", None, "x", "a" * 300, "ab" * 200, "the " * 120, "the " * 90 + "end", base[0], base[0], base[1] + base[1], "é" * 130, "\0" * 120 + "z"])]
    for i in range(40):  # near copies, and passages in other surroundings
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, 6)):
            t[rng.randrange(len(t))] = rng.choice("xyz")
        a = rng.randrange(300)
        rows.append((100 + i, "".join(t) if i % 2 else f"{i:05d}" * 9 + "".join(t)[a : a + rng.randint(90, 350)] + f"{i + 7:05d}" * 9))
    return rows + [(None, base[2]), (100, "other text of the same id"), (None, None)]


@pytest.mark.parametrize("most", [512, 2, 1])
def test_against_brute_force(spark, most):
    rows = corpus()
    assert ours(documents(spark, rows), 100, most) == brute(rows, 100)


@pytest.mark.parametrize("most", [512, 3])
def test_small_table(spark, most):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert ours(docs, 400, most) == brute(rows, 400)


def test_empty_table(spark):
    assert ours(documents(spark, [(1, "a")]).where("doc_id < 0"), 400, 512) == []


def test_query_columns(spark):
    got = repeats.op5(spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str) == brute(rows, 400)
    assert got.where(F.col("n_removed") > F.col("n_bytes")).count() == 0
