import random
import re
from itertools import combinations

import numpy as np
import pytest

from cellflux.llm import minhash
from corpora import ODD, SF_SMALL, documents


def brute(rows, k):
    """doc_id -> (set size, component) by comparing all pairs; rows of one doc_id are one document."""
    sets = []
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append((d, frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])))
    up = {d: d for d, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, s), (b, t) in combinations([x for x in sets if x[0] is not None and x[1]], 2):
        if 100 * len(s & t) >= 80 * len(s | t):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return sorted(((d, len(s), root(d) if d is not None else None) for d, s in sets), key=str)


def ours(docs, k):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, k).collect()], key=str)


def families():
    """Originals with edited copies: linked to the original only, to each other, or not at all."""
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 10
    for edits in (0, 1, 4, 5, 6, 8, 12):
        base = [rng.choice(vocabulary) for _ in range(100)]
        ids = []
        for _ in range(25):
            t = list(base)
            for i in rng.sample(range(100), edits if ids else 0):
                t[i] = rng.choice(vocabulary)
            ids.append(n + rng.randrange(10**6))
            rows.append((ids[-1], " ".join(t)))
    # a text that grows by tenths: its ends are too far apart in size to be linked with one centre
    base = [rng.choice(vocabulary) for _ in range(400)]
    for i in range(12):
        rows.append((5000 + i, " ".join(base[: int(100 * 1.09**i)])))
    rows += [(10**7 + i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 9)))) for i in range(60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k", [2, 5])
def test_families(spark, k):
    rows = families() + ODD
    assert ours(documents(spark, rows), k) == brute(rows, k)


def test_small_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert ours(docs, 2) == brute(rows, 2)
    got = {r.doc_id: r.kept for r in minhash.op3(spark, SF_SMALL).collect()}
    assert got == {d: d == c for d, _, c in brute(rows, 2)}


def test_empty_table(spark):
    assert ours(documents(spark, [(1, "a")]).where("doc_id < 0"), 5) == []


def test_keep_one(spark):
    rows = families() + ODD
    docs = documents(spark, rows)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = [r.doc_id for r in kept.collect()]
    want = {c for _, _, c in brute(rows, 5) if c is not None}
    assert sorted(x for x in got if x is not None) == sorted(want)  # one row for each
    assert sum(x is None for x in got) == sum(d is None for d, _ in rows)


def test_densified_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    for n in (3, 40, 2000):
        x = rng.integers(0, 1 << 63, n, np.uint64)
        y = np.concatenate([x[: int(n * 0.9)], rng.integers(0, 1 << 63, n - int(n * 0.9), np.uint64)])
        j = len(set(x.tolist()) & set(y.tolist())) / len(set(x.tolist()) | set(y.tolist()))
        got = (minhash.signature(np.unique(x)) == minhash.signature(np.unique(y))).mean()
        assert abs(got - j) < 0.35 if n < 10 else abs(got - j) < 0.15
