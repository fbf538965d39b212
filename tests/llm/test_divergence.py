import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cellflux.llm import divergence

from corpora import SF_SMALL

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, top):
    """The audit by its definition, over rows (lang, source, text)."""
    counts, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source, found = lang or "", source or "", TERM.findall((text or "").translate(LOW))
        groups[lang].add(source)
        counts[lang, source].update(found)
        df[lang].update(set(found))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        v = len(kept)

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * v) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, rank + 1) for rank, (value, item) in enumerate(items[:most])]
    return sorted(out)


def corpus(n=400, seed=7):
    r = random.Random(seed)
    lexicon = {l: [f"{l}{r.choice('aeiouéüñ')}{i}x{chr(97 + i % 26)}".replace(str(i), "bcdfghklmn"[i % 10] * (1 + i // 10 % 4)) for i in range(150)] for l in ("en", "fr")}
    rows = []
    for i in range(n):
        lang = r.choice(["en", "en", "fr", None])
        source = r.choice(["s0"] * 5 + ["s1", "s2", "é", "Z", "z", None, "\U0001f600"])
        words = lexicon.get(lang, ["solo"])
        shift = hash_of(source)
        rows.append((lang, source, " ".join(words[int(r.paretovariate(0.7) * (1 + shift)) % len(words)] for _ in range(r.randint(0, 60))) + r.choice(["", ".", " The THE the 12", " É é"])))
    rows += [("en", "s0", None), ("en", "empty", ""), ("xx", "only", "few words"), ("yy", "a", "nothing kept"), ("yy", "b", "no"), ("yy", "c", None), (None, None, None)]
    rows += [("en", "s1", "copy of copies " * 40)] * 40
    rows.append(("fr", "long", "mot " * 60000 + "Mot-mot"))
    return rows


def hash_of(s):
    return sum((s or "").encode()) % 5


def frame(spark, rows):
    return spark.createDataFrame([(i, *x, "x", "y", "z", "w") for i, x in enumerate(rows)], "doc_id long, lang string, source string, text string, term string, count string, value string, p string")


@pytest.mark.parametrize("block,tile,top,min_docs", [(512, 128, 50, 5), (7, 2, 3, 5), (1, 1, 50, 30), (3, 5, 1, 2)])
def test_against_the_definition(spark, block, tile, top, min_docs):
    rows = corpus()
    got = divergence.audit(frame(spark, rows).repartition(5), min_docs=min_docs, top=top, block_terms=block, tile_sources=tile).collect()
    want = brute(rows, min_docs, top)
    assert sorted(tuple(r) for r in got) == want
    assert any(x[2] == "term" for x in want) and any(x[4] == 0 for x in want if x[2] == "pair")


@pytest.mark.parametrize("k", [1, 2, 5, 50])
def test_skyband_is_exact(k, monkeypatch):
    monkeypatch.setattr(divergence, "COMPARED", 7)
    for seed in range(20):
        r = np.random.default_rng(seed)
        n = int(r.integers(0, 120))
        high, low, place = r.integers(0, 9, n), r.integers(0, 9, n), r.permutation(n)
        n_dom = [sum(high[j] >= high[i] and low[j] <= low[i] and place[j] < place[i] for j in range(n)) for i in range(n)]
        assert divergence.skyband(high, low, place, k).tolist() == [i for i in range(n) if n_dom[i] < k]


def test_tasks_prune_as_they_read(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 20)
    rows = corpus(seed=3)
    assert sorted(tuple(r) for r in divergence.audit(frame(spark, rows).coalesce(1), min_docs=3, top=4).collect()) == brute(rows, 3, 4)


def test_shares_are_exact(spark):
    big = [(10**13 + 7, 3 * 10**15, 10**6), (0, 0, 1), (3, 9, 2), (9 * 10**15, 9 * 10**15, 3), (4_000_000_000_000_001, 8_000_000_000_000_003, 77)]
    df = spark.createDataFrame(big, "c long, n long, v long")
    from pyspark.sql import functions as F

    got = [r[0] for r in df.select(divergence.share(F.col("c"), F.col("n"), F.col("v"))).collect()]
    assert got == [1 + 10**9 * (c + 5) // (n + 5 * v) for c, n, v in big]


def test_empty_table(spark):
    assert divergence.audit(frame(spark, corpus(3)).where("doc_id < 0")).count() == 0


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("lang", "source", "text").collect()]
    assert sorted(tuple(r) for r in divergence.op13(spark, SF_SMALL).collect()) == brute(rows, 30, 50)
