import random
import re

import pytest

from cellflux.llm import decontaminate
from corpora import ODD, documents


def brute(rows, items):
    word = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    windows = {}
    for i, t in items:
        w = word(t)
        for k in range(len(w) - 9 if len(w) >= 10 else min(len(w), 1)):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(i)
    out = []
    for d, t in rows:
        w = word(t)
        hit, its = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := windows.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    its.update(str(i) for i in x if i is not None)
        out.append((d, len(w), len(hit), sorted(its)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(3)
    v = [f"w{i}" for i in range(50)] + ["the"] * 20
    items = [(i, " ".join(rng.choice(v) for _ in range(n))) for i, n in enumerate([1, 2, 4, 6, 9, 10, 11, 14, 30, 30, 10, 40])]
    items += [(20, items[8][1]), (20, items[8][1]), (21, None), (22, ""), (None, items[9][1] + " tail"), (23, "the " * 15)]
    rows = []
    for i in range(80):
        w = [rng.choice(v) for _ in range(rng.randint(0, 60))]
        a, b = rng.choice(items[8:12])[1].split(), rng.randrange(20)
        w[len(w) // 2 : len(w) // 2] = a[b : b + rng.randint(5, 25)]
        rows.append((i, ", ".join(w).upper() if i % 3 else " ".join(w)))
    return rows + ODD + [(500, "the-" * 40), (501, rows[0][1])], items


def test_against_brute_force(spark):
    rows, items = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(documents(spark, rows), bench).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got], key=str) == brute(rows, items)


@pytest.mark.parametrize("which", ["docs", "benchmark", "both"])
def test_empty_tables(spark, which):
    rows, items = corpus()
    docs, bench = documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    docs = docs.where("false") if which != "benchmark" else docs
    bench = bench.where("false") if which != "docs" else bench
    got = decontaminate.contamination(docs, bench).collect()
    assert len(got) == (0 if which != "benchmark" else len(rows)) and not any(r.n_hit for r in got)


def test_clean_keeps_the_rest(spark):
    rows, items = corpus()
    docs = documents(spark, rows)
    kept = decontaminate.clean(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([d for d, _, hit, _ in brute(rows, items) if not hit], key=str)
