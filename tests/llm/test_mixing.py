import random
from collections import Counter, defaultdict

from cellflux.llm import mixing
from corpora import ODD, documents


def corpus(n=600):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)) + f" {i}", rng.choice(["a"] * 20 + ["b", "c", "é", "z", "Z", None])) for i in range(n)]
    return rows + [(d, t, "odd") for d, t in ODD] + [(9000, "", "empty"), (9001, None, "empty")]


def filled(size):
    """Targets by resharing the excess in rounds."""
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, stopped = sum(size.values()), set()
    while True:
        free = [s for s in order if s not in stopped]
        left = total - sum(3 * size[s] for s in stopped)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * size[s]}
        if not over:
            return {s: 3.0 * size[s] if s in stopped else share[s] for s in order}
        stopped |= over


def test_targets_and_takes(spark):
    rows = corpus()
    got = mixing.mix(documents(spark, rows)).collect()
    words = lambda t: len((t or "").replace("\n", " ").replace("\t", " ").split(" ")) - (t or "").replace("\n", " ").replace("\t", " ").split(" ").count("")
    size = defaultdict(int)
    for d, t, s in rows:
        size[s] += words(t)
    want = filled(size)
    taken, largest = Counter(), Counter()
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - want[r.source]) < 1e-5
        assert r.taken == r.takes * r.size <= 3 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in size:
        assert abs(taken[s] - want[s]) <= largest[s]  # the nearest that whole documents allow
    again = mixing.mix(documents(spark, rows[::-1]).repartition(7)).collect()
    key = lambda r: (str(r.doc_id), r.hash, r.takes)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_repeats_documents(spark):
    rows = corpus(200)
    docs = documents(spark, rows)
    plan = mixing.mix(docs).collect()
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    want = Counter()
    for r in plan:
        want[r.doc_id] += r.takes
    assert Counter(r.doc_id for r in out.collect()) == +want


def test_empty_and_one_source(spark):
    assert mixing.mix(documents(spark, [(1, "a")]).where("false")).count() == 0
    got = mixing.mix(documents(spark, [(1, "a b"), (2, "c")])).collect()
    assert sorted((r.doc_id, r.taken, r.target) for r in got) == [(1, 2, 3.0), (2, 1, 3.0)]
    assert [r.taken for r in mixing.mix(documents(spark, [(1, ""), (2, None)])).collect()] == [0, 0]
