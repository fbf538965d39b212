import random
import zlib

from cellflux.llm import toxicity
from corpora import ODD, SF_SMALL, documents


def corpus(n=1200):
    rng = random.Random(8)
    v = ["alpha", "beta", "gamma", "delta", "house", "tree", "river", "stone", "cloud", "you", "not"]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(v) for _ in range(rng.randint(20, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randint(2, 5)):
                w.insert(rng.randrange(len(w)), rng.choice(["grob", "zork"]) + rng.choice(["el", "ins", "ant", "o"]))
        rows.append((i, " ".join(w) + ".", "src"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def auc(scores, y):
    pos, neg = [s for s, t in zip(scores, y) if t], [s for s, t in zip(scores, y) if not t]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_held_out_rows(spark):
    rows, labels = corpus()
    lab = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in toxicity.scored(documents(spark, rows + [(10**6 + i, t) for i, (_, t) in enumerate(ODD)]), lab).collect()}
    held = [(got[i], t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert auc(*zip(*held)) > 0.98
    assert sum((s >= toxicity.THRESHOLD) == bool(t) for s, t in held) / len(held) > 0.97
    assert all(0 <= s <= 1 for s in got.values())
    assert all(got[10**6 + i] < toxicity.THRESHOLD for i in range(len(ODD)))


def test_held_out_labels_are_never_read(spark):
    rows, labels = corpus()
    wrong = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    docs, schema = documents(spark, rows), "doc_id long, quality int, toxic int"
    a = toxicity.scored(docs, spark.createDataFrame(labels, schema)).orderBy("doc_id").collect()
    b = toxicity.scored(docs, spark.createDataFrame(wrong, schema)).orderBy("doc_id").collect()
    assert a == b


def test_clauses():
    g = toxicity.Grammar({"idiot": 2.0})
    kinds = lambda t: dict(zip(toxicity.KINDS, g.matches(t)))
    one = lambda t: {k for k, v in kinds(t).items() if v and k != "density"}
    assert one("what an idiot") == {"insult"}
    assert one("you are idiots") == {"targeted"}
    assert one("he is not an idiot") == {"negated"}
    assert one("she said that idiot left") == {"reported"}
    assert one("not today. idiot") == {"insult"}  # a clause ends a negation
    assert one("I will kill you") == {"threat"}
    assert one("to kill time") == set()
    assert one("they never kill them") == {"softened"}
    assert one("unidiot prose") == set() and one("") == set() and one(None or "") == set()


def test_without_labels(spark):
    docs = documents(spark, ODD)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score < 1e-6 for r in toxicity.scored(docs, none).collect()} == {True}
    assert toxicity.scored(docs.where("false"), none).count() == 0


def test_query(spark):
    got = toxicity.op9(spark, SF_SMALL).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3) for r in got)
