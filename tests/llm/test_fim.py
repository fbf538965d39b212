import hashlib
import re

import pytest

from cellflux.llm import fim

from corpora import ODD, SF_SMALL, documents

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    """One document by the definition: n, form, prefix_chars, middle_chars, output."""
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    n = len(units)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = h1 % (n + 1), h2 % (n + 1)
    a, b = min(a, b), max(a, b)
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if text == "" or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = ["a", "a b", " a  b\t\n", "\n\n", "x" * 50, "é ñ 日本 \U0001f600 z", "a <P> b", "a <S>", "<M>", "< P>", "a\x1cb c", "one two three four five six seven", "w " * 3000, "long" * 20000]
ROWS = ODD + [(100 + i, TEXTS[i % len(TEXTS)]) for i in range(6 * len(TEXTS))] + [(100, "a")] * 5 + [(100, "another text of the same id")]


@pytest.mark.parametrize("units", [1, 3, fim.PIECE_UNITS])
@pytest.mark.parametrize("parts", [1, 5])
def test_against_the_definition(spark, units, parts):
    docs = documents(spark, ROWS).repartition(parts)
    got = sorted((tuple(r) for r in fim.transform(docs, units=units).collect()), key=str)
    want = sorted(((d, *brute(d, t), t or "") for d, t in ROWS), key=str)
    assert got == want
    forms = {r[2] for r in got}
    assert forms == {"plain", "spm", "psm"}


def test_digests(spark):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = sorted((tuple(r) for r in fim.transform(documents(spark, ROWS), digest=True).collect()), key=str)
    want = sorted(((d, *(x := brute(d, t))[:4], sha(x[4]), sha(t or "")) for d, t in ROWS), key=str)
    assert got == want


def test_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    got = fim.op12(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        n, form, p, m, out = brute(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, p, m)
        assert r.output_sha256 == hashlib.sha256(out.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()


def test_one_exchange_and_two_sorts(spark):
    plan = fim.transform(documents(spark, ROWS[:3]), digest=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort [") == 2
    assert "Window" not in plan and "collect_" not in plan


def test_empty_table(spark):
    assert fim.transform(documents(spark, [(1, "a")]).where("doc_id < 0")).count() == 0
