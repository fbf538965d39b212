import re
from collections import Counter

import corpus_pipeline
import duckdb
from cellflux.llm import quality
from corpora import ODD, documents


def brute(t):
    t = t or ""
    word = lambda x: re.findall(r"[^\x20\x09-\x0D]+", x)
    w = word(t)
    g = Counter(zip(w, w[1:], w[2:]))
    hit = {i + j for i in range(len(w) - 2) if g[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if word(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)


def good(i):
    """A document of 60 words of its own."""
    return " ".join(f"w{i}x{k}" for k in range(60))


ROWS = ODD + [(20, "a b c a b c\na b c\n\n  \na b c"), (21, "x # y $$ | <z>"), (22, "one\r\none\r\nTwo \n two"), (23, good(23) + "\n" + good(23))]


def test_counts(spark):
    got = quality.verdicts(documents(spark, ROWS)).collect()
    want = sorted([(d, *brute(t)) for d, t in ROWS], key=str)
    assert sorted([(r.doc_id, *(r[c] for c in quality.COUNTS)) for r in got], key=str) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


MENU = "Home | " + " ".join(f"menu{k}" for k in range(70))


def corpus():
    """Host h: 40 documents of little but a common line, 40 good ones that hold it too, 60 copies of one text; host None: as many good ones."""
    rows = [(i, f"{MENU}\n" + " ".join(f"y{i}x{k}" for k in range(30)), "h") for i in range(40)]
    rows += [(100 + i, f"{good(i)} {good(1000 + i)}\n  {MENU.upper()}  ", "h") for i in range(40)]
    rows += [(200 + i, good(7777), "h") for i in range(60)]
    return rows + [(300 + i, good(300 + i), None) for i in range(40)] + [(400, f"{MENU}\nalone", "other")]


def test_lines_of_a_host(spark):
    docs = documents(spark, corpus())
    got = {r.doc_id: (r.kept, r.n_frequent) for r in quality.verdicts(docs).collect()}
    assert all(got[i] == (False, 72) for i in range(40))  # depleted
    assert all(got[100 + i] == (True, 72) for i in range(40))  # enough is left
    assert all(got[200 + i] == (True, 0) for i in range(60))  # copies don't make a line frequent
    assert all(got[300 + i] == (True, 0) for i in range(40))
    assert got[400] == (True, 0)  # common elsewhere
    kept = quality.accepted(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, (k, _) in got.items() if k)


def test_empty_table(spark):
    assert quality.verdicts(documents(spark, ROWS).where("false")).count() == 0


def test_distinct_texts_that_share_their_smallest_line(spark):
    """The line with the smallest hash stands in every text; 30 texts that differ, and 30 copies of one but for case and spaces."""
    low = min((f"{MENU} {k}" for k in range(3000)), key=lambda x: quality.line_hash(x.encode()))
    rows = [(i, f"{low}\n" + " ".join(f"y{i}x{k}" for k in range(30)), "h") for i in range(30)]
    rows += [(100 + i, (f"{low}\n{good(5)}" + " " * i).title() if i % 2 else f"{low}\n{good(5)}", "copies") for i in range(30)]
    got = {r.doc_id: (r.kept, r.n_frequent) for r in quality.verdicts(documents(spark, rows)).collect()}
    assert all(got[i] == (False, 73) for i in range(30))
    assert all(got[100 + i] == (True, 0) for i in range(30))


def test_limit_of_a_large_host(spark):
    """A line of 30 documents is no tenth of a host of 400, but above the limit that doesn't grow with the host."""
    rows = [(i, f"{MENU}\n" + " ".join(f"y{i}x{k}" for k in range(30)), "h") for i in range(30)] + [(100 + i, good(100 + i), "h") for i in range(370)]
    docs = documents(spark, rows)
    assert all(r.kept for r in quality.verdicts(docs).collect())
    got = {r.doc_id: r.kept for r in quality.verdicts(docs, many_docs=30).collect()}
    assert [d for d, k in sorted(got.items()) if not k] == list(range(30))


def test_query_and_sql_agree_where_lines_reject(spark, tmp_path):
    """Boilerplate of distinct texts, of texts that share their smallest line, of copies, and of hosts below and above the limits."""
    low = min((f"{MENU} {k}" for k in range(3000)), key=lambda x: quality.line_hash(x.encode()))
    rows = [(i, f"{low}\n" + " ".join(f"y{i}x{k}" for k in range(30)), "low") for i in range(30)]
    rows += [(100 + i, f"{MENU}\n\n" + " ".join(f"z{i}x{k}" for k in range(30)), "few") for i in range(19)]
    rows += [(200 + i, f"{MENU} \n{good(5)}", "copies") for i in range(60)]
    rows += [(300 + i, f"  {MENU.upper()}\n{MENU}\n" + " ".join(f"q{i}x{k}" for k in range(40)), None) for i in range(25)]
    rows += [(1000 + i, (f"{MENU}\n" if i < 210 else "") + " ".join(f"v{i}x{k}" for k in range(55)), "large") for i in range(2400)]
    rows += [(5000 + i, t, "odd") for i, (_, t) in enumerate(ODD) if t is None or len(t) < 1000]
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    sql = con.execute(quality.ORACLE).fetchall()
    names = [c[0] for c in con.description]
    got = quality.op8(spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(sql)
    lost = {r.doc_id for r in got if not r.kept and not r.base_failed}
    assert lost == {*range(30), *range(300, 325), *range(1000, 1210)}


def test_frequent_lines_are_cut(spark):
    """Kept texts lose their host's frequent lines, in any case and spacing and wherever they stand, and nothing else."""
    menu, rows, want = "Home | Share this", [], []
    for i in range(30):
        rows += [(i, f"{menu}\n{good(i)}\n\n  {menu.upper()} \n \t\n{good(100 + i)}\r\n{menu}", "h")] * (2 if i == 3 else 1)
        want += [(i, f"{good(i)}\n\n \t\n{good(100 + i)}\r")] * (2 if i == 3 else 1)
    rows += [(50, f"{menu}\n{good(50)}\n{good(51)}", "other"), (None, f"{menu}\n{good(52)}\n{good(53)}\né ñ 日本", "h"), (None, good(54), None), (3, good(55), "h"), (56, f"{menu}\nfew", "h")]
    want += [(50, rows[-5][1]), (None, f"{good(52)}\n{good(53)}\né ñ 日本"), (None, good(54)), (3, good(55))]
    docs = documents(spark, rows)
    got = quality.accepted(docs)
    assert got.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == sorted(want, key=str)
    staged = corpus_pipeline.quality_rules(spark, docs, "")
    assert sorted([(r.doc_id, r.text) for r in staged.collect()], key=str) == sorted(want, key=str)
