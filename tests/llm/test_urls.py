import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellflux.llm import urls

RULES = urls.RULES + [("block", "a.b.example.org", ""), ("allow", "b.example.org", "/x"), ("block", "net", "/es/")]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    h, p = (m[1].translate(LOWER), m[2]) if m else ("", "")
    fit = [(len(rh) + len(rp), len(rh), rh + rp, v) for v, rh, rp in RULES if (h == rh or h.endswith("." + rh)) and p.startswith(rp)]
    best = max(fit, default=None)
    return (h, p, best[2] if best else None, best[3] if best else "allow")


def pages(spark):
    rng = random.Random(2)
    hosts = ["example.com", "WWW.Example.com", "m.example.com", "a.b.example.org", "b.example.org", "x.net", "net", "com", "", ".", "a..com", "éx.com", "notexample.com"]
    paths = ["", "/", "/en/", "/en", "/es/1", "/fr/2/", "/x", "/xy/z", "/en/?q=/es/", "#/en/", "?u=http://x.net/es/"]
    rows = [(i, f"{rng.choice(['http', 'https', ''])}://{rng.choice(hosts)}{rng.choice(paths)}", "k") for i in range(400)]
    rows += [(1000, None, "k"), (1001, "", "k"), (1002, "no scheme.com/en/", "k"), (3, "http://example.com/en/", "k"), (None, "http://q.net/es/", "k"), (1003, "http://x.net/es/" + "y" * 100000, "k")]
    return rows, spark.createDataFrame(rows, "page_id long, url string, key string")


@pytest.mark.parametrize("how", [{}, {"least_log2": 6}, {"most_keys": 1}, {"most_keys": 3, "least_log2": 6}])
def test_verdicts(spark, how):
    rows, df = pages(spark)
    got = urls.judged(df, spark.createDataFrame(RULES, "verdict string, host string, path string"), **how).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(i, *brute(u)) for i, u, _ in rows], key=str)


def test_cascade_is_exact_and_deep(spark):
    u = spark.range(20000).select((F.col("id") % 7 == 0).alias("listed"), F.xxhash64("id").alias("h1"), F.xxhash64(F.lit(1), "id").alias("h2"))
    levels = urls.build(u, "listed", least_log2=12)
    assert len(levels) > 3
    rows = u.collect()
    h1, h2 = (np.array([r[c] for r in rows], np.int64).view(np.uint64) for c in ("h1", "h2"))
    assert urls.member(levels, h1, h2).tolist() == [r.listed for r in rows]


def test_empty_tables(spark):
    rows, df = pages(spark)
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    assert urls.judged(df.where("false"), rules).count() == 0
    got = urls.judged(df, rules.where("false")).collect()
    assert {(r.rule, r.verdict) for r in got} == {(None, "allow")} and len(got) == len(rows)
