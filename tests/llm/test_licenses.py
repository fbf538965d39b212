import numpy as np
import pytest
from pyspark.sql import functions as F

from cellflux.llm import licenses
from corpora import ODD, SF_SMALL, documents


def test_families_and_unknown(spark):
    prose = "plain words about the weather and the sea in a long line of text"
    rows = list(ODD) + [(100 + i, f"{prose} {i}\n{prose} again") for i in range(200)]
    n = 1000
    want = {}
    for f, ts in licenses.TEMPLATES.items():
        for t in ts:
            for shape in (t, t.upper(), f"  {t}  ", f"© 2024 someone. {t}"):
                want[n] = f
                rows.append((n, f"{prose}\n{shape}\n{prose}"))
                n += 1
    rows += [(5000, prose + "\nAll rights reserved.\nAll rights reserved."), (5001, "this person is hereby here"), (5001, "a licensed driver of the public road")]
    got = [r for r in licenses.licence_paragraphs(documents(spark, rows)).collect()]
    sure = {(r.doc_id, r.family) for r in got if r.confirmed}
    assert {(d, f) for d, f in sure if 1000 <= d < 5000} == set(want.items())
    assert sum(r.doc_id == 5000 and r.confirmed for r in got) == 2
    assert not any(r.confirmed for r in got if r.doc_id is None or r.doc_id < 1000 or r.doc_id == 5001)
    assert not any(r.doc_id is None or r.doc_id < 1000 for r in got), "prose is no finding, not even an unknown one"


UNLISTED = ["Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: ISC", "MIT License", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
            "You may redistribute this file under the terms of the Artistic License.", "Dual licensed under the EPL and the LGPL.", "Copyright (c) 1999 the authors."]


def wrapped(text, width):
    lines, line = [], ""
    for w in text.split():
        if line and len(line) + 1 + len(w) > width:
            lines.append(line)
            line = w
        else:
            line = f"{line} {w}".strip()
    return "\n".join([*lines, line])


def test_wrapped_templates_are_confirmed(spark):
    prose = "plain words about the weather and the sea in a long line of text"
    rows, want = [], {}
    for width in (12, 24, 40):
        for f, ts in licenses.TEMPLATES.items():
            for t in ts:
                want[len(rows)] = f
                rows.append((len(rows), f"{prose}\n{prose}.\n \t\n{wrapped(t, width)}\n\n{prose}"))
    got = licenses.licence_paragraphs(documents(spark, rows)).collect()
    assert {(r.doc_id, r.family) for r in got if r.confirmed} == set(want.items())
    assert len(got) == len(rows)


@pytest.mark.parametrize("unlisted", [100, 1000])
def test_known_licences_stay_found_among_unlisted_ones(spark, unlisted):
    """The table's own findings, and a large part of the corpus ending in licences that no template states."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    before = {(r.doc_id, r.family) for r in licenses.licence_paragraphs(docs).collect() if r.confirmed}
    assert {f for _, f in before} >= {"cc-by-nc-4.0", "mit"}
    more = spark.createDataFrame([(10**6 + i, f"some text {i} of a few words.\n{UNLISTED[i % len(UNLISTED)]}") for i in range(unlisted)], "doc_id long, text string")
    got = licenses.licence_paragraphs(docs.unionByName(more)).collect()
    assert {(r.doc_id, r.family) for r in got if r.confirmed} == before
    assert {r.doc_id for r in got if r.family == "unknown" and r.doc_id >= 10**6} == {10**6 + i for i in range(unlisted)}


def test_the_gate_loses_no_finding(spark):
    """Without any gate, by the model on all paragraphs: the same findings."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = licenses.Model(licenses.sample_lines(docs))
    rows = docs.select("doc_id", F.posexplode(licenses.sentences(F.col("text"))).alias("at", "text")).withColumn("words", licenses.word_list(F.col("text"))).collect()
    want = set()
    for r in rows:
        z = model.bias + sum((model.weights[x] for x in licenses.features(r.words) if x in model.weights), np.zeros(len(model.classes)))
        if z[:-1].max() > z[-1]:
            want.add((r.doc_id, r.at))
    got = {(r.doc_id, r.at) for r in licenses.licence_paragraphs(docs).collect()}
    assert got == want


def test_whole_small_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    part = {"apache-2.0": "Apache License", "mit": "MIT License", "gpl-3": "GNU General", "cc-by-nc-4.0": "CC BY-NC", "proprietary": "All rights reserved"}
    want = {r.doc_id: ",".join(sorted(f for f, x in part.items() if any(x in line for line in r.text.split("\n")))) for r in docs}
    assert {r.doc_id: r.families for r in licenses.op2(spark, SF_SMALL).collect()} == want


def test_empty_table(spark):
    assert licenses.licence_paragraphs(documents(spark, ODD).where("false")).count() == 0


def test_a_paragraph_does_not_carry_its_whole_text(spark):
    """What is exploded beside a paragraph is held for all paragraphs of a text at once."""
    import re

    rows = licenses.paragraphs(documents(spark, [*ODD, (7, "Some text. MIT License! ABC licensed\n\nxlicense"), (8, None)]), ["license", "licensed"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"Generate posexplode\(.*?\), \[(doc_id#\w+, key#\w+)\]", plan, re.S), plan
    assert [(r.at, r.text, r.words) for r in rows.where("doc_id = 7").orderBy("at").collect()] == [
        (1, "MIT License!", ["mit", "license"]), (2, "ABC licensed", ["abc", "licensed"])]
    assert licenses.paragraphs(documents(spark, ODD), []).count() == 0


def test_no_python_in_the_plan(spark):
    plan = licenses.op2(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
