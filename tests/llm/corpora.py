"""Small tables for the tests of this folder."""

SF_SMALL = "/root/testdata/sf0.001"

# names that the operators use inside
EXTRA = ["key", "n", "id", "h", "size", "hash", "takes", "items", "spans", "found", "comp", "rank", "bucket"]


def documents(spark, rows, source="s"):
    """Rows (doc_id, text[, source]) as a documents table, with extra columns whose names clash with inner ones."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else source, *["x"] * len(EXTRA)) for r in rows]
    return spark.createDataFrame(full, "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in EXTRA))


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "no id here"), (None, None), (6, "é ñ 日本 \U0001f600"), (7, "word " * 30000)]
