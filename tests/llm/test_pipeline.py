
import corpus_pipeline
from cellflux.llm import queries
from corpora import SF_SMALL, documents
import test_decontaminate
import test_minhash
import test_quality


def test_stages():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "decontamination", "source_mix", "token_shards"]
    assert {f"op{k}_" for k in range(1, 14)} == {n.split("_")[0] + "_" for n in queries.QUERIES}


def test_each_stage_against_brute_force(spark):
    """On the smallest table: what each stage keeps, from what the stage before kept."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = corpus_pipeline.materialise(stage(spark, docs, SF_SMALL), "test-stage")
        assert docs.columns == columns
        after = sorted(r.doc_id for r in docs.collect())
        seen[name] = (before, after)
    before, after = seen["quality_rules"]
    fine = {d for d, t in before for w, _, _, _, rep in [test_quality.brute(t)] if w >= 50 and 100 * rep <= 50 * w}
    assert set(after) == fine  # no line is frequent in so few documents
    before, after = seen["near_duplicates"]
    assert after == sorted({c for _, _, c in test_minhash.brute(before, 5)})
    before, after = seen["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert after == sorted(d for d, _, hit, _ in test_decontaminate.brute(before, items) if not hit)
    before, after = seen["source_mix"]
    assert set(after) <= {d for d, _ in before} and max(after.count(d) for d in set(after)) <= 3


def test_run(spark):
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.count() > 0 and {"doc_id", "slot", "shard", "byte", "n_tokens"} <= set(got.columns)


def test_odd_rows_go_through_every_stage(spark, tmp_path):
    from corpora import ODD

    docs = documents(spark, ODD)
    every = sorted((d for d, _ in ODD), key=str)
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        got[name] = sorted((r.doc_id for r in stage(spark, docs, SF_SMALL).collect()), key=str)
        assert stage(spark, docs.where("false"), SF_SMALL).count() == 0
    assert got["quality_rules"] == []  # too few words, or one word again and again
    assert got["near_duplicates"] == sorted([d for d, _ in ODD if d != 5], key=str)  # 5 is a copy of 4
    assert got["decontamination"] == every and got["token_shards"] == every
    assert set(got["source_mix"]) <= set(every)
