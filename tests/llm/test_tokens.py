import glob
import re
from urllib.parse import urlparse

import numpy as np
import pytest

from cellflux.llm import tokens
from cellflux.session import scratch_path

from corpora import documents


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation_is_a_bijection(n):
    got = tokens.permute(np.arange(n), n)
    assert sorted(got.tolist()) == list(range(n))
    if n > 100:
        assert (got != np.arange(n)).mean() > 0.9
        assert (got != tokens.permute(np.arange(n), n, key=5)).mean() > 0.9


ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\nb c", "x  y", "x  y", "don't stop 123 ,,, ok", "\x1c a\x1cb c", "é à la　 carte", "a b c d", "tab\tb c \t d", "日本 語 テキスト", "it's 3 o'clock  \n\n now"]


def read_back(path, index, seq_len, shard_slots):
    """Each document's ids, read from the shards by its row of the index."""
    files = {}
    for f in glob.glob(f"{path}/shard=*/*.txt"):
        k = int(re.search(r"shard=(\d+)", f)[1])
        assert k not in files, "a shard is one file"
        files[k] = f
    slots = np.concatenate([tokens.read_slots(files[k], seq_len) for k in sorted(files)]) if files else np.zeros((0, seq_len))
    return files, slots


@pytest.mark.parametrize("parts", [1, 3])
@pytest.mark.parametrize("block", [1, 128])
def test_round_trip(spark, tmp_path, parts, block, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_SEQUENCES", block)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, "word " * i + "end") for i in range(60)] + [(7, None), (7, None), (None, "no id")]
    src = str(tmp_path / "in")
    documents(spark, rows).repartition(parts).write.parquet(src)
    docs = spark.read.parquet(src)
    path = scratch_path(spark, "test-shards")
    seq_len, shard_slots = 16, 5
    index = tokens.write_shards(docs, path, seq_len=seq_len, shard_slots=shard_slots).collect()
    files, slots = read_back(urlparse(path).path, index, seq_len, shard_slots)
    enc = tokens.Encoder(tokens.VOCABULARY)
    end = enc.end
    assert sorted(files) == list(range(len(files)))
    n = len(slots)
    place = tokens.permute(np.arange(n), n)
    stream = slots[place]  # sequences in number order
    at = {int(s): i for i, s in enumerate(place)}
    want = sorted([(d, enc.ids(t) + [end]) for d, t in rows], key=str)
    got = []
    for r in index:
        i = at[r.slot]
        ids = stream[i : i + r.n_sequences].reshape(-1)[r.skip : r.skip + r.n_tokens].tolist()
        got.append((r.doc_id, ids))
        assert r.shard == r.slot // shard_slots and r.byte == r.slot % shard_slots * (2 * seq_len + 1)
        one = tokens.read_slots(files[r.shard], seq_len, r.slot % shard_slots)[0]
        assert (one == slots[r.slot]).all()
    assert sorted(got, key=str) == want


def test_empty_table(spark):
    docs = documents(spark, [(1, "a")]).where("doc_id < 0")
    assert tokens.write_shards(docs, scratch_path(spark, "test-shards")).count() == 0
