import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cellflux.llm import packing
from cellflux.llm.common import Roller, text_bytes

from corpora import ODD, SF_SMALL, documents

import pyarrow as pa

MODEL = Tokenizer.from_file(packing.vocabulary())
ENCODER = packing.Encoder(packing.vocabulary())


def ids_of(text):
    return MODEL.encode(text or "", add_special_tokens=False).ids + [1]


def encoded(texts, encoder=ENCODER):
    ids, n = encoder(*text_bytes(pa.array(texts, pa.string())))
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


TRICKY = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n\nb c", "don't 'S 's 're", "x <|endoftext|> y", "x<|endoftext|>", " <|endoftext|>  z", "\x1c a\x1cb c", "a\x85 b", "é à la　carte é  ç", "   x", "日本 語 テキスト",
          "tab\tb c \t d", "12 345,67  ... !!", "ÿ ß\n", "  em", "nul\x00 byte", "\x7f x", "end  \n"]


def test_ids_are_those_of_the_whole_text():
    assert encoded(TRICKY) == [ids_of(t) for t in TRICKY]
    assert encoded([None, "", "a"]) == [[1], [1], ids_of("a")]
    assert encoded([]) == [[]] or encoded([]) == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" \t\n\r\x0b\x0c\x1c\x85\xa0   　aZ'sté0²½.,!<|>éß日\U0001f600\x00\x7f́")), max_size=30), max_size=5))
def test_ids_of_any_text(texts):
    assert [x for x in encoded(texts) if texts] == [ids_of(t) for t in texts]


def test_cache_and_blocks_change_nothing(monkeypatch):
    r = random.Random(5)
    texts = [" ".join(r.choice(["the", "été", "x", "lorem", "1", "  "]) + str(r.randint(0, 50)) for _ in range(r.randint(0, 80))) for _ in range(40)] + ["w" * 5000, " word" * 3000]
    want = [ids_of(t) for t in texts]
    monkeypatch.setattr(packing, "TEXT_BYTES", 64)
    monkeypatch.setattr(packing, "CACHED", 10)
    assert encoded(texts, packing.Encoder(packing.vocabulary())) == want


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_hilbert_curve(dims, bits):
    """A bijection whose neighbours differ by one step in one dimension."""
    points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    key = packing.hilbert(points, bits)
    assert sorted(key.tolist()) == list(range(len(points)))
    walk = points[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def check(rows, pieces, seq_len):
    """Every id of every row lies in exactly one piece; sequences are gapless, of seq_len or a power of two."""
    want = sorted(((d, ids_of(t)) for d, t in rows), key=str)
    by_doc, by_seq = {}, {}
    for p in pieces:
        assert p.length > 0 and len(p.ids) == 4 * p.length
        by_doc.setdefault(p.doc_id, []).append(p)
        by_seq.setdefault(p.sequence_id, []).append(p)
    got = []
    for d, ps in by_doc.items():
        wants = [x for i, x in want if i == d]
        for start in {p.start for p in ps}:
            assert start >= 0
        if len(wants) == 1:
            ps.sort(key=lambda p: p.start)
            assert [p.start for p in ps] == np.cumsum([0, *(p.length for p in ps)])[:-1].tolist()
            ids = np.frombuffer(b"".join(bytes(p.ids) for p in ps), "<u4").tolist()
            assert {p.doc_tokens for p in ps} == {len(ids)}
            got.append((d, ids))
        else:  # rows that share an id: every piece is a stretch of one of them, and together they hold all ids
            for p in ps:
                assert any(np.frombuffer(bytes(p.ids), "<u4").tolist() == w[p.start : p.start + p.length] and p.doc_tokens == len(w) for w in wants)
            assert sum(p.length for p in ps) == sum(map(len, wants))
            got += [(d, w) for w in wants]
    assert sorted(got, key=str) == want
    for ps in by_seq.values():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == np.cumsum([0, *(p.length for p in ps)])[:-1].tolist()
        size = sum(p.length for p in ps)
        assert size == seq_len or size < seq_len and size & (size - 1) == 0
    return by_seq


@pytest.mark.parametrize("seq_len,parts", [(16, 1), (64, 4), (2048, 3)])
def test_packing(spark, seq_len, parts):
    rows = [(d, t) for d, t in ODD if t != "word " * 30000] + [(100 + i, "some words of text number %d " % i * (i % 9)) for i in range(120)] + [(100, "other text, same id")] * 3 + [(400 + i, t) for i, t in enumerate(TRICKY)]
    pieces = packing.pack(documents(spark, rows).repartition(parts), seq_len=seq_len).collect()
    check(rows, pieces, seq_len)


def test_long_text(spark):
    rows = [(1, "word " * 30000), (2, "x" * 100_000), (3, "é" * 40_000), (4, "a")]
    by_seq = check(rows, packing.pack(documents(spark, rows)).collect(), 2048)
    assert len(by_seq) > 10


def test_neighbours_are_alike(spark):
    """Documents of a few lexicons: sequences along the curve mix them far less than the table does."""
    r = random.Random(1)
    lexicon = [["".join(r.choice("abcdefghij") for _ in range(5)) + str(k) for _ in range(40)] for k in range(6)]
    rows = [(i, " ".join(r.choice(lexicon[i % 6]) for _ in range(40))) for i in range(600)]
    pieces = packing.pack(documents(spark, rows).coalesce(1), seq_len=1024).collect()
    by_seq = check(rows, pieces, 1024)
    pure = np.mean([max(np.bincount([p.doc_id % 6 for p in ps])) / len(ps) for ps in by_seq.values() if len(ps) > 3])
    chance = np.mean([max(np.bincount(r.choices(range(6), k=len(ps)))) / len(ps) for ps in by_seq.values() if len(ps) > 3])
    assert pure > 0.6 and pure > 1.6 * chance


def test_copies_are_dealt_apart(spark):
    """Half of the rows are one text: no partition gets them all, and they stay neighbours."""
    rows = [(i, "the same text of a few words") for i in range(2000)] + [(5000 + i, f"text number {i} {i * 7}") for i in range(2000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart
    try:
        got = packing.pack(documents(spark, rows).repartition(4)).select("sequence_id", "doc_id").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = {}
    for x in got:
        if x.doc_id < 2000:
            parts.setdefault(x.sequence_id >> packing.PART_BITS, set()).add(x.doc_id)
    assert sum(map(len, parts.values())) >= 2000
    assert max(map(len, parts.values())) <= 1200


def test_registered_query(spark):
    rows = {x.doc_id: x.text for x in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    got = packing.op11(spark, SF_SMALL).collect()
    ids = {d: np.array(ids_of(t), "<u4") for d, t in rows.items()}
    assert sum(p.length for p in got) == sum(map(len, ids.values()))
    assert len({(p.doc_id, p.start) for p in got}) == len(got)
    for p in got:
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert len(part) == p.length and p.doc_tokens == len(ids[p.doc_id]) and p.ids_crc32 == zlib.crc32(part.tobytes())


def test_projection_has_unit_spread():
    r = random.Random(2)
    texts = [" ".join(str(r.random()) for _ in range(50)) for _ in range(300)]
    data, bounds = text_bytes(pa.array(texts))
    steps = packing.project(data, bounds, Roller(packing.SEED), np.random.default_rng(packing.SEED).choice([-1.0, 1.0], (packing.BUCKETS, packing.DIMS)))
    assert steps.min() >= 0 and steps.max() < 1 << packing.BITS
    assert (0.15 < (steps / (1 << packing.BITS)).std(0)).all()


def test_empty_table(spark):
    assert packing.pack(documents(spark, [(1, "a")]).where("doc_id < 0")).count() == 0
