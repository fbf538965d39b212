"""Packing along a space-filling curve.

1. Project.  A document's words are hashed to ``BUCKETS`` counts, damped by a
   root and scaled to length 1; random signs project them to ``DIMS`` numbers
   of about unit variance, which a logistic curve spreads over 2**``BITS``
   steps each.  The Hilbert key of those steps is the document's place.  The
   keyed rows are written once to the shared folder.
2. Order.  Rows are range-partitioned and sorted by (Hilbert key, a hash of
   the row).  The hash splits a group of equal keys, so that copies that are a
   third of all rows are dealt to a third of the partitions.
3. Pack.  Each partition is one stream of tokens along its stretch of the
   curve, cut every ``SEQ_LEN`` ids; its rest, below ``SEQ_LEN``, is cut to
   powers of two, the largest first, which need no padding.  So no sequence
   is padded, and a document is cut only where a sequence ends.

Tokens come from a public vocabulary of the ``tokenizers`` library (path is a
parameter).  Words with the white space before them are encoded on their own,
each distinct one once a block, with a cache over blocks and tasks; see ``Encoder`` for
why the ids are those of the whole text.

Memory: a task holds one Arrow batch of texts with its ids and less than one
sequence; a text is one row, however long.  A sequence's number holds the
partition's in its upper bits, so it follows the curve and needs no count of
other partitions; the range bounds are fixed before any task starts, and a
task that is run again gives the same sequences.

Defined results: null or empty text is the end id alone; rows that repeat are
packed as often; ties of key and hash go by doc_id; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellflux.llm.common import LOWER, NOT_SPACE, Roller, blocks, materialise, prepare, table, text_bytes, words

SEQ_LEN, END = 2048, 1
BUCKETS, DIMS, BITS = 1024, 4, 12
SEED = 11
CACHED = 1 << 20  # distinct words a worker remembers (about 40 MB); the cache starts anew beyond it
TEXT_BYTES = 1 << 22  # text that is encoded at once
PART_BITS = 40  # sequence number: partition above, place in the partition below


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# ---------------------------------------------------------------------------
# places on the curve
# ---------------------------------------------------------------------------

def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert keys of points (rows of ``x``, integers below 2**bits), by Skilling's transform: exchanges, then a Gray code."""
    x = x.T.astype(np.int64).copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(dims):
            hit = (x[i] >> b) & 1 == 1
            swap = np.where(hit, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(hit, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def project(data: np.ndarray, bounds: np.ndarray, roller: Roller, signs: np.ndarray) -> np.ndarray:
    """Steps of each row's text: its hashed word counts on ``signs`` (BUCKETS x DIMS)."""
    s, e, at = words(data, bounds, NOT_SPACE)
    n = len(bounds) - 1
    bucket = (roller.spans(roller.prefix(data, LOWER), s, e) % np.uint64(len(signs))).astype(np.int64) if len(s) else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(n), np.diff(at))
    v = np.sqrt(np.bincount(doc * len(signs) + bucket, minlength=n * len(signs)).reshape(n, -1))
    length = np.maximum(np.sqrt((v * v).sum(1)), 1)
    spread = 1 / (1 + np.exp(-1.702 * (v @ signs) / length[:, None]))
    return np.minimum((spread * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def placed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, text, place: the Hilbert key of every document."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, signs = Roller(seed), np.random.default_rng(seed).choice([-1.0, 1.0], (BUCKETS, DIMS))
        for b in batches:
            data, bounds = text_bytes(b.column("text"))
            keys = [hilbert(project(part, at, roller, signs), BITS) for _, _, part, at in blocks(data, bounds)]
            yield b.append_column("place", pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64), pa.int64()))

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("place", T.LongType())]))


# ---------------------------------------------------------------------------
# tokens
# ---------------------------------------------------------------------------

SPACE = ~NOT_SPACE
GRAPHIC = np.zeros(256, bool)
GRAPHIC[0x21:0x7F] = True
LETTER_LEAD = np.zeros(256, bool)
LETTER_LEAD[0xC3:0xE0] = True


class Encoder:
    """Ids of many texts at once.

    The vocabulary's word pattern never takes white space after anything else
    into one word, and its look-ahead ends at the next character that isn't
    white space.  So a text may be cut before white space that follows a
    character which is surely none (here ASCII, or of two bytes from U+00C0):
    each piece, white space and what follows it, gets the ids it has in the
    whole text.  Pieces are Arrow strings over the text's own bytes;
    equal ones are encoded once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.pieces, self.ids = pa.array([], pa.large_binary()), pa.array([], pa.large_binary())

    @staticmethod
    def starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where pieces start."""
        cut = np.zeros(len(data), bool)
        before = GRAPHIC[data]
        before[1:] |= LETTER_LEAD[data[:-1]]  # the second byte of a letter
        cut[1:] = SPACE[data[1:]] & before[:-1]
        cut[bounds[:-1][bounds[:-1] < len(data)]] = True
        return np.flatnonzero(cut)

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces between ``offsets``, on end, and the number of each."""
        cut = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        known = pc.index_in(cut.dictionary, value_set=self.pieces)
        new = cut.dictionary.filter(pc.is_null(known))
        at = known.to_numpy(zero_copy_only=False)
        if len(new):
            found = [e.ids for e in self.model.encode_batch_fast(new.cast(pa.large_string()).to_pylist(), add_special_tokens=False)]
            n = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((i for ids in found for i in ids), "<u4", int(n.sum()))
            ids = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(4 * np.concatenate(([0], np.cumsum(n)))), pa.py_buffer(flat)])
            at = np.where(np.isnan(at), np.cumsum(np.isnan(at)) - 1 + len(self.pieces), at) if known.null_count else at
            self.pieces, self.ids = pa.concat_arrays([self.pieces, new]), pa.concat_arrays([self.ids, ids])
        at = pa.array(at.astype(np.int64))
        got = self.ids.take(at.take(cut.indices))
        if len(self.pieces) > CACHED:
            self.pieces, self.ids = cut.dictionary, self.ids.take(at)
        flat, ends = text_bytes(got)
        return flat.view("<u4"), np.diff(ends) // 4

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows on end, the end id after each, and the number of each row's (with it)."""
        n = len(bounds) - 1
        starts = self.starts(data, bounds)
        edges = np.append(starts, len(data)).astype(np.int64)
        ids, counts, i = [], [], 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(edges, edges[i] + TEXT_BYTES, side="right")) - 1)
            a, b = self.block(data[edges[i] : edges[j]], edges[i : j + 1] - edges[i])
            ids.append(a)
            counts.append(b)
            i = j
        each = np.concatenate([[0], *counts]).cumsum()
        upto = each[np.searchsorted(starts, bounds)]  # ids before each row
        out = np.full(int(upto[-1]) + n, END, "<u4")
        body = np.ones(len(out), bool)
        body[upto[1:] + np.arange(n)] = False
        if ids:
            out[body] = np.concatenate(ids)
        return out, np.diff(upto) + 1


def worker_encoder(path: str) -> Encoder:
    """The encoder of this Python worker, with the words it has met in earlier tasks.

    Spark reuses its workers, but functions reach them by value, with new
    module globals in every task; a module object of its own holds the encoder.
    """
    import sys
    import types

    held = sys.modules.setdefault("_cellflux_encoders", types.ModuleType("_cellflux_encoders")).__dict__
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


# ---------------------------------------------------------------------------
# sequences
# ---------------------------------------------------------------------------

def powers(n: int) -> list[int]:
    """The powers of two that make n, the largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def cut_stream(first: int, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of rows that lie on end in a stream from place ``first``, cut at multiples of ``size``: row, start in the row, place, length."""
    ends = first + np.cumsum(lengths)
    begins = ends - lengths
    stop = int(ends[-1]) if len(ends) else first
    cuts = np.union1d(begins, np.arange(first - first % size + size, stop, size))
    row = np.searchsorted(begins, cuts, side="right") - 1
    return row, cuts - begins[row], cuts, np.diff(np.append(cuts, stop))


def pack(docs: DataFrame, path: str | None = None, seq_len: int = SEQ_LEN, seed: int = SEED) -> DataFrame:
    """doc_id, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset: one row a piece."""
    prepare(docs.sparkSession)
    path = path or vocabulary()
    rows = placed(docs, seed).withColumn("tie", F.xxhash64("doc_id", "text", F.spark_partition_id()))
    rows = materialise(rows, "placed").repartitionByRange("place", "tie").sortWithinPartitions("place", "tie", "doc_id").select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    names = [c.split()[0] for c in schema.split(", ")]

    def record(doc_id, start, length, ids, tokens, seq, offset):
        return pa.RecordBatch.from_arrays([doc_id, *(pa.array(x, pa.int64()) for x in (start, length)), ids, *(pa.array(x, pa.int64()) for x in (tokens, seq, offset))], names=names)

    def narrow(b):
        return b.set_column(3, "ids", b.column("ids").cast(pa.binary()))

    def recut(rest, seq):
        """The pieces of a stream's rest, cut to sequences of powers of two."""
        length, ids = rest["length"].to_numpy(), rest["ids"].to_pylist()
        ends = np.cumsum(length)
        bounds = np.cumsum([0, *powers(int(ends[-1]))])
        cuts = np.union1d(ends - length, bounds[1:-1]).astype(np.int64)
        row = np.searchsorted(ends - length, cuts, side="right") - 1
        skip = cuts - (ends - length)[row]
        n = np.diff(np.append(cuts, ends[-1]))
        k = np.searchsorted(bounds, cuts, side="right") - 1
        parts = pa.array([ids[r][4 * s : 4 * (s + m)] for r, s, m in zip(row, skip, n)], pa.large_binary())
        at_ = pa.array(row)
        return record(rest["doc_id"].combine_chunks().take(at_), rest["start"].to_numpy()[row] + skip, n, parts, rest["doc_tokens"].to_numpy()[row], seq + k, cuts - bounds[k])

    def run(batches):
        from pyspark import TaskContext

        base, encode, at, held = TaskContext.get().partitionId() << PART_BITS, worker_encoder(path), 0, []
        for b in batches:
            if not len(b):
                continue
            ids, n = encode(*text_bytes(b.column("text")))
            row, start, place, length = cut_stream(at, n, seq_len)
            edges = 4 * np.append(place - at, len(ids))
            pieces = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(ids)])
            at += len(ids)
            batch = record(b.column("doc_id").take(pa.array(row)), start, length, pieces, n[row], base + place // seq_len, place % seq_len)
            open_ = int(np.searchsorted(place, at - at % seq_len))  # pieces from here on lie in a sequence that isn't full yet
            if open_:
                for h in held:
                    yield narrow(h)
                held = []
                for i in range(0, open_, 512):
                    yield narrow(batch.slice(i, min(512, open_ - i)))
            held.append(batch.take(pa.array(np.arange(open_, len(row)))))  # a copy: the batch itself may go
        rest = pa.concat_tables([pa.table(h) for h in held]) if held else None
        if rest is not None and rest.num_rows:
            yield narrow(recut(rest, at // seq_len + base))

    return rows.mapInArrow(run, schema)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
