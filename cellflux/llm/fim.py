"""Fill-in-the-middle transformation by secondary sort.

1. Cut.  Every text is cut into units (a word with the white space before it;
   trailing white space is the last unit), the units into prefix, middle and
   suffix by a keyed hash of the document id, and each part into pieces of at
   most ``PIECE_UNITS`` units.  A piece carries its document's key and its
   position in the output; a part's marker opens its first piece.
2. Assemble.  The pieces are dealt by document and sorted by (document, output
   position) inside each partition: one exchange and one sort, which is what
   ``repartitionAndSortWithinPartitions`` does on an RDD, with the sort in the
   JVM, where it spills.  One pass streams every document's pieces, in order,
   into a digest (or a text), a piece at a time.
3. Restore.  The same pass reads the markers back off the output, gives each
   piece its place in the original, and the partitions are sorted once more
   (no second exchange); another pass streams the restored text.

No group is gathered: a pass holds one piece and a running digest.  A
document's key is its id, its text's hash and the input partition it came
from, so a row that is repeated a million times is spread over as many groups
as there are partitions; its copies meet as adjacent equal pieces and are
counted.

Defined results: null text counts as empty; an empty text is ``plain`` with 0
units; a null id hashes as no digits; rows that repeat come back as often;
ties of the two cut points leave an empty middle; a text of any length is cut
whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflux.llm.common import NOT_SPACE, blocks, prepare, table, text_bytes, text_key, words

SEED = 42
FIM_PERCENT, SPM_PERCENT = 50, 80  # documents that are transformed; of those, the ones with the suffix first
PIECE_UNITS = 2048
P, S, M = b"<P>", b"<S>", b"<M>"
PLACE = {P: 0, M: 1, S: 2}  # order of the parts in the original
CLOSE = 3  # after every part: the piece that ends a document

PIECE = "cf_id {}, cf_tk long, cf_src int, cf_pos long, cf_n long, cf_form string, cf_prefix long, cf_middle long, cf_digest string, cf_copies long, cf_bytes binary"
KEY = ("cf_id", "cf_tk", "cf_src")


def plan(doc_id, n: int, raw: bytes, seed: int = SEED, fim: int = FIM_PERCENT, spm: int = SPM_PERCENT) -> tuple[str, int, int]:
    """Form, and the units before the middle and before the suffix."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not raw or h3 % 100 >= fim or P in raw or S in raw or M in raw:
        return "plain", a, b
    return ("spm" if h4 % 100 < spm else "psm"), a, b


def cuts_of(s: np.ndarray, e: np.ndarray, first: int, last: int, start: int, end: int) -> np.ndarray:
    """Byte ends of a text's units, led by its start: its words first ... last - 1 and the white space after them."""
    ends = e[first:last]
    tail = end > (int(ends[-1]) if len(ends) else start)
    return np.concatenate(([start], ends, [end] if tail else [])).astype(np.int64)


def pieces(docs: DataFrame, seed: int = SEED, fim: int = FIM_PERCENT, spm: int = SPM_PERCENT, units: int = PIECE_UNITS) -> DataFrame:
    """The output pieces of every document (schema ``PIECE``); counts and form stand on the piece at position 0."""
    rows = docs.select(F.col("doc_id").alias("cf_id"), text_key().alias("cf_tk"), F.coalesce("text", F.lit("")).alias("cf_text"))
    schema = PIECE.format(docs.schema["doc_id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        src = TaskContext.get().partitionId()
        for batch in batches:
            kind = batch.column("cf_id").type
            ids, tks = batch.column("cf_id").to_pylist(), batch.column("cf_tk").to_pylist()
            data, bounds = text_bytes(batch.column("cf_text"))
            for i, j, part, b in blocks(data, bounds):
                s, e, at = words(part, b, NOT_SPACE)
                points = np.zeros(len(part) + 1, np.int64)
                np.cumsum((part & 0xC0) != 0x80, out=points[1:])
                raw, out = part.tobytes(), {c: [] for c in ("id", "tk", "pos", "n", "form", "prefix", "middle", "bytes")}
                for r in range(j - i):
                    start, end = int(b[r]), int(b[r + 1])
                    cut = cuts_of(s, e, int(at[r]), int(at[r + 1]), start, end)
                    n = len(cut) - 1
                    form, x, y = plan(ids[i + r], n, raw[start:end], seed, fim, spm)
                    if form == "plain":
                        parts, chars = [(b"", 0, n)], (None, None)
                    else:
                        parts = [(P, 0, x), (S, y, n)] if form == "psm" else [(S, y, n), (P, 0, x)]
                        parts.append((M, x, y))
                        chars = int(points[cut[x]] - points[start]), int(points[cut[y]] - points[cut[x]])
                    pos = 0
                    for mark, u, v in parts:
                        while True:
                            w = min(u + units, v)
                            head = pos == 0
                            out["id"].append(ids[i + r])
                            out["tk"].append(tks[i + r])
                            out["pos"].append(pos)
                            out["n"].append(n if head else None)
                            out["form"].append(form if head else None)
                            out["prefix"].append(chars[0] if head else None)
                            out["middle"].append(chars[1] if head else None)
                            out["bytes"].append(mark + raw[cut[u] : cut[w]])
                            pos, mark, u = pos + 1, b"", w
                            if u >= v:
                                break
                k = len(out["id"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["id"], kind), pa.array(out["tk"], pa.int64()), pa.array([src] * k, pa.int32()), pa.array(out["pos"], pa.int64()), pa.array(out["n"], pa.int64()), pa.array(out["form"], pa.string()),
                     pa.array(out["prefix"], pa.int64()), pa.array(out["middle"], pa.int64()), pa.nulls(k, pa.string()), pa.array([1] * k, pa.int64()), pa.array(out["bytes"], pa.binary())],
                    names=[c.split()[0] for c in schema.split(", ")])

    return rows.mapInArrow(run, schema)


class Stream:
    """What the pieces of one document are streamed into: a digest, or the text itself."""

    def __init__(self, digest: bool):
        self.into = hashlib.sha256() if digest else bytearray()
        self.add = self.into.update if digest else self.into.extend

    def value(self) -> str:
        return self.into.decode() if isinstance(self.into, bytearray) else self.into.hexdigest()


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def assembled(cut: DataFrame, digest: bool = True) -> DataFrame:
    """Pieces in output order go into ``cf_digest`` (a digest or the output itself), and on as pieces of the original.

    The input's partitions must each hold whole documents, sorted by (document, output position).
    """
    names = cut.columns

    def run(batches):
        held, size, key = [], 0, None

        def close():
            return (*key, CLOSE << 40, *meta, stream.value(), copies, b"")

        for batch in batches:
            schema = batch.schema
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                raw, pos = row[-1], row[3]
                if row[:3] != key:
                    if key is not None:
                        held.append(close())
                    key, meta, copies, last, place, k, stream = row[:3], row[4:8], 0, -1, 0, 0, Stream(digest)
                if pos == 0:
                    copies += 1
                if pos == last:  # the same piece of another copy of the row
                    continue
                last = pos
                stream.add(raw)
                if meta[1] != "plain" and raw[:3] in PLACE:  # the text holds no marker, so a piece that opens with one opens a part
                    place, raw = PLACE[raw[:3]], raw[3:]
                held.append((*key, (place << 40) + k, None, None, None, None, None, None, raw))
                k, size = k + 1, size + len(raw)
                if size > 1 << 22 or len(held) > 4096:
                    yield _record(held, schema)
                    held, size = [], 0
        if key is not None:
            held.append(close())
            yield _record(held, schema)

    return cut.mapInArrow(run, cut.schema)


def restored(parts: DataFrame, digest: bool = True) -> DataFrame:
    """Pieces in original order go into the restored text (or its digest); one row a copy of the document."""
    names = parts.columns
    kind = parts.schema["cf_id"].dataType.simpleString()
    made = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string, restored string"

    def run(batches):
        stream = Stream(digest)
        for b in batches:
            held = []
            for row in zip(*(b.column(c).to_pylist() for c in names)):
                if row[3] >> 40 != CLOSE:
                    stream.add(row[-1])
                    continue
                held += [(row[0], *row[4:9], stream.value())] * row[9]
                stream = Stream(digest)
            if held:
                types = [b.column("cf_id").type, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=[c.split()[0] for c in made.split(", ")])

    return parts.mapInArrow(run, made)


def transform(docs: DataFrame, digest: bool = False, seed: int = SEED, fim: int = FIM_PERCENT, spm: int = SPM_PERCENT, units: int = PIECE_UNITS) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output, restored of every row: texts, or with ``digest`` their SHA-256."""
    prepare(docs.sparkSession)
    dealt = pieces(docs, seed, fim, spm, units).repartition(*KEY).sortWithinPartitions(*KEY, "cf_pos")
    return restored(assembled(dealt, digest).sortWithinPartitions(*KEY, "cf_pos"), digest)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = transform(table(spark, sf_dir, "documents"), digest=True)
    return out.withColumnRenamed("output", "output_sha256").withColumnRenamed("restored", "restored_sha256")
