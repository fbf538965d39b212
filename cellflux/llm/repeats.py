"""Removal of byte strings that occur twice, by threshold-bounded interval expansion on a Burrows-Wheeler transform.

A byte of a document is removed if a string of ``length`` bytes that covers
it also starts at any other place of any document (the same one included;
overlaps count).  Matches never cross documents.

No corpus-wide suffix array: strings meet by anchors.  The anchor of a
``length``-byte string is the place of the smallest hash among its
``GRAM``-byte grams (the first, at a tie), so equal strings have equal
anchors at equal offsets.  A text has an anchor in about (length - GRAM) / 2
bytes; the context of an anchor is the bytes of all strings whose anchor it
is.

1. Scan: digest, length and anchors of every text.  Texts with equal
   digests are copies: wholly removed if long enough, and one goes on.
2. All strings that have their anchor in their right half share a core of
   over half their length, and so have those with it in the left half.  Core
   hashes with two or more places are found by partial aggregates, and a
   Bloom bitmap of them (16 MB at most) selects contexts in a second scan.
3. Equal contexts at two places are repeats as they stand; one of them goes on.
4. The distinct contexts of an anchor are indexed together, many anchors to
   a block of bounded size: suffix order, Burrows-Wheeler transform, then
   breadth-first backward extension from the empty string. An interval of
   common-prefix length l gives intervals of length l + 1, each new right
   end fixes a common-prefix value, and values come in increasing order, so
   the search stops at ``length``.  Runs of suffixes never cut share
   ``length`` bytes; a run with two places is a repeat.
5. An anchor with more than ``MOST_CONTEXTS`` distinct contexts does not fit a
   block: a passage that a large part of the corpus holds.  Equal strings
   have equal offsets from the anchor, so its index is split by offset: its
   strings are cut into cells of neighbouring offsets, and steps 3 and 4 are
   applied to the cells' contents, those of one cell with one common core
   together.  A core that still has too many contents goes into narrower
   cells; a cell of one offset has one content.
6. Removed spans are joined by digest; only texts with spans are read again.

Defined results: null or empty text has no bytes and nothing removed; rows
equal in text are copies, whatever their doc_id; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellflux.llm.common import Roller, blocks, bloom, bloom_bits, discard, in_bloom, materialise, mix, prepare, same, spread_join, table, text_bytes, text_key

LENGTH, GRAM = 400, 32
MOST_CONTEXTS = 512
BLOCK = 1 << 16  # bytes indexed at once, about
CELLS = (16, 4, 1)  # neighbouring offsets in a cell of a hot anchor, first to last
ROLL, ROLL2 = Roller(21), Roller(22)
EMPTY = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------------------
# anchors
# ---------------------------------------------------------------------------

def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values (minima of runs of 2, 4, 8, ... values)."""
    y, k = x, 1
    while 2 * k <= w:
        y = np.minimum(y[:-k], y[k:])
        k *= 2
    n = len(x) - w + 1
    return np.minimum(y[:n], y[w - k : w - k + n])


def anchors(prefix: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of a block of texts: row, place and gram hash of every anchor, and the first and last start of the strings whose anchor it is.

    Places count from the block's first byte.  A text's anchors are those of
    its own strings only.
    """
    none = np.zeros(0, np.int64)
    n = len(prefix) - 1
    if n < length:
        return none, none, none.astype(np.uint64), none, none
    places = n - GRAM + 1
    h = mix((prefix[GRAM:] - prefix[:-GRAM]) * ROLL.down[:places])
    bits = np.uint64(max(20, places.bit_length()))
    # high part: hash; low part: place, so that the smallest is the first of equal grams
    low = _window_min((h >> bits << bits) | np.arange(places, dtype=np.uint64), length - GRAM + 1)
    step = np.zeros(n + 1, np.int8)
    long = np.flatnonzero(np.diff(bounds) >= length)
    step[bounds[long]] += 1
    step[bounds[long + 1] - length + 1] -= 1
    start = np.flatnonzero(np.cumsum(step[: len(low)], dtype=np.int8))  # of the strings inside one text
    if not len(start):
        return none, none, none.astype(np.uint64), none, none
    at = (low[start] & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    lead = np.flatnonzero(np.diff(at, prepend=-1))
    at, first, last = at[lead], start[lead], start[np.append(lead[1:], len(start)) - 1]
    return np.searchsorted(bounds, at, side="right") - 1, at, h[at], first, last


def cores(prefix: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor two hashes: of the bytes that all its strings with the anchor in the right half share, and in the left half; and whether it has such strings."""
    back = length - GRAM
    half = back // 2
    out, has = np.zeros((2, len(at)), np.uint64), np.zeros((2, len(at)), bool)
    for k, (r1, r2) in enumerate(((-back, -half), (1 - half, 0))):
        has[k] = i = (first <= at + r2) & (last >= at + r1)
        i = np.flatnonzero(i)
        out[k, i] = ROLL.spans(prefix, at[i] + r2, at[i] + r1 + length) + np.uint64(k)
    return out, has


# ---------------------------------------------------------------------------
# Burrows-Wheeler index of a block
# ---------------------------------------------------------------------------

def suffix_order(t: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rotations of t sorted by their first ``depth`` symbols at least (prefix doubling from 8 symbols); the common
    prefix of each with the one before, where it is below 8 (else 8; -1 for the first)."""
    n = len(t)
    key = np.zeros(n, np.uint64)
    ring = np.concatenate([t, t[:8]]) if n >= 8 else np.resize(t, n + 8)
    for j in range(8):
        key = (key << np.uint64(8)) | ring[j : j + n].astype(np.uint64)
    rank = np.zeros(n, np.int64)
    order = np.argsort(key)
    k = key[order]
    differ = k[1:] ^ k[:-1]
    common = (differ == 0).astype(np.int8)
    for j in range(1, 8):
        common += differ < np.uint64(1 << (64 - 8 * j))
    common = np.concatenate([np.array([-1], np.int8), common])
    new = common < 8
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    step = 8
    while step < depth:
        # only rotations that are not alone with their rank are sorted on
        tied = np.flatnonzero(~(new & np.concatenate([new[1:], [True]])))
        if not len(tied):
            break
        at = order[tied]
        key = (rank[at].astype(np.uint64) << np.uint64(32)) | rank[(at + step) % n].astype(np.uint64)
        by = np.argsort(key)
        order[tied] = at = at[by]
        k = key[by]
        differs = np.concatenate([[True], k[1:] != k[:-1]])
        new[tied] |= differs
        rank[at] = np.maximum.accumulate(np.where(differs, tied, 0))
        step *= 2
    return order, common


def shared_runs(t: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of t, and for each place in it whether its common prefix with the one before is below ``length``.

    Breadth-first backward extension: intervals [lb, rb) of strings of l
    symbols, all l at once.  An element i of an interval maps to LF[i], the
    suffix one symbol longer to the left; the elements with one preceding
    symbol form the interval of the longer string.  Where that interval ends
    at a place without a value yet, the value is l, and the interval is
    extended in the next round.  Values below 8 are read off the sort keys.
    """
    n = len(t)
    order, common = suffix_order(t, length)
    bwt = t[order - 1]
    lf = np.empty(n, np.int32)
    lf[np.argsort(bwt, kind="stable")] = np.arange(n, dtype=np.int32)
    head = t[order]
    cut = np.append(common < min(8, length), True)
    owner = np.full(n + 1, -1, np.int32)
    # the strings of 8 symbols whose interval ends at a value of 7
    heads = np.flatnonzero(common < 8).astype(np.int32)
    lb, rb = heads, np.append(heads[1:], np.int32(n))
    fresh = (rb < n) & (common[np.minimum(rb, n - 1)] == 7)
    lb, rb = lb[fresh], rb[fresh]
    for _ in range(8, length):
        if not len(lb):
            break
        size = rb - lb
        q = np.repeat(np.arange(len(lb), dtype=np.int32), size)
        to = lf[np.arange(len(q), dtype=np.int32) + (lb - np.cumsum(size, dtype=np.int32) + size)[q]]
        owner[to] = q
        after = np.minimum(to + 1, n - 1)
        last = (to + 1 == n) | (owner[to + 1] != q) | (head[after] != head[to])
        first = (to == 0) | (owner[to - 1] != q) | (head[to - 1] != head[to])
        owner[to] = -1
        ends, starts = np.sort(to[last]) + 1, np.sort(to[first])
        fresh = ~cut[ends]
        cut[ends[fresh]] = True
        lb, rb = starts[fresh], ends[fresh]
    return order, cut[:n]


def repeated(texts: list[bytes], places: list[tuple[int, int]], length: int) -> list[np.ndarray]:
    """Of each text: the offsets whose ``length`` bytes occur at another place.  places: (document, first byte) of each text."""
    raw = np.frombuffer(b"".join(x + b"\0" for x in texts), np.uint8)
    size = np.array([len(x) + 1 for x in texts])
    start = np.cumsum(size) - size
    inside = np.ones(len(raw), bool)
    inside[start + size - 1] = False
    # the bytes in use (UTF-8 never has all 256) as 1, 2, ... in order; 0 parts the texts
    used = np.zeros(256, bool)
    used[raw[inside]] = True
    raw = np.where(inside, np.cumsum(used).astype(np.uint8)[raw], 0).astype(np.uint8)
    order, cut = shared_runs(raw, length)
    of = np.repeat(np.arange(len(texts)), size)[order]
    offset = order - start[of]
    doc, byte = np.array([p[0] for p in places])[of], np.array([p[1] for p in places])[of] + offset
    whole = offset + length <= size[of] - 1
    run = np.cumsum(cut) - 1
    at = np.flatnonzero(whole)
    out = [np.zeros(0, np.int64)] * len(texts)
    if not len(at):
        return out
    place = doc[at] * (1 << 40) + byte[at]
    group = run[at]
    heads = np.flatnonzero(np.diff(group, prepend=-1))
    two = np.minimum.reduceat(place, heads) != np.maximum.reduceat(place, heads)
    hit = at[two[np.cumsum(np.diff(group, prepend=-1) != 0) - 1]]
    by = np.argsort(of[hit], kind="stable")
    hit = hit[by]
    cuts = np.searchsorted(of[hit], np.arange(len(texts) + 1))
    return [np.sort(offset[hit[cuts[k] : cuts[k + 1]]]) for k in range(len(texts))]


def covered(offsets: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes under strings of ``length`` bytes at these ascending offsets."""
    if not len(offsets):
        return []
    gap = np.flatnonzero(np.diff(offsets) > length)
    a = offsets[np.concatenate([[0], gap + 1])]
    b = offsets[np.concatenate([gap, [len(offsets) - 1]])] + length
    return list(zip(a.tolist(), b.tolist()))


# ---------------------------------------------------------------------------
# scans
# ---------------------------------------------------------------------------

def _digest(x: bytes) -> bytes:
    return hashlib.blake2b(x, digest_size=16).digest()


def _own(row: pa.RecordBatch, digests: list[bytes]) -> np.ndarray:
    """A hash of each row's id and digest."""
    low = np.array([int.from_bytes(d[:8], "little") for d in digests], np.uint64)
    return low ^ row.column("rh").to_numpy().view(np.uint64)


def scan_rows(docs: DataFrame, length: int) -> DataFrame:
    """Per row: doc_id, key, own, digest, n_bytes, sha256 of the text, anchor hashes with places."""
    rows = docs.select("doc_id", text_key().alias("key"), F.xxhash64("doc_id").alias("rh"), "text")

    def run(batches):
        for b in batches:
            data, bounds = text_bytes(b.column("text"))
            for i, j, d, o in blocks(data, bounds):
                prefix = ROLL.prefix(d)
                texts = [d[lo:hi].tobytes() for lo, hi in zip(o[:-1], o[1:])]
                digests = [_digest(x) for x in texts]
                row, at, _, first, last = anchors(prefix, o, length)
                core, has = cores(prefix, at, first, last, length)
                k = np.flatnonzero(has.T.reshape(-1))  # in the order of rows
                off = np.searchsorted(row[k >> 1], np.arange(j - i + 1)).astype(np.int32)
                h = pa.ListArray.from_arrays(off, pa.array(core.T.reshape(-1)[k].view(np.int64), pa.int64()))
                at = pa.ListArray.from_arrays(off, pa.array((at - o[row])[k >> 1], pa.int64()))
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), pa.array(_own(part, digests).view(np.int64)), pa.array(digests, pa.binary()), pa.array(np.diff(o), pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()), h, at],
                    names=["doc_id", "key", "own", "digest", "n_bytes", "sha", "h", "at"])

    longs = T.ArrayType(T.LongType())
    return rows.mapInArrow(run, T.StructType([
        rows.schema["doc_id"], T.StructField("key", T.LongType()), T.StructField("own", T.LongType()), T.StructField("digest", T.BinaryType()),
        T.StructField("n_bytes", T.LongType()), T.StructField("sha", T.StringType()), T.StructField("h", longs), T.StructField("at", longs)]))


CONTEXT = "h long, c1 long, c2 long, occ long, digest binary, at long, start long, size long, bytes binary"


def scan_contexts(docs: DataFrame, chosen, shared, length: int) -> DataFrame:
    """Contexts of the anchors with a core in the bitmap ``shared``, of the rows in the bitmap ``chosen``.

    ``bytes`` is null where the context occurred before in the same block of
    rows: texts that repeat one word have an anchor at every word, all with
    the same context.
    """
    rows = docs.select(F.xxhash64("doc_id").alias("rh"), "text")

    def run(batches):
        for b in batches:
            data, bounds = text_bytes(b.column("text"))
            for i, j, d, o in blocks(data, bounds):
                prefix, prefix2 = ROLL.prefix(d), ROLL2.prefix(d)
                digests = [_digest(d[lo:hi].tobytes()) for lo, hi in zip(o[:-1], o[1:])]
                keep = in_bloom(chosen.value, _own(b.slice(i, j - i), digests))
                row, at, h, first, last = anchors(prefix, o, length)
                core, has = cores(prefix, at, first, last, length)
                ok = keep[row] & ((in_bloom(shared.value, core[0]) & has[0]) | (in_bloom(shared.value, core[1]) & has[1]))
                if not ok.any():
                    continue
                c = {"doc": row[ok], "at": (at - o[row])[ok], "h": h[ok], "lo": first[ok], "hi": last[ok] + length}
                base = o[c["doc"]]
                # how far the anchor is from the start is part of what makes contexts equal
                shift = ((base + c["at"] - c["lo"]).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                c1, c2 = ROLL.spans(prefix, c["lo"], c["hi"]) ^ shift, ROLL2.spans(prefix2, c["lo"], c["hi"]) + shift
                _, first = np.unique(c1, return_index=True)
                lead = np.zeros(len(c1), bool)
                lead[first] = True
                low = np.array([int.from_bytes(x[8:], "little") for x in digests], np.uint64)
                occ = mix(low[c["doc"]] + c["at"].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
                ids = pa.array(digests, pa.binary()).take(pa.array(c["doc"]))
                text = [d[x:y].tobytes() if k else None for x, y, k in zip(c["lo"], c["hi"], lead)]
                for s in range(0, len(c1), 4096):
                    z = slice(s, s + 4096)
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(x[z].view(np.int64)) for x in (c["h"], c1, c2, occ)), ids[z], pa.array(c["at"][z]), pa.array((c["lo"] - base)[z]), pa.array((c["hi"] - c["lo"])[z]), pa.array(text[z], pa.binary())],
                        names=["h", "c1", "c2", "occ", "digest", "at", "start", "size", "bytes"])

    return rows.mapInArrow(run, CONTEXT)


# ---------------------------------------------------------------------------
# repeats among the distinct contexts of an anchor
# ---------------------------------------------------------------------------

SPANS = "digest binary, a long, b long"


def _spans(rows: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
    d, a, b = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(d, pa.binary()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["digest", "a", "b"])


def block_repeats(contexts: DataFrame, length: int) -> DataFrame:
    """Removed spans found by the index of blocks; contexts of one anchor are never parted."""

    def run(batches):
        texts, places, ids, seen, held, last = [], [], [], {}, 0, None

        def flush():
            nonlocal held
            got = []
            for digest, (_, start), hits in zip(ids, places, repeated(texts, places, length)):
                got += [(digest, start + x, start + y) for x, y in covered(hits, length)]
            texts.clear(), places.clear(), ids.clear(), seen.clear()
            held = 0
            return got

        for b in batches:
            for h, digest, start, text in zip(*(b.column(c).to_pylist() for c in ("h", "digest", "start", "bytes"))):
                if held > BLOCK and h != last:
                    got = flush()
                    if got:
                        yield _spans(got)
                last = h
                texts.append(text), ids.append(digest)
                places.append((seen.setdefault(digest, len(seen)), start))
                held += len(text)
        if texts and (got := flush()):
            yield _spans(got)

    return contexts.select("h", "digest", "start", "bytes").repartition("h").sortWithinPartitions("h").mapInArrow(run, SPANS)


def cells_of(at: int, start: int, size: int, length: int, width: int) -> tuple[np.ndarray, ...]:
    """Of a context (bytes from ``start``, ``size`` of them, anchor at ``at``): cells with strings in it, and in
    bytes of the context the cell's first and last string start, and the ends of the content they cover."""
    back, lead = length - GRAM, at - start
    cell = np.arange(-(-(back + 1) // width))
    first = lead - back + cell * width
    last = np.minimum(first + width - 1, lead)
    ok = np.minimum(last, size - length) >= np.maximum(first, 0)
    cell, first, last = cell[ok], first[ok], last[ok]
    return cell, first, last, np.maximum(first, 0), np.minimum(last + length, size)


def cell_hashes(contexts: DataFrame, length: int, width: int) -> DataFrame:
    """Of every cell of every context: hash of the core that all its strings share, and two of its content."""

    def run(batches):
        for b in batches:
            out = []
            for h, occ, digest, at, start, text in zip(*(b.column(c).to_pylist() for c in ("h", "occ", "digest", "at", "start", "bytes"))):
                d = np.frombuffer(text, np.uint8)
                cell, first, last, x, y = cells_of(at, start, len(d), length, width)
                p, p2 = ROLL.prefix(d), ROLL2.prefix(d)
                core = ROLL.spans(p, last, first + length)
                side = (x - first).astype(np.uint64) * np.uint64(31) + np.uint64(7)
                s1, s2 = ROLL.spans(p, x, y) ^ side, ROLL2.spans(p2, x, y) + side
                out += [(h, *z, occ, digest) for z in zip(cell.tolist(), core.view(np.int64).tolist(), s1.view(np.int64).tolist(), s2.view(np.int64).tolist(), (start + x).tolist(), (start + y).tolist())]
            if out:
                names = ["h", "cell", "core", "s1", "s2", "a", "b", "occ", "digest"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "digest" else pa.int64()) for n, c in zip(names, zip(*out))], names=names)

    return contexts.mapInArrow(run, "h long, cell long, core long, s1 long, s2 long, a long, b long, occ long, digest binary")


def cell_contents(contexts: DataFrame, length: int, width: int) -> DataFrame:
    """The contents of the listed ``cells`` (cell, core, k) as contexts of their own: their ``h`` is of anchor, cell and core."""

    def run(batches):
        for b in batches:
            out = []
            for h, occ, digest, at, start, text, some in zip(*(b.column(c).to_pylist() for c in ("h", "occ", "digest", "at", "start", "bytes", "cells"))):
                cell, _, _, x, y = cells_of(at, start, len(text), length, width)
                ends = dict(zip(cell.tolist(), zip(x.tolist(), y.tolist())))
                for z in some:
                    lo, hi = ends[z["cell"]]
                    out.append((h, z["cell"], z["core"], z["k"], occ, digest, at, start + lo, text[lo:hi]))
            names = ["h", "cell", "core", "k", "occ", "digest", "at", "start", "bytes"]
            for s in range(0, len(out), 4096):
                part = zip(*out[s : s + 4096])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n in ("digest", "bytes") else pa.int64()) for n, c in zip(names, part)], names=names)

    got = contexts.mapInArrow(run, "h long, cell long, core long, k long, occ long, digest binary, at long, start long, bytes binary")
    return got.select(F.xxhash64("h", "cell", "core").alias("h"), "k", "occ", "digest", "at", "start", "bytes")


def hot_repeats(contexts: DataFrame, length: int, most: int) -> DataFrame:
    """Removed spans of anchors with very many contexts: their index split by offset, cells narrowed as far as needed."""
    found, key = [], ["h", "cell", "core"]
    for width in CELLS:
        cell = materialise(cell_hashes(contexts, length, width), "hot-cells")
        kinds = materialise(cell.groupBy(*key, "s1", "s2").agg(F.min("occ").alias("lo"), F.max("occ").alias("hi")), "hot-kinds")
        alike = kinds.where("lo <> hi").select(*key, "s1", "s2")
        found.append(materialise(spread_join(cell, [*key, "s1", "s2"], "occ", alike).select("digest", "a", "b"), "hot-spans"))
        # cores with several contents; of each content one place
        several = kinds.groupBy(*key).agg(F.count("*").alias("k")).where("k > 1")
        look = spread_join(kinds.select(*key, F.col("lo").alias("occ")), key, "occ", several)
        look = look.groupBy("h", "occ").agg(F.collect_list(F.struct("cell", "core", "k")).alias("cells"))  # a context's, (length - GRAM) / width at most
        inner = materialise(cell_contents(contexts.join(look, ["h", "occ"]), length, width), "hot-contents")
        found.append(materialise(block_repeats(inner.where(F.col("k") <= most), length), "hot-spans"))
        contexts = inner.where(F.col("k") > most).drop("k")
        for done in (cell, kinds):
            discard(done)
        if contexts.isEmpty():
            break
    out = found[0]
    for part in found[1:]:
        out = out.unionAll(part)
    return out


def repeats(docs: DataFrame, length: int = LENGTH, most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """Per row: doc_id, key, digest, n_bytes, sha, copies (rows with the same text), spans (removed, not yet merged; null: none)."""
    spark = docs.sparkSession
    prepare(spark)
    rows = materialise(scan_rows(docs, length), "repeat-rows")
    per = materialise(rows.groupBy("digest").agg(F.count("*").alias("copies"), F.min("own").alias("own")), "repeat-texts")
    # places of anchors, each text once (copies give the same place)
    place = F.xxhash64("digest", "p")
    found = rows.select("digest", F.explode(F.arrays_zip(F.col("h"), F.col("at").alias("p"))).alias("z")).select(F.col("z.h").alias("h"), "digest", F.col("z.p").alias("p"))
    shared = found.groupBy("h").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo <> hi").select("h")
    shared = materialise(shared, "repeat-anchors")
    chosen_bits = spark.sparkContext.broadcast(bloom(per, "own", bloom_bits(per.count())))
    shared_bits = spark.sparkContext.broadcast(bloom(shared, "h", bloom_bits(shared.count())))
    ctx = materialise(scan_contexts(docs, chosen_bits, shared_bits, length), "repeat-contexts")

    kinds = ctx.groupBy("h", "c1", "c2").agg(F.min("occ").alias("lo"), F.max("occ").alias("hi"), F.min(F.when(F.col("bytes").isNotNull(), F.col("occ"))).alias("occ"))
    kinds = materialise(kinds, "repeat-kinds")
    counts = kinds.groupBy("h").agg(F.count("*").alias("k")).where("k > 1")
    key = ["h", "c1", "c2"]
    spans = spread_join(ctx.select(*key, "occ", "digest", "start", "size"), key, "occ", kinds.where("lo <> hi").select(*key)).select("digest", F.col("start").alias("a"), (F.col("start") + F.col("size")).alias("b"))
    one = ctx.where("bytes IS NOT NULL").join(spread_join(kinds.select(*key, "occ"), ["h"], "c1", counts), [*key, "occ"]).dropDuplicates([*key, "occ"])
    one = materialise(one.select("h", "occ", "digest", "at", "start", "bytes", "k"), "repeat-distinct")
    spans = spans.unionAll(block_repeats(one.where(F.col("k") <= most_contexts), length))
    hot = one.where(F.col("k") > most_contexts)
    if not hot.isEmpty():
        spans = spans.unionAll(hot_repeats(hot, length, most_contexts))
    spans = spans.distinct().groupBy("digest").agg(F.collect_list(F.struct("a", "b")).alias("spans"))  # of one text
    out = spread_join(rows.drop("h", "at"), ["digest"], "own", per.select("digest", "copies")).drop("own")
    # copies long enough are removed whole, and shorter ones hold no string
    every = F.when(F.col("n_bytes") >= length, F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("n_bytes").alias("b"))))
    out = out.where("copies = 1").join(spans, "digest", "left").unionByName(out.where("copies > 1").withColumn("spans", every))
    out = materialise(out, "repeats")
    for done in (rows, per, shared, ctx, kinds, one):
        discard(done)
    return out


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def cut(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Of the rows with spans: doc_id, key, n_removed, n_spans, kept (the bytes that stay, concatenated)."""
    some = found.where(F.col("spans").isNotNull()).select(F.col("doc_id").alias("__cf_id"), F.col("key").alias("__cf_key"), "spans").dropDuplicates(["__cf_id", "__cf_key"])
    rows = docs.select("doc_id", text_key().alias("key"), "text")
    rows = rows.join(some, same(F.col("doc_id"), F.col("__cf_id")) & (F.col("key") == F.col("__cf_key"))).select("doc_id", "key", "text", "spans")

    def run(batches):
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            removed, n, kept = [], [], []
            for text, spans in zip(texts, b.column("spans").to_pylist()):
                runs = merged(spans)
                at = [0, *(x for r in runs for x in r), len(text)]
                kept.append(b"".join(text[at[k] : at[k + 1]] for k in range(0, len(at), 2)))
                removed.append(len(text) - len(kept[-1]))
                n.append(len(runs))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(removed, pa.int64()), pa.array(n, pa.int64()), pa.array(kept, pa.binary())], names=["doc_id", "key", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("key", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())]))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = repeats(docs)
    # copies are removed whole, so only other rows are cut
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    parts = cut(docs, found.where(~whole)).select(F.col("doc_id").alias("__cf_id"), F.col("key").alias("__cf_key"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha"))
    parts = parts.dropDuplicates(["__cf_id", "__cf_key"])
    out = found.join(parts, same(F.col("doc_id"), F.col("__cf_id")) & (F.col("key") == F.col("__cf_key")), "left")
    return out.select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(EMPTY)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"))
