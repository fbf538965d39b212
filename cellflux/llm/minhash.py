"""Near-duplicate classes by one-permutation MinHash, optimal densification and star-shaped candidates.

A document's set: distinct shingles of ``shingle`` words (words are runs of
non-space, A-Z lower-cased); fewer words are one shingle, none is no set.

1. Sketch.  One hash per shingle; its high part picks one of ``BINS`` bins,
   the smallest hash in a bin is the bin's value, and an empty bin takes the
   value of the first full bin that its own random probe sequence meets
   (optimal densification).  ``BANDS`` bands of ``ROWS`` bins give bucket
   keys.  A pair at similarity 0.8 shares no bucket with probability
   (1 - 0.8**5)**32, about 3e-6.
2. Copies.  Documents with equal sets are one class; only the class's
   smallest doc_id goes on.
3. Stars.  In a bucket every member is paired with the bucket's centre, so a
   bucket of m members gives m - 1 candidate pairs.  The centre is the member
   that meets the most others over all its buckets: in a group of edited
   copies that is the original, which all copies resemble most.
4. Confirmation on full sets: 100 * intersection >= 80 * union.  Each
   confirmation also keeps the member's difference from the centre: its size
   and a bitmap.
5. Components by alternating large-star and small-star steps.
6. A star misses a link between two members if one of them isn't linked to
   the centre.  For sets x, y and centre c, the differences dx = x ^ c and
   dy = y ^ c (symmetric) satisfy |x ^ y| = |dx| + |dy| - 2 |dx & dy|, and x, y are
   similar just if |x ^ y| <= (|x| + |y|) / 9.  So members that aren't linked
   to their centre meet the star's members of other components, and a pair
   goes on only if the bitmaps allow enough common difference (an upper
   bound, so nothing is lost).  Edited copies differ from the original in
   other places each, so hardly any pair goes on; those that do are confirmed
   on full sets.  So no link inside a bucket is lost, and linked groups are never
   paired again.

Defined results: texts without words have an empty set and are linked with
nothing; a null doc_id is linked with nothing, has a null component and is
kept; rows that share a doc_id are one document; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellflux.llm.common import (
    LOWER, NOT_SPACE, Roller, blocks, bloom, bloom_bits, discard, grams, in_bloom, materialise, mix, prepare, table, text_bytes, text_key, words,
)

BANDS, ROWS = 32, 5
BINS = BANDS * ROWS
SIMILAR = 80  # per cent
ROLL = Roller(3)
#: Random probes of each bin for densification, then its right neighbours in turn (so that the search always ends).
PROBES = np.concatenate([np.random.default_rng(11).integers(0, BINS, (48, BINS)), (np.arange(1, BINS)[:, None] + np.arange(BINS)) % BINS]).astype(np.int16)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, shingle: int) -> list[np.ndarray]:
    """Of every row: its distinct shingle hashes, ascending."""
    start, end, first = words(data, bounds, NOT_SPACE)
    wh = ROLL.spans(ROLL.prefix(data, LOWER), start, end)
    g = grams(wh, shingle)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= shingle:
            out.append(np.unique(g[a : b - shingle + 1]))
        elif b > a:
            out.append(grams(wh[a:b], int(b - a), 0x9FB21C651E98DF25))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(u: np.ndarray) -> np.ndarray:
    """One-permutation MinHash of an ascending set of hashes, densified."""
    bins = ((u >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    lead = np.flatnonzero(np.diff(bins, prepend=-1))
    sig = np.zeros(BINS, np.uint64)
    full = np.zeros(BINS, bool)
    sig[bins[lead]] = u[lead]
    full[bins[lead]] = True
    empty = np.flatnonzero(~full)
    for probe in PROBES:
        if not len(empty):
            break
        at = probe[empty]
        ok = full[at]
        sig[empty[ok]] = sig[at[ok]]
        empty = empty[~ok]
    return sig


def bucket_keys(u: np.ndarray) -> np.ndarray:
    bands = signature(u).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for j in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, j])
    return key.view(np.int64)


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """Per row: doc_id, key, n_shingles, digest (of the whole set; null if empty), buckets."""
    rows = docs.select("doc_id", text_key().alias("key"), "text")

    def run(batches):
        for b in batches:
            data, bounds = text_bytes(b.column("text"))
            for i, j, d, o in blocks(data, bounds):
                sets = shingle_sets(d, o, shingle)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id").slice(i, j - i), b.column("key").slice(i, j - i),
                        pa.array([len(u) for u in sets], pa.int64()),
                        pa.array([hashlib.blake2b(u.tobytes(), digest_size=16).digest() if len(u) else None for u in sets], pa.binary()),
                        pa.array([bucket_keys(u) if len(u) else None for u in sets], pa.list_(pa.int64())),
                    ], names=["doc_id", "key", "n_shingles", "digest", "buckets"])

    schema = T.StructType([
        rows.schema["doc_id"], T.StructField("key", T.LongType()), T.StructField("n_shingles", T.LongType()),
        T.StructField("digest", T.BinaryType()), T.StructField("buckets", T.ArrayType(T.LongType()))])
    return rows.mapInArrow(run, schema)


def sets_of(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """id, set (array of hashes) of the documents in ``ids``: a Bloom bitmap of the ids keeps other texts out of the shuffle."""
    spark = docs.sparkSession
    hashed = ids.select(F.xxhash64("id").alias("h"))
    wanted = spark.sparkContext.broadcast(bloom(hashed, "h", bloom_bits(ids.count())))
    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("id"), F.xxhash64("doc_id").alias("h"), "text")

    def run(batches):
        bitmap = wanted.value
        for b in batches:
            keep = in_bloom(bitmap, b.column("h").to_numpy().view(np.uint64))
            if not keep.any():
                continue
            b = b.filter(pa.array(keep))
            data, bounds = text_bytes(b.column("text"))
            for i, j, d, o in blocks(data, bounds):
                sets = [u.view(np.int64) for u in shingle_sets(d, o, shingle)]
                yield pa.RecordBatch.from_arrays([b.column("id").slice(i, j - i), pa.array(sets, pa.list_(pa.int64()))], names=["id", "set"])

    return rows.mapInArrow(run, T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("set", T.ArrayType(T.LongType()))]))


PAIR = "na long, nb long, inter long, diff long, spare long, bits array<long>"
DIFF_BITS = 2048


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of candidate pairs (a, b): set sizes, intersection, size of the symmetric difference, its bitmap, and by how much the size exceeds the bits set."""
    one = sets.select(F.col("id").alias("b"), F.col("set").alias("sb"))
    two = sets.select(F.col("id").alias("a"), F.col("set").alias("sa"))
    rows = pairs.select("a", "b").join(one, "b").join(two, "a").select("a", "b", "sa", "sb")

    def run(batches):
        for batch in batches:
            got = []
            flat = []
            for c in ("sa", "sb"):
                x = batch.column(c)
                flat.append((x.flatten().to_numpy(), np.concatenate([[0], np.cumsum(x.value_lengths().to_numpy())])))
            (va, oa), (vb, ob) = flat
            for i in range(len(batch)):
                z = np.concatenate([va[oa[i] : oa[i + 1]], vb[ob[i] : ob[i + 1]]])
                z.sort()
                twice = np.zeros(len(z) + 1, bool)
                twice[1:-1] = z[1:] == z[:-1]
                diff = z[~(twice[1:] | twice[:-1])]
                bits = np.zeros(DIFF_BITS, bool)
                bits[diff & (DIFF_BITS - 1)] = True
                got.append((oa[i + 1] - oa[i], ob[i + 1] - ob[i], int(twice.sum()), len(diff), len(diff) - int(bits.sum()), np.packbits(bits).view(np.int64)))
            cols = list(zip(*got)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), *(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.list_(pa.int64()))],
                names=["a", "b", "na", "nb", "inter", "diff", "spare", "bits"])

    ids = rows.schema["a"].dataType.simpleString()
    return rows.mapInArrow(run, f"a {ids}, b {ids}, {PAIR}")


def linked() -> "F.Column":
    return F.col("inter") * 100 >= (F.col("na") + F.col("nb") - F.col("inter")) * SIMILAR


def components(edges: DataFrame) -> DataFrame:
    """id, comp (the smallest id reachable) of every id in ``edges`` (a, b) that isn't the smallest itself."""
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    seen = None
    while True:
        # large star: every larger neighbour of u is linked with the smallest of u and its neighbours
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: every smaller neighbour of u, and u, is linked with the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        new = materialise(small, "cc")
        state = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(now)
        now = new
        if state == seen:
            return now.select(F.col("u").alias("id"), F.col("v").alias("comp"))
        seen = state


def near_duplicates(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """Per row: doc_id, key, n_shingles, component_id (smallest doc_id reachable, itself included)."""
    prepare(docs.sparkSession)
    sk = materialise(sketches(docs, shingle), "sketches")
    classes = materialise(sk.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    reps = sk.join(classes, (sk.digest == classes.digest) & (sk.doc_id == classes.rep)).select("rep", "buckets")
    members = reps.select(F.explode("buckets").alias("bucket"), F.col("rep").alias("id"))
    # buckets of one member go no further
    shared = members.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("m")).where("lo <> hi")
    members = materialise(members.join(shared.select("bucket", "m"), "bucket"), "members")
    # priority: how many others a document meets, then a hash
    meets = members.groupBy("id").agg((F.shiftleft(F.least(F.sum("m"), F.lit(1 << 30)), 32) + F.xxhash64("id").bitwiseAND(F.lit((1 << 32) - 1))).alias("rank"))
    ranked = materialise(members.join(meets, "id").select("bucket", "id", "rank"), "ranked")
    top = ranked.groupBy("bucket").agg(F.max("rank").alias("rank"))
    centre = ranked.join(top, ["bucket", "rank"]).select("bucket", F.col("id").alias("a"))
    # also where the sizes rule out a link with the centre: the member may be linked with another
    pairs = ranked.join(centre, "bucket").where(F.col("id") != F.col("a")).select("a", F.col("id").alias("b")).distinct()
    pairs = materialise(pairs, "pairs")
    sets = materialise(sets_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), shingle), "sets")
    stars = materialise(compared(pairs, sets), "stars")
    edges = stars.where(linked()).select("a", "b")
    comp = components(edges)

    # pairs of a star's members that its centre doesn't join
    star = stars.join(comp.withColumnRenamed("id", "b"), "b", "left").withColumn("comp", F.coalesce("comp", "b"))
    side = lambda s: [F.col("b").alias(f"i{s}"), F.col("nb").alias(f"n{s}"), F.col("comp").alias(f"c{s}"), F.col("diff").alias(f"d{s}"), linked().alias(f"l{s}"), F.col("spare").alias(f"s{s}"), F.col("bits").alias(f"b{s}")]
    star = materialise(star, "open")
    x = star.where(~linked()).select("a", *side("x"))
    y = star.select("a", *side("y"))
    # common differences: one for each common bit at most, and what shares bits in the smaller one
    both = F.lit(0)
    for k in range(DIFF_BITS // 64):
        both = both + F.bit_count(F.col("bx")[k].bitwiseAND(F.col("by")[k]))
    most = both + F.least("sx", "sy")
    may = most * 18 >= (F.col("dx") + F.col("dy")) * 9 - (F.col("nx") + F.col("ny"))
    new = x.join(y, "a").where((F.col("cx") != F.col("cy")) & (F.col("ly") | (F.col("ix") < F.col("iy"))) & _sizes("nx", "ny") & may)
    new = materialise(new.select(F.least("ix", "iy").alias("a"), F.greatest("ix", "iy").alias("b")).distinct(), "pairs")
    found = materialise(compared(new, sets).where(linked()).select("a", "b"), "edges")
    if not found.isEmpty():
        comp = components(comp.select(F.col("id").alias("a"), F.col("comp").alias("b")).unionAll(found))

    for done in (members, ranked, pairs, sets, stars, star, new, found):
        discard(done)
    whole = classes.join(comp, F.col("rep") == F.col("id"), "left").select("digest", F.coalesce("comp", "rep").alias("component_id"))
    out = sk.select("doc_id", "key", "n_shingles", "digest").join(whole, "digest", "left")
    return out.select("doc_id", "key", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def _sizes(n: str, m: str):
    """Sets of these sizes can be similar enough."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * SIMILAR


def keep_one(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """One document of every class (the smallest doc_id), and all without an id, with their columns; of rows that share a doc_id, one."""
    got = near_duplicates(docs, shingle)
    go = got.where("doc_id IS NOT NULL")
    per = go.groupBy("doc_id").agg(F.min("component_id").alias("c"), F.min("key").alias("__cf_key"), F.count("*").alias("rows"))
    per = materialise(per, "kept")
    drop = per.where("c <> doc_id").select("doc_id")
    again = per.where("c = doc_id AND rows > 1").select("doc_id", "__cf_key")
    rest = docs.join(drop.unionAll(again.select("doc_id")), "doc_id", "left_anti")
    once = docs.join(again, "doc_id").where(text_key() == F.col("__cf_key")).drop("__cf_key").dropDuplicates(["doc_id"])
    return rest.unionByName(once)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = near_duplicates(table(spark, sf_dir, "documents"), shingle=2)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return got.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))
