"""Grouping operators: sums by key, keep-last, representatives, shares, numbering.

Every operator here is written so that a key holding a large share of the
rows is never gathered into one task:

* aggregates are declarative (``sum``, ``count``, ``max_by``) and so run as
  partial (map-side) + final aggregation - a hot key is reduced before the
  shuffle;
* group totals are computed by ``groupBy`` and joined back instead of a
  ``Window.partitionBy`` (a window partition is processed by one task);
  AQE's skew-join handling splits a hot key on the large side of that join;
* numbering uses a window for groups that fit a task (``serial``); groups of
  any size are range-partitioned over many tasks with per-partition offsets
  (``range_serial``), as are rows that need their successor
  (``with_successor``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(names: str | Iterable[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def sum_by(df: DataFrame, key: str | Sequence[str], cols: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """A1: sum of one or more measures by key; ``cols`` maps input -> output name."""
    mapping = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}
    keys = _cols(key)
    return df.where(_not_null(keys)).groupBy(*keys).agg(
        *[F.sum(src).alias(dst) for src, dst in mapping.items()]
    )


def count_by(df: DataFrame, key: str | Sequence[str], name: str = "n") -> DataFrame:
    """A3: rows per key (null keys dropped, as a pandas group-by would)."""
    keys = _cols(key)
    return df.where(_not_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def _last_rows(df: DataFrame, keys: Sequence[str], order: str, payload: Sequence[str]) -> DataFrame:
    """The payload of each key's last row: a hash aggregate finds the last order, a join on (key, order) fetches the row.

    (``max_by`` over text or structs would sort all rows before the map-side
    reduce.)  Rows of one key that tie in ``order`` are reduced to one.
    """
    top = df.groupBy(*keys).agg(F.max(order).alias("_cf_top"))
    a, b = df.select(*keys, F.col(order).alias("_cf_top"), *[F.col(c).alias(f"_cf_p{i}") for i, c in enumerate(payload)]).alias("a"), top.alias("b")
    on = F.col("a._cf_top") == F.col("b._cf_top")
    for k in keys:
        on = on & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    got = a.join(b, on, "left_semi").dropDuplicates([*keys, "_cf_top"])
    return got.select(*keys, *[F.col(f"_cf_p{i}").alias(c) for i, c in enumerate(payload)])


def keep_last(df: DataFrame, key: str | Sequence[str], order: str) -> DataFrame:
    """One row per key, the one that is last in ``order``.

    ``order`` must be unique within a key (a source row number), as "last"
    presumes.  Partial aggregates reduce a hot key before the shuffle.
    """
    keys = _cols(key)
    fixed = {"tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz"}
    payload = [c for c in df.columns if c not in keys]
    kinds = dict(df.dtypes)
    if all(kinds[c] in fixed for c in payload):  # fixed-width values keep max_by a hash aggregate
        return df.groupBy(*keys).agg(*[F.max_by(F.col(c), F.col(order)).alias(c) for c in payload])
    return _last_rows(df, keys, order, payload)


def sum_with_representative(
    df: DataFrame,
    key: str | Sequence[str],
    sums: Mapping[str, str],
    order: str,
    keep: Sequence[str] = (),
    count_name: str | None = None,
) -> DataFrame:
    """Sums per key plus the attributes of the key's last row, in one hash aggregate of fixed-width columns."""
    keys = _cols(key)
    aggs = [F.sum(src).alias(dst) for src, dst in sums.items()]
    aggs += [F.max_by(F.col(c), F.col(order)).alias(c) for c in keep]
    if count_name:
        aggs.append(F.count(F.lit(1)).alias(count_name))
    out = df.groupBy(*keys).agg(*aggs)
    return out.select(*keys, *sums.values(), *([count_name] if count_name else []), *keep)


def with_group_count(df: DataFrame, key: str | Sequence[str], name: str = "group_count") -> DataFrame:
    """Attach the row count of each row's group (group-by + join back, not a window)."""
    keys = _cols(key)
    counts = count_by(df, keys, name)
    return df.join(counts, keys, "left")


def equal_share(df: DataFrame, key: str | Sequence[str], count_name: str = "grid_count", share_name: str = "share") -> DataFrame:
    """Each row's share ``1/count`` within its group."""
    out = with_group_count(df, key, count_name)
    return out.withColumn(share_name, F.lit(1.0) / F.col(count_name))


def split_equally(df: DataFrame, total: str, key: str | Sequence[str], name: str) -> DataFrame:
    """A group total divided equally over the group's rows."""
    out = with_group_count(df, key, "_cf_n")
    return out.withColumn(name, F.col(total) / F.col("_cf_n")).drop("_cf_n")


def category_share(
    df: DataFrame,
    cat: str,
    length: str,
    weights: Mapping[str, tuple[float, float]],
    computed_totals: bool = False,
    name: str = "lpc",
    pieces: DataFrame | None = None,
) -> DataFrame:
    """``length / category total * weight``; unknown categories get 0.

    With ``computed_totals=False`` the totals come from ``weights`` (as in the
    published method) and the share is one generated CASE expression.  With
    ``computed_totals=True`` the totals are summed over the categories of
    ``weights`` from ``pieces`` (rows of ``cat`` and ``length`` that add up to
    ``df``; ``df`` itself if not given) by a partial aggregate - the total
    table has at most ``len(weights)`` rows, so its broadcast is bounded by
    the factor table.
    """
    if not computed_totals:
        expr: Column | None = None
        for c, (total, w) in weights.items():
            term = F.col(length) / F.lit(float(total)) * F.lit(float(w))
            expr = F.when(F.col(cat) == c, term) if expr is None else expr.when(F.col(cat) == c, term)
        expr = F.lit(0.0) if expr is None else expr.otherwise(F.lit(0.0))
        return df.withColumn(name, expr)
    spark = df.sparkSession
    wdf = spark.createDataFrame(
        [(c, float(w)) for c, (_, w) in weights.items()], "_cf_cat string, _cf_w double"
    )
    totals = (
        (df if pieces is None else pieces).where(F.col(cat).isin(list(weights)))
        .groupBy(F.col(cat).alias("_cf_cat"))
        .agg(F.sum(length).alias("_cf_total"))
        .join(F.broadcast(wdf), "_cf_cat")
    )
    out = df.join(F.broadcast(totals), df[cat] == totals["_cf_cat"], "left")
    share = F.when(
        F.col("_cf_total").isNotNull(),
        F.try_divide(F.col(length), F.col("_cf_total")) * F.col("_cf_w"),
    ).otherwise(F.lit(0.0))
    return out.withColumn(name, share).drop("_cf_cat", "_cf_total", "_cf_w")


def serial(
    df: DataFrame,
    order: str | Sequence[str],
    by: str | Sequence[str],
    name: str = "sn",
    start: int = 1,
) -> DataFrame:
    """Dense numbering ``start..`` within ``by`` groups, in ``order``.

    One window over the groups: a group is sorted in one task, so this is
    for groups that fit one (the lines of a log file, the stops of a route).
    ``range_serial`` numbers groups of any size, and whole tables.  Ties in
    ``order`` are numbered in an arbitrary order, as with ``row_number``.
    """
    w = Window.partitionBy(*_cols(by)).orderBy(*_cols(order))
    return df.withColumn(name, (F.row_number().over(w) + F.lit(start - 1)).cast("long"))


def range_serial(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    name: str = "sn",
    start: int = 1,
    num_partitions: int | None = None,
) -> DataFrame:
    """Numbering of large groups (or of the whole table) without one-task windows.

    Rows are range-partitioned on (by, order), so a large group spans many
    partitions; each partition numbers its rows from
    ``monotonically_increasing_id`` and a small (partition, group) table of
    counts supplies each slice's offset.  That table has at most
    ``#partitions + #groups`` rows.
    """
    by_cols = list(by)
    order_cols = list(order)
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*by_cols, *order_cols]
    # The range partitioning is sampled at run time, so two reads of an
    # uncheckpointed plan could cut partitions differently; a reliable
    # checkpoint (spark.checkpoint.dir) fixes partitions and their order for
    # both the offset table and the rows, and survives executor loss.
    fixed = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).checkpoint(eager=True)
    parted = fixed.withColumn("_cf_mid", F.monotonically_increasing_id()).withColumn(
        "_cf_pid", F.spark_partition_id()
    )
    slices = parted.groupBy("_cf_pid", *by_cols).agg(
        F.min("_cf_mid").alias("_cf_m0"), F.count(F.lit(1)).alias("_cf_n")
    )
    w = Window.partitionBy(*by_cols).orderBy("_cf_pid") if by_cols else Window.orderBy("_cf_pid")
    slices = slices.withColumn("_cf_off", F.sum("_cf_n").over(w) - F.col("_cf_n"))
    out = parted.join(slices, ["_cf_pid", *by_cols])
    return out.withColumn(
        name, F.col("_cf_mid") - F.col("_cf_m0") + F.col("_cf_off") + F.lit(start)
    ).drop("_cf_mid", "_cf_pid", "_cf_m0", "_cf_n", "_cf_off")


def with_next(
    df: DataFrame, seq: str, by: str | Sequence[str] = (), cols: Sequence[str] = (), prefix: str = "next_"
) -> DataFrame:
    """``lead``: each row gets ``cols`` of the row numbered ``seq + 1`` in its group.

    No window and no self join: every row is emitted twice - under its own
    key (group, seq) and as the successor of (group, seq - 1) - and one
    aggregate on (group, seq) pairs them.  Each key has at most two rows, so
    no key is hot, and the input is read once.  Values are carried as plain
    columns (one ``max`` each, null on the other copy), so numeric payloads
    use the hash aggregate.  ``seq`` must be dense (see ``serial``); the
    last row of a group gets nulls.
    """
    by_cols = _cols(by)
    schema = {f.name: f.dataType for f in df.schema.fields}
    payload = [c for c in df.columns if c not in by_cols and c != seq]

    def copy(key: Column, me: bool) -> Column:
        fields = [key.alias("k"), F.lit(1 if me else 0).alias("me")]
        fields += [(F.col(c) if me else F.lit(None).cast(schema[c])).alias(f"p_{c}") for c in payload]
        fields += [(F.lit(None).cast(schema[c]) if me else F.col(c)).alias(f"n_{c}") for c in cols]
        return F.struct(*fields)

    both = df.select(*by_cols, F.explode(F.array(copy(F.col(seq), True), copy(F.col(seq) - F.lit(1), False))).alias("_cf_e"))
    paired = both.groupBy(*by_cols, F.col("_cf_e.k").alias(seq)).agg(
        F.max("_cf_e.me").alias("_cf_me"),
        *[F.max(f"_cf_e.p_{c}").alias(c) for c in payload],
        *[F.max(f"_cf_e.n_{c}").alias(prefix + c) for c in cols],
    )
    return paired.where(F.col("_cf_me") == 1).drop("_cf_me")


def with_successor(
    df: DataFrame, order: Sequence[str], by: Sequence[str] = (), cols: Sequence[str] = (), prefix: str = "next_", num_partitions: int | None = None
) -> DataFrame:
    """``lead`` for groups of any size: each row gets ``cols`` of the row after it in its group, in ``order`` (unique in a group).

    Rows are range-partitioned on (by, order), so a large group spans many
    slices.  Inside a slice the row after is a window over the slice; the last
    row of a slice gets the first row of the next one, of which there is one
    for each slice.  The last row of a group gets nulls.
    """
    spark = df.sparkSession
    keys, order_cols = list(by), list(order)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    along = [*keys, *order_cols]
    # fixed slices: both reads below see the same ones, also after an executor is lost
    fixed = df.repartitionByRange(n, *along).sortWithinPartitions(*along).checkpoint(eager=True).withColumn("_cf_pid", F.spark_partition_id())
    head = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(along)], *[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    first = {r["_cf_pid"]: r["h"] for r in fixed.groupBy("_cf_pid").agg(F.min_by(head, F.struct(*along)).alias("h")).collect()}  # one row a slice
    rows, after = [], None
    for p in reversed(range(fixed.rdd.getNumPartitions())):
        rows.append((p, after))
        after = first.get(p, after)
    kind = fixed.select(head.alias("h")).schema["h"].dataType.simpleString()
    borders = spark.createDataFrame(rows, f"_cf_pid int, _cf_border {kind}")
    slice_ = Window.partitionBy("_cf_pid").orderBy(*along)
    out = fixed.withColumn("_cf_lead", F.lead(head).over(slice_)).join(F.broadcast(borders), "_cf_pid", "left")
    out = out.withColumn("_cf_lead", F.coalesce("_cf_lead", "_cf_border"))
    mine = F.col("_cf_lead").isNotNull()
    for i, k in enumerate(keys):
        mine = mine & F.col(k).eqNullSafe(F.col(f"_cf_lead.o{i}"))
    return out.select(*df.columns, *[F.when(mine, F.col(f"_cf_lead.c{i}")).alias(prefix + c) for i, c in enumerate(cols)])


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Row-wise concatenation by column name (missing columns become null)."""
    out = None
    for d in dfs:
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out
