"""Sinks (SK1-SK7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellflux.operators.fields import with_attrs


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SK1: header CSV (one folder of part files)."""
    df.write.mode(mode).option("header", True).csv(path)


def write_layer(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """SK2: a vector layer as Parquet, or as GeoJSON-like lines (``fmt="json"``)."""
    if fmt == "json":
        df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode(mode).text(path)
    else:
        df.write.mode(mode).parquet(path)


def write_field(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SK3: a gridded field with attributes, partitioned by species and month.

    A rebalance on the partition columns keeps a task from writing a file in
    each folder; unlike a repartition, Spark splits a large (species, month)
    over several tasks.
    """
    out = with_attrs(df)
    parts = [c for c in ("species", "month") if c in out.columns]
    out.hint("rebalance", *parts).write.mode(mode).partitionBy(*parts).parquet(path)


def write_by_species(files: DataFrame, path: str, pattern: str = r"_([A-Za-z0-9.]+)_emi_", mode: str = "overwrite") -> None:
    """SK4: split an inventory by the species named in each file name."""
    out = files.withColumn("species", F.regexp_extract(F.col("path"), pattern, 1))
    out.hint("rebalance", "species").write.mode(mode).partitionBy("species").parquet(path)


def station_json_lines(docs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SK6: one JSON document per line."""
    docs.select(F.col("json").alias("value")).write.mode(mode).text(path)
