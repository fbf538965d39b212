"""E1 counts -> mass (humidity corrected), rejects, and E13 newest reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellflux import factors
from cellflux.functions import numeric, text, timefmt
from cellflux.operators.aggregate import keep_last


def with_reading_parts(readings: DataFrame, time: str = "time") -> DataFrame:
    """split ``time`` into a DATE and the clock text."""
    day_txt, clock = timefmt.split_date_time(F.col(time))
    return readings.withColumn("date", timefmt.parse_day(day_txt)).withColumn("time2", clock)


def mass_columns(df: DataFrame, bands: Sequence[tuple[float, float, float]], strict: bool) -> DataFrame:
    cf = numeric.band_lookup(F.col("hum"), bands)
    if strict:
        cf = F.when(cf.isNull(), F.raise_error(F.concat(F.lit("humidity without band: "), F.col("hum").cast("string")))).otherwise(cf)
    m25 = F.col("pm05") * F.lit(factors.COUNT_TO_M3) * F.lit(factors.MASS_PM25)
    m10 = F.col("pm25") * F.lit(factors.COUNT_TO_M3) * F.lit(factors.MASS_PM10)
    rh = F.col("hum") * F.lit(factors.HUMIDITY_SCALE)
    return (
        df.withColumn("cf", cf)
        .withColumn("mass_pm25", m25)
        .withColumn("mass_pm10", m10)
        .withColumn("cmass_pm25", F.col("mass_pm25") * rh * F.col("cf"))
        .withColumn("cmass_pm10", F.col("mass_pm10") * rh * F.col("cf"))
    )


def count_to_mass(
    readings: DataFrame,
    weather: DataFrame,
    bands: Sequence[tuple[float, float, float]] = factors.HUMIDITY_BANDS,
    strict: bool = False,
) -> DataFrame:
    """Readings x daily humidity -> PM2.5/PM10 mass, humidity corrected.

    Left join + ``hum is not null`` (as written) - Catalyst turns it into an
    inner join and, when the weather side is small by its size estimate, a
    broadcast hash join; otherwise a sort-merge join on ``date``.  The band
    factor is one CASE expression in the same codegen stage.  Rows whose
    humidity is in no band keep ``cf = null`` (see ``rejects``) unless
    ``strict`` - then the job fails on the first such row.
    """
    r = with_reading_parts(readings)
    j = r.join(weather.select("date", "hum"), "date", "left").where(F.col("hum").isNotNull())
    return mass_columns(j, bands, strict)


def rejects(
    readings: DataFrame,
    weather: DataFrame,
    bands: Sequence[tuple[float, float, float]] = factors.HUMIDITY_BANDS,
) -> DataFrame:
    """Readings the conversion cannot use, counted by reason and day."""
    r = with_reading_parts(readings)
    j = r.join(weather.select("date", "hum"), "date", "left")
    cf = numeric.band_lookup(F.col("hum"), bands)
    reason = F.when(F.col("hum").isNull(), F.lit("no_weather")).when(cf.isNull(), F.lit("no_band"))
    return (
        j.withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .groupBy("reason", "date")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def reading_store(readings: DataFrame) -> DataFrame:
    """The stored form of readings: (sno, station_id, text = "time,pm05,pm25")."""
    return readings.select(
        "sno", "station_id",
        F.concat_ws(",", F.col("time"), F.col("pm05").cast("string"), F.col("pm25").cast("string")).alias("text"),
    )


def latest_reading(store: DataFrame, by: Sequence[str] = ("station_id",), order: str = "sno") -> DataFrame:
    """Newest stored reading (by serial) per station, with its fields 1 and 2.

    Each partition keeps only its newest serial per station before the
    shuffle; the row is then fetched by (station, serial).  With ``by=()`` it
    is the single newest row (``ORDER BY sno DESC LIMIT 1``).
    """
    keys = list(by)
    if keys:
        newest = keep_last(store.select(*keys, order, "text"), keys, order)
    else:
        newest = store.select(order, "text").orderBy(F.col(order).desc()).limit(1)
    line = text.clean_line(F.col("text"))
    return newest.select(*keys, order, "text", text.field(line, 1).alias("field1"), text.field(line, 2).alias("field2"))
