"""Streams run to completion equal the batch results."""

from pyspark.sql import functions as F

from cellflux.plans import mass
from cellflux.sources import fixtures as fx
from cellflux.streaming import sensor

from conftest import SF_SMALL


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_parse_lines(spark):
    lines = spark.createDataFrame([("2014-06-05T10:00,1200,85",), ("",), ("2014-06-05T10:01",)], "value string")
    got = sensor.parse_lines(lines).collect()
    assert [(r.time, r.pm05, r.pm25) for r in got] == [("2014-06-05T10:00", 1200, 85)]
    assert str(got[0].ts) == "2014-06-05 10:00:00"


def test_mass_stream_equals_batch(spark):
    weather = fx.weather(spark, SF_SMALL)
    stream = sensor.run_mass_stream(spark, SF_SMALL, weather)
    batch = mass.count_to_mass(fx.readings(spark, SF_SMALL), weather)
    cols = ["sno", "cf", "cmass_pm25", "cmass_pm10"]
    assert _rows(stream, cols) == _rows(batch, cols)


def test_latest_stream_equals_batch(spark):
    stream = sensor.run_latest_stream(spark, SF_SMALL)
    batch = mass.latest_reading(mass.reading_store(fx.readings(spark, SF_SMALL)))
    cols = ["station_id", "sno", "field1", "field2"]
    assert _rows(stream, cols) == _rows(batch, cols)


def test_hourly_stream_emits_closed_windows(spark):
    weather = fx.weather(spark, SF_SMALL)
    stream = sensor.run_hourly_stream(spark, SF_SMALL, weather)
    masses = mass.count_to_mass(fx.readings(spark, SF_SMALL), weather)
    wm = masses.agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    batch = masses.withColumn("ts", F.col("ts").cast("timestamp")).groupBy(F.window("ts", "1 hour").alias("w"), "station_id").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("w.end") <= F.lit(wm) - F.expr("INTERVAL 2 HOURS"))
    assert stream.count() == batch.count() > 0


def test_streams_over_several_micro_batches(spark, tmp_path):
    """Events arrive as three time-ordered files, one file per trigger."""
    import pyarrow.parquet as pq

    events = pq.read_table(f"{SF_SMALL}/events.parquet").to_pandas().sort_values("ts")
    cuts = [0, len(events) // 3, 2 * len(events) // 3, len(events)]
    chunks = [events.iloc[a:b] for a, b in zip(cuts, cuts[1:])]
    (tmp_path / "events.parquet").mkdir()  # a table stored as a folder of part files
    for k, chunk in enumerate(chunks):
        chunk.to_parquet(tmp_path / "events.parquet" / f"part-{k}.parquet", index=False)
    chunks[0].to_parquet(tmp_path / "events_other.parquet", index=False)  # another table
    folder = str(tmp_path)
    weather = fx.weather(spark, SF_SMALL)

    latest = sensor.run_latest_stream(spark, folder, max_files_per_trigger=1)
    batch_latest = mass.latest_reading(mass.reading_store(fx.readings(spark, SF_SMALL)))
    cols = ["station_id", "sno", "field1", "field2"]
    assert _rows(latest, cols) == _rows(batch_latest, cols)

    masses = sensor.run_mass_stream(spark, folder, weather, max_files_per_trigger=1)
    batch = mass.count_to_mass(fx.readings(spark, SF_SMALL), weather)
    assert _rows(masses, ["sno", "cmass_pm25"]) == _rows(batch, ["sno", "cmass_pm25"])

    hourly = sensor.run_hourly_stream(spark, folder, weather, max_files_per_trigger=1)
    assert hourly.count() > 0
    assert hourly.agg(F.sum("n")).first()[0] <= batch.count()


def test_no_input_gives_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF_SMALL}/events.parquet").where("false").write.parquet(str(tmp_path / "events.parquet"))
    weather = fx.weather(spark, SF_SMALL)
    for got in (sensor.run_mass_stream(spark, str(tmp_path), weather), sensor.run_latest_stream(spark, str(tmp_path)), sensor.run_hourly_stream(spark, str(tmp_path), weather)):
        assert got.count() == 0 and "station_id" in got.columns


def test_latest_survives_a_lost_version_and_replays(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "latest")
    rows = lambda *r: spark.createDataFrame([(s, k, f"t{s}", 1, 2) for s, k in r], "sno long, station_id long, time string, pm05 long, pm25 long")
    merge = sensor._merge_latest(spark, target, ["station_id"])
    merge(rows((1, 10), (2, 11)), 0)
    # epoch 1 writes its folder and dies before the mark: readers stay on epoch 0
    real = sensor.file_system
    monkeypatch.setattr(sensor, "file_system", lambda sp, p: (_ for _ in ()).throw(IOError("lost")) if p.endswith(sensor.DONE) else real(sp, p))
    try:
        merge(rows((3, 10)), 1)
        raise AssertionError("the failure must show")
    except IOError:
        pass
    monkeypatch.setattr(sensor, "file_system", real)
    read = lambda: sorted((r.station_id, r.sno) for r in spark.read.parquet(sensor.latest_version(spark, target)).collect())
    assert read() == [(10, 1), (11, 2)]
    for _ in range(2):  # the replay, and one more
        merge(rows((3, 10)), 1)
        assert read() == [(10, 3), (11, 2)]
    merge(rows((4, 12)), 2)
    assert read() == [(10, 3), (11, 2), (12, 4)]
    assert sorted(sensor.versions(spark, target)) == [1, 2]  # older ones are gone


def test_read_errors_are_not_taken_for_a_new_table(spark, tmp_path, monkeypatch):
    def broken(sp, p):
        raise IOError("store is away")

    monkeypatch.setattr(sensor, "file_system", broken)
    try:
        sensor.latest_version(spark, str(tmp_path))
        raise AssertionError("must raise")
    except IOError:
        pass


def test_text_lines_as_a_stream(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"f{k}.txt").write_text(f"2014-06-05T10:0{k},12{k},8\n\nbroken line\n")
    got = sensor.run_line_stream(spark, str(tmp_path), max_files_per_trigger=1)
    assert sorted((r.time, r.pm05, r.pm25) for r in got.collect()) == [(f"2014-06-05T10:0{k}", 120 + k, 8) for k in range(3)]
