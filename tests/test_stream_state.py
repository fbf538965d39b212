"""Streams with keyed state: resent and late readings, stopped and restarted, against the batch result."""

import datetime as dt
import random

from cellflux.session import scratch_path
from cellflux.streaming import sensor

SCHEMA = "station_id long, sno long, ts timestamp, time string, pm05 long, pm25 long"


def readings(n=600, seed=2):
    r = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        ts = t0 + dt.timedelta(minutes=7 * i)
        rows.append((r.choice([0] * 6 + list(range(1, 9))), i, ts, ts.strftime("%Y-%m-%dT%H:%M"), r.randint(0, 900), r.randint(0, 90)))
    return rows


def put(spark, rows, folder, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def stream(spark, folder):
    return sensor.read_sensor_stream(spark, f"{folder}/*", "parquet", spark.createDataFrame([], SCHEMA).schema, 1)


def test_resent_readings_are_stored_once_over_restarts(spark):
    rows = readings()
    folder, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    r = random.Random(1)
    sent = []
    for k in range(6):
        mine = rows[100 * k : 100 * (k + 1)]
        sent += mine
        # copies inside the file, of rows of the files before (within a day of event time), and rows a little late
        again = r.sample(mine, 30) + (r.sample(rows[100 * k - 90 : 100 * k], 30) if k else [])
        batch = mine + again
        r.shuffle(batch)
        put(spark, batch, folder, f"f{k}")
        if k in (1, 3, 5):  # the query ends and starts again from its checkpoint
            sensor.append_readings(sensor.without_resent(stream(spark, folder), delay="1 day"), out, out + "-ckpt").awaitTermination()
    got = spark.read.parquet(out).collect()
    assert sorted(tuple(x[c] for c in ("station_id", "sno", "ts", "time", "pm05", "pm25")) for x in got) == sorted(sent)


def test_a_copy_later_than_the_watermark_is_dropped_too(spark):
    rows = readings(400)
    folder, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    for k in range(4):
        put(spark, rows[100 * k : 100 * (k + 1)] + (rows[:5] if k == 3 else []), folder, f"f{k}")
        sensor.append_readings(sensor.without_resent(stream(spark, folder), delay="1 hour"), out, out + "-ckpt").awaitTermination()
    assert sorted(x.sno for x in spark.read.parquet(out).collect()) == list(range(400))


def test_newest_reading_from_state_over_restarts(spark):
    rows = readings()
    r = random.Random(5)
    r.shuffle(rows)  # late rows everywhere
    folder, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    for k in range(6):
        put(spark, rows[100 * k : 100 * (k + 1)] + r.sample(rows[: 100 * (k + 1)], 20), folder, f"f{k}")
        if k in (0, 2, 5):
            newest = sensor.newest_by_key(stream(spark, folder).select("station_id", "sno", "time", "pm05", "pm25"))
            sensor.publish_changes(newest, out, out + "-ckpt").awaitTermination()
            want = {}
            for x in rows[: 100 * (k + 1)]:
                if x[1] >= want.get(x[0], (0, -1))[1]:
                    want[x[0]] = (x[0], x[1], x[3], x[4], x[5])
            got = sensor.current(spark, out).select("station_id", "sno", "time", "pm05", "pm25").collect()
            assert sorted(map(tuple, got)) == sorted(want.values())
    # a replayed epoch writes the same rows to its own folder
    before = sorted(map(tuple, sensor.current(spark, out).collect()))
    last = spark.read.parquet(out).groupBy().max("epoch").first()[0]
    same = spark.read.parquet(f"{out}/epoch={last}").collect()
    spark.createDataFrame(same).write.mode("overwrite").parquet(f"{out}/epoch={last}")
    assert sorted(map(tuple, sensor.current(spark, out).collect())) == before
