"""Ends of auctions as events, against a plain loop."""

import random
from datetime import timedelta

from data import START, observations

from pyspark.sql import functions as F

from shelfdiff.schema import OBSERVATION
from shelfdiff.streaming.closings import stream_closings

HOUR = timedelta(hours=1)


def test_events_of_late_and_odd_sightings(spark, tmp_path):
    r = random.Random(3)
    rows, waves = [], []
    for n in range(24):
        for item in range(6):
            if r.random() < 0.4:
                # some closed when seen, some without a time, some beyond the horizon
                end = r.choice([None, *(START + HOUR * (n + d) for d in (-2, 0, 1, 3, 5, 200))])
                rows.append({"ts": START + HOUR * n, "item": f"i{item}", "price": n, "end": end})
                waves.append(min(2, (n + r.choice([0, 0, 0, 4])) // 10))
    seen = observations(spark, "s", rows)
    ends = spark.createDataFrame([(x["ts"], x["item"], x["end"]) for x in rows], "run_ts timestamp, item_id string, end_ts timestamp")
    seen = seen.drop("end_ts").join(ends, ["run_ts", "item_id"]).select(*OBSERVATION.names).cache()
    wave_of = spark.createDataFrame([(x["ts"], x["item"], w) for x, w in zip(rows, waves)], "run_ts timestamp, item_id string, wave int")
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for wave in range(3):
        part = seen.join(wave_of.filter(F.col("wave") == wave), ["run_ts", "item_id"]).select(*OBSERVATION.names)
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(OBSERVATION).parquet(source)
        writer = stream_closings(stream, "6 hours", "30 hours").writeStream.format("parquet").option("path", out)
        writer.option("checkpointLocation", f"{tmp_path}/log").trigger(availableNow=True).start().awaitTermination()
    found = sorted((x["item_id"], x["price"], x["ended"]) for x in spark.read.parquet(out).collect())
    newest = max(x["ts"] for x in rows) - 6 * HOUR
    expected = []
    for x in rows:
        if x["end"] is None:
            continue
        due = min(max(x["end"], x["ts"]), x["ts"] + 30 * HOUR)
        later = any(y["item"] == x["item"] and x["ts"] < y["ts"] <= due for y in rows)
        if not later and due < newest:
            expected.append((x["item"], x["ts"].hour, x["end"] <= due))
    assert found == sorted(expected) and len(found) > 8
    seen.unpersist()
