"""Sessions of a stream against those of a batch, whatever the order of rows, and late rows."""

import datetime
import random

from pyspark.sql import functions as F

from coppice.operators import ordered as O
from coppice.streaming.sessions import run_once, stream_sessions

START = datetime.datetime(2024, 1, 1)


def rows_of(spark, rows):
    return spark.createDataFrame([(k, START + datetime.timedelta(minutes=m), i) for i, (k, m) in enumerate(rows)], "k string, t timestamp, i long")


def batch_sessions(d, gap_us):
    s = O.gap_sessions(d.withColumn("us", F.unix_micros("t")), ["k"], ["t", "i"], F.col("us"), gap_us)
    return sorted(map(str, s.groupBy("k", "session").agg(F.min("t"), F.max("t"), F.count("*")).drop("session").collect()))


def test_shuffled_batches_give_the_sessions_of_the_batch(spark, tmp_path):
    r = random.Random(4)
    rows = [(r.choice(["a", "b", None]), r.randrange(0, 3000)) for _ in range(200)] + [("c", 10), ("c", 40), ("c", 71), ("c", 10)]
    d = rows_of(spark, rows)
    r.shuffle(rows)
    for i in range(0, len(rows), 60):  # any order: lateness covers all
        rows_of(spark, rows[i : i + 60]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    s = stream_sessions(spark.readStream.schema("k string, t timestamp, i long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"), "k", "t", 30 * 60_000_000, "3 days")
    run_once(s, f"{tmp_path}/out", f"{tmp_path}/state")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 0  # all may still grow
    rows_of(spark, [("end", 100_000)]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run_once(s, f"{tmp_path}/out", f"{tmp_path}/state")
    got = spark.read.parquet(f"{tmp_path}/out").select("k", "first", "last", "n")
    plain = lambda x: x.replace("min(t)=", "").replace("max(t)=", "").replace("count(1)=", "").replace("first=", "").replace("last=", "").replace("n=", "")
    assert sorted(plain(str(x)) for x in got.collect()) == sorted(map(plain, batch_sessions(d, 30 * 60_000_000)))
    assert got.where("k = 'c'").count() == 2  # 30 minutes hold together, 31 do not


def test_late_rows_go_and_are_counted(spark, tmp_path):
    for part in ([("a", 0), ("a", 600)], [("a", 601)], [("a", 5), ("a", 599)], [("a", 9000)]):
        rows_of(spark, part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    s = stream_sessions(spark.readStream.schema("k string, t timestamp, i long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"), "k", "t", 10 * 60_000_000, "60 minutes")
    q = run_once(s, f"{tmp_path}/out", f"{tmp_path}/state")
    got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select("first", "last", "n").collect())
    at = lambda m: START + datetime.timedelta(minutes=m)
    assert got == [(at(0), at(0), 1), (at(599), at(601), 3)]
    assert sum(o["numRowsDroppedByWatermark"] for p in q.recentProgress for o in p["stateOperators"]) == 1
