"""Streamed blocks equal the batch result; a restart goes on from the checkpoint."""

import random
from datetime import datetime, timedelta, timezone

import pandas as pd
import pytest

from tarnflow.streaming import finalised

SCHEMA = "q string, ts timestamp, n long, value double"
OUT = "q string, n long, first long, total double, longest double"


def finish(block: pd.DataFrame) -> pd.DataFrame:
    """Count, first row's number, sum and greatest rise between neighbours in order."""
    rise = block["value"].diff().max()
    return pd.DataFrame([(block["q"][0], len(block), int(block["n"][0]), float(block["value"].sum()), 0.0 if pd.isna(rise) else float(rise))], columns=["q", "n", "first", "total", "longest"])


@pytest.fixture
def store(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, finalised.STORE)
    yield
    spark.conf.unset(key)


def test_stream_equals_batch(spark, store, tmp_path):
    rng = random.Random(5)
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows, n = [], 0
    for q in range(6):
        at = start + timedelta(seconds=rng.randrange(30))
        for _ in range(25):
            at += timedelta(seconds=rng.choice([1, 2, 5, 5, 40]))
            rows.append((f"q{q}", at, n, float(rng.randrange(100))))
            n += 1
    rows.sort(key=lambda r: r[1])
    end = rows[-1][1] + timedelta(days=1)
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")

    def put(some):
        spark.createDataFrame(some, SCHEMA).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        blocks = finalised.finalised_blocks(stream, "q", "ts", ["ts", "n"], finish, OUT, 20, "5 seconds")
        blocks.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination(240)

    put(rows[:70])
    run()
    early = spark.read.parquet(out).count()
    put(rows[70:])
    put([("end", end, 9999, 0.0)])
    run()  # a new query, from the checkpoint
    put([("end", end + timedelta(days=1), 10000, 0.0)])
    run()
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect() if r.q != "end")
    batch = finalised.in_batch(spark.createDataFrame(rows, SCHEMA), "q", "ts", ["ts", "n"], finish, OUT, 20)
    assert got == sorted(tuple(r) for r in batch.collect())
    assert 0 < early < len(got)
