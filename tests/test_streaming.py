"""Streaming forms give what the batch forms give."""

from pyspark.sql import functions as F

from tarnflow.streaming import blocks

HITS = "qpid string, spid string, bits double, qcov double, scov double, pide double, lali double"


def source(spark, path):
    rows = [(f"q{i % 3}", f"s{i}", float(i), 0.9 if i % 2 else 0.1, 0.9, 0.8, 90.0) for i in range(30)]
    spark.createDataFrame(rows, HITS).repartition(3).write.mode("overwrite").parquet(path)
    return blocks.read_files(spark, path, HITS), spark.read.parquet(path)


def finished(df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name)


def test_filter_and_running_blocks(spark, tmp_path):
    stream, batch = source(spark, f"{tmp_path}/h")
    assert finished(blocks.filter_hits(stream), "accepted", "append").count() == blocks.filter_hits(batch).count() == 15
    got = finished(blocks.running_blocks(stream, "qpid", "bits"), "running", "complete")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, blocks.running_blocks(batch, "qpid", "bits").collect()))


def test_first_n_keeps_state(spark, tmp_path):
    stream, _ = source(spark, f"{tmp_path}/h")
    got = finished(blocks.first_n(stream, "qpid", "bits", 4), "first_n", "append").groupBy("qpid").count().collect()
    assert {r.qpid: r["count"] for r in got} == {"q0": 4, "q1": 4, "q2": 4}


def test_windows_and_sessions(spark, tmp_path):
    rows = [(i, f"2024-01-01 00:{i % 60:02d}:00", i % 2, 1.0) for i in range(50)] + [(99, "2024-01-02 00:00:00", 0, 1.0)]
    spark.createDataFrame(rows, "id int, ts string, user int, value double").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(f"{tmp_path}/e")
    stream = blocks.read_files(spark, f"{tmp_path}/e", "id int, ts timestamp, user int, value double", 10)
    got = finished(blocks.windowed(stream, "ts", "user", "value", "10 minutes", "5 minutes"), "windows", "append")
    assert got.agg(F.sum("n")).first()[0] == 50 and got.count() == 10
    assert finished(blocks.sessions(stream, "ts", "user", "5 minutes", "5 minutes"), "sessions", "append").count() == 2


def test_write_batches(spark, tmp_path):
    stream, batch = source(spark, f"{tmp_path}/h")
    blocks.write_batches(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/out").count() == batch.count()


def test_two_streams_meet_in_time(spark, tmp_path):
    at = "2024-01-01 00:{:02d}:00"
    for name, rows in (("a", [(1, at.format(0), "x"), (1, at.format(30), "y"), (2, at.format(5), "z")]), ("b", [(1, at.format(4), 10), (2, at.format(50), 20), (1, at.format(28), 30)])):
        spark.createDataFrame(rows, f"k int, t{name} string, v{name} {'string' if name == 'a' else 'int'}").withColumn(f"t{name}", F.to_timestamp(f"t{name}")).write.parquet(f"{tmp_path}/{name}")
    a, b = blocks.read_files(spark, f"{tmp_path}/a", "k int, ta timestamp, va string"), blocks.read_files(spark, f"{tmp_path}/b", "k int, tb timestamp, vb int")
    got = finished(blocks.joined(a, b, "k", "ta", "tb", "1 hour", "5 MINUTES"), "met", "append")
    assert sorted((r.k, r.va, r.vb) for r in got.collect()) == [(1, "x", 10), (1, "y", 30)]


def test_stanzas_over_a_stream(spark, tmp_path):
    for i in range(2):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{i}.obo").write_text(f"format: 1\n\n[Term]\nid: T:{i}\nis_a: T:8\nis_a: T:9\n\n[Typedef]\nid: part_of\n")
    got = finished(blocks.stanza_tags(blocks.stanzas(spark, str(tmp_path / "in"))), "stanzas", "append").filter("kind = 'Term'").collect()
    assert sorted((r.place, r.tags["id"], r.tags["is_a"]) for r in got) == [(1, ["T:0"], ["T:8", "T:9"]), (1, ["T:1"], ["T:8", "T:9"])]
