"""Table functions against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tarnflow.operators import fanout

CLASSES = [["GO:1", 0.125, "BP", "one"], ["GO:2", 0.5, "MF", "two"]]
HITS = "q string, bits double, spid string, accepted boolean, ff double, desc string, terms array<struct<id:string,ontology:string,text:string>>, more int"
HITS_READ = ["bits", "spid", "accepted", "ff", "desc", "terms"]


def test_naive(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "w")], "qpid long, other string")
    got = fanout.naive(df, "qpid", CLASSES)
    assert got.schema.simpleString() == "struct<qpid:bigint,goid:string,frequency:string,ontology:string,description:string>"
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((k, g, f"{f:.2f}", o, d) for k in (1, 2, None) for g, f, o, d in CLASSES), key=str)
    # The key's name and type follow the table.
    assert fanout.naive(df.select(F.col("other").alias("who")), "who", CLASSES).schema["who"].dataType.simpleString() == "string"
    assert fanout.naive(df.filter("qpid = 9"), "qpid", CLASSES).count() == 0
    with pytest.raises(Exception, match="no column"):
        fanout.naive(df, "qpid", CLASSES).sparkSession.sql("SELECT 1") and fanout.udtf(fanout.NaivePredictor)(df.asTable(), fanout.lit("nope"), fanout.lit("[]"))


def test_best_informative_hit(spark):
    rng = random.Random(3)
    rows = []
    for q in range(40):
        for i in range(rng.randint(1, 6)):
            terms = [(f"GO:{rng.randrange(9)}", rng.choice(["BP", "MF"]), f"t{j}") for j in range(rng.choice([0, 0, 1, 2]))]
            rows.append((f"q{q}", float(rng.randrange(5)), f"q{q}" if rng.random() < 0.15 else f"s{i}", rng.random() < 0.7, rng.choice([None, 0.1, 0.2, 0.9]), rng.choice(["", None, f"d{i}"]), terms or rng.choice([None, []]), 1))
    want = []
    for q in {r[0] for r in rows}:
        mine = [r for r in sorted((r for r in rows if r[0] == q), key=lambda r: (-r[1], r[2])) if r[3] and r[2] != q]
        best = next(((r[1], r[5]) for r in mine if r[4] is not None and r[4] >= 0.2 and r[5]), (0.0, fanout.NOTHING))
        want.append((q, "DE", best[0], "", best[1]))
        first = next((r for r in mine if r[6]), None)
        want += [(q, o, first[1], g, t) for g, o, t in first[6]] if first else []
    df = spark.createDataFrame(rows, HITS)
    assert sorted(map(tuple, fanout.best_informative(df, "q").collect())) == sorted(want)
    # In SQL, after registration.
    fanout.register(spark)
    df.createOrReplaceTempView("fanout_hits")
    assert sorted(map(tuple, spark.sql("SELECT * FROM best_informative_hit(TABLE(SELECT * FROM fanout_hits), 'q', 0.2D)").collect())) == sorted(want)
    assert fanout.best_informative(df.filter("more = 2"), "q").count() == 0


def test_best_hits_without_python(spark):
    """The aggregates say what the table function says, also for missing values,
    and no row goes through Python."""
    rng = random.Random(5)
    rows = []
    for q in [None, *range(30)]:
        for i in rng.sample(range(12), rng.randint(1, 6)):
            terms = [(f"GO:{rng.randrange(9)}", rng.choice(["BP", None]), rng.choice([None, "t"])) for _ in range(rng.choice([0, 1, 2]))]
            bits, ff = rng.choice([-1.0, 0.0, 2.5, 7.0, float("inf")]), rng.choice([None, 0.1, 0.2, float("nan")])
            rows.append((q, bits, rng.choice([None, str(q)]) if i == 11 else f"s{i}", rng.choice([None, True, True]), ff, rng.choice(["", None, f"d{i}"]), terms or rng.choice([None, []]), 1))
    df = spark.createDataFrame(rows, HITS.replace("q string", "q int"))
    fast, plain = fanout.best_informative(df, "q"), fanout.udtf(fanout.BestInformativeHit)(df.select("q", *HITS_READ).asTable(), fanout.lit("q"), fanout.lit(0.2))
    assert fast.schema.simpleString() == plain.schema.simpleString()
    assert sorted(map(str, fast.collect())) == sorted(map(str, plain.collect()))
    assert "Python" not in fast._jdf.queryExecution().executedPlan().toString()
