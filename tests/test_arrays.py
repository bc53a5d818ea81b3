from pyspark.sql import functions as F

from tarnflow.functions import arrays


def test_running_before_equals_a_plain_sum(spark):
    rows = [([],), ([5],), (list(range(256)),), (list(range(257)),), ([3] * 2000,)]
    df = spark.createDataFrame(rows, "a array<long>")
    for r in df.select("a", arrays.running_before(F.col("a")).alias("b")).collect():
        assert r.b == [sum(r.a[:i]) for i in range(len(r.a))]
