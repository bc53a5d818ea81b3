"""Look-ups of records by byte ranges."""

import random

import pytest
from pyspark.sql import functions as F

from tarnflow.sources import indexed


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    rng = random.Random(6)
    folder = tmp_path_factory.mktemp("flat")
    want = {}
    for f in range(3):
        parts = ["; a preamble\n"] if f == 1 else []
        for i in range(4000):
            key = f"k{f}_{i}" if i else "twice"
            body = "".join(f"{''.join(rng.choices('ACGT>é', k=rng.randint(1, 60)))}\n" for _ in range(rng.randint(0, 3)))
            # A line of the body may begin like a record's only by the rule itself.
            body = "".join(line if not line.startswith(">") else "A" + line for line in body.splitlines(True))
            record = f">{key} words about it\n{body}"
            parts.append(record)
            want.setdefault(key, []).append(record)
        text = "".join(parts)
        if f == 2:
            text = text[:-1]
            want[f"k2_{3999}"][-1] = want["k2_3999"][-1][:-1]
        (folder / f"part{f}.txt").write_bytes(text.encode())
    (folder / "_ignored").write_text(">no\n")
    return folder, want


@pytest.mark.parametrize("split", [1 << 20, 1000, 37_123])
def test_index_and_all_records(spark, files, tmp_path, split, monkeypatch):
    folder, want = files
    index = indexed.index_records(spark, str(folder), str(tmp_path / "index"), split=split)
    rows = index.collect()
    got = {}
    for r in rows:
        with open(r.path, "rb") as f:
            f.seek(r.start)
            got.setdefault(r.key, []).append(f.read(r.length).decode())
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_pushed_filter_reads_only_its_ranges(spark, files, tmp_path, monkeypatch):
    folder, want = files
    index = str(tmp_path / "index")
    indexed.index_records(spark, str(folder), index)
    keys = ["twice", "k0_7", "k1_3999", "k2_3999", "k2_100", "missing"]
    table = indexed.read_records(spark, str(folder), index)
    got = table.filter(F.col("key").isin(keys)).collect()
    assert sorted(r.record for r in got) == sorted(x for k in keys for x in want.get(k, []))
    assert [r.record for r in table.filter("key = 'k0_7' and length(record) > 1").collect()] == want["k0_7"]
    assert table.filter("key = 'k0_7' and key = 'k0_8'").count() == 0
    # The reader itself: partitions hold these records alone, and reading seeks to each.
    reader = indexed._Reader({"path": str(folder), "index": index})
    from pyspark.sql.datasource import In

    assert list(reader.pushFilters([In(("key",), tuple(keys))])) == []
    parts = reader.partitions()
    assert sum(len(p.rows) for p in parts) == sum(len(want.get(k, [])) for k in keys)
    read = []

    class Counting:
        def __init__(self, f):
            self.f = f

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.f.close()

        def seek(self, at):
            self.f.seek(at)

        def read(self, n):
            read.append(n)
            return self.f.read(n)

    class Store:
        def open_input_file(self, path):
            return Counting(open(path, "rb"))

    monkeypatch.setattr(indexed, "_store", lambda uri: (Store(), uri))
    records = [r for p in parts for b in reader.read(p) for r in b.column("record").to_pylist()]
    assert sum(read) == sum(len(r.encode()) for r in records) and len(read) == len(records)


def test_fetch_by_table(spark, files, tmp_path):
    folder, want = files
    index = str(tmp_path / "index")
    indexed.index_records(spark, str(folder), index)
    keys = [k for k in want if k.endswith("5")] + ["missing", None]
    got = indexed.fetch(spark, str(folder), index, spark.createDataFrame([(k,) for k in keys * 2], "id string"), "id").collect()
    assert sorted(r.record for r in got) == sorted(x for k in keys for x in want.get(k, []))
    assert indexed.read_records(spark, str(folder), index, 500).count() == sum(map(len, want.values()))
