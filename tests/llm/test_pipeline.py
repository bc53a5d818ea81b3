"""The corpus pipeline against a plain version of its stages."""

import random

import pytest

import corpus_pipeline
from tarnflow.llm import near_dup, quality_rules, textstats

from .test_dedup import brute_classes, brute_hits
from .test_tokens import WORD, ids_of


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    words = [f"{a}{b}{c}" for a in ("ba", "de", "ki", "lo") for b in ("ma", "ne", "po", "ru") for c in ("", "s", "ta", "vi")]
    folder = tmp_path_factory.mktemp("sf")
    bench = [(i, " ".join(rng.choices(words, k=25))) for i in range(5)]
    rows = []
    for i in range(120):
        lines = [" ".join(rng.choices(words, k=12)).capitalize() + "." for _ in range(rng.randint(6, 15))]
        if i % 2:
            lines.insert(0, "Menu of the site")
        if i % 20 == 7:
            lines.insert(3, bench[i % 5][1])
        rows.append([i, "\n".join(lines), "en", "ab"[i % 2], 0])
    for i in range(120, 135):
        base = rows[i - 120][1]
        rows.append([i, base if i % 2 else base + " more", "en", rows[i - 120][3], 0])
    for i in range(135, 160):
        kind = i % 3
        text = ["Buy " * 80, " | ".join(rng.choices(words, k=120)), " ".join(w.upper() + "!!" for w in rng.choices(words, k=100))][kind]
        rows.append([i, text, "en", "a", 0])
    rows += [[160, None, "en", "a", None], [161, "", None, None, 0]]
    for r in rows:
        r[4] = len(r[1]) if r[1] is not None else None
    spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows, bench


def plain(rows, bench, kept_by_rules):
    docs = {r[0]: (r[1], r[3]) for r in rows if r[0] in kept_by_rules}
    for source in {s for _, s in docs.values()}:
        mine = {i: t.split("\n") for i, (t, s) in docs.items() if s == source}
        counts = {}
        for lines in mine.values():
            for x in {y.strip(" \t\r") for y in lines} - {""}:
                counts[x] = counts.get(x, 0) + 1
        bad = {x for x, n in counts.items() if len(mine) >= 20 and n >= 5 and n > 0.05 * len(mine)}
        for i, lines in mine.items():
            left = [x for x in lines if x.strip(" \t\r") not in bad]
            if any(x.strip(" \t\r") for x in left):
                docs[i] = ("\n".join(left), source)
    classes = brute_classes([(i, t, s) for i, (t, s) in docs.items()], 5)
    docs = {i: t for i, (t, _) in docs.items() if classes[i][1] == i}
    docs = {i: t for i, t in docs.items() if not brute_hits(t, bench)[4]}
    pieces = {}
    for i, t in docs.items():
        n = len(ids_of(WORD, t)) + 1
        for k in range(0, n, 2048):
            pieces[i, k // 2048] = min(2048, n - k)
    return pieces


def test_run_equals_plain_stages(spark, corpus):
    folder, rows, bench = corpus
    got = corpus_pipeline.run(spark, folder).collect()
    verdicts = quality_rules.quality_rules(spark.read.parquet(f"{folder}/documents.parquet")).collect()
    kept = {r.doc_id for r in verdicts if r.kept}
    assert not kept & set(range(135, 162)) and len(kept & set(range(135))) >= 130
    assert {(r.doc_id, r.piece): r.length for r in got} == plain(rows, bench, kept)
    fill = {}
    for r in got:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 2048


def test_a_run_goes_on_from_finished_stages(spark, corpus, tmp_path, monkeypatch):
    folder, _, _ = corpus
    kept = (tmp_path / "stages").as_uri()
    first = sorted(map(tuple, corpus_pipeline.run(spark, folder, kept).select("doc_id", "piece", "length").collect()))

    def fails(*_):
        raise AssertionError("a finished stage ran again")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, fails if n != "packing" else f) for n, f in corpus_pipeline.STAGES])
    (tmp_path / "stages" / "packing" / "_SUCCESS").unlink()
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder, kept).select("doc_id", "piece", "length").collect())) == first


def test_stages_take_odd_rows(spark, odd, tmp_path):
    """Nulls, empty and very long texts, ties, repeated rows and clashing names
    at every stage."""
    spark.createDataFrame([(1, "nothing of the sort"), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = {"quality_rules": 0, "line_dedup": 9, "near_dedup": 7, "decontamination": 9, "packing": None}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, str(tmp_path))
        if left[name] is None:
            assert out.select("doc_id").distinct().count() == 8
        else:
            assert out.columns == corpus_pipeline.COLUMNS and out.count() == left[name], name


def test_stages_keep_columns_and_accept_empty(spark, corpus, tmp_path):
    folder, _, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0
        if name != "packing":
            assert out.columns == corpus_pipeline.COLUMNS
    assert [n for n, _ in corpus_pipeline.STAGES][:2] == ["quality_rules", "line_dedup"] and near_dup and textstats
