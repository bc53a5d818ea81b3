"""Alignments stitched over blocks, in files read in parts of any size."""

import random

import pytest

from tarnflow.sources import alignments


def report(rng, path):
    """A search report as text, and what it says."""
    want, out = {}, ["hmmsearch - search a sequence database", "", "Parsed for domains:"]
    domains = []
    for s in range(1, 9):
        for d in range(1, rng.randint(2, 4)):
            n = rng.randint(1, 170)
            model = "".join(rng.choices("ATGC.atgc", k=n))
            query = "".join(rng.choices("ACGT-", k=n))
            match = "".join(rng.choices("AC+ |", k=n))
            start = rng.randint(1, 900)
            domains.append((str(s), d, start, start + n - 1, model, match, query))
    for s, d, a, z, *_ in domains:
        out.append(f"{s}        {d}/3  {a:6d} {z:6d} [.     1   170 []   {rng.randint(1, 99)}.5   1e-{d:02d}")
    out += ["", "Alignments of top-scoring domains:"]
    for s, d, a, z, model, match, query in domains:
        out.append(f"{s}: domain {d} of 3, from {a} to {z}: score 1.0, E = 1e-5")
        at = a
        for i in range(0, len(model), 50):
            lead = "*->" if i == 0 else ""
            tail = "<-*" if i + 50 >= len(model) else ""
            step = min(50, len(model) - i)
            out.append(" " * 19 + lead + model[i : i + 50] + tail)
            out.append(" " * (19 + len(lead)) + match[i : i + 50])
            out.append(f"{'  ' + s:<10}{at:>8} " + " " * len(lead) + query[i : i + 50] + f" {at + step - 1}   ")
            out.append("")
            at += step
        want[s, d] = (a, z, model, match, query)
    out += ["", "Histogram of all scores:", "x"]
    path.write_text("\n".join(out) + "\n")
    return want


@pytest.mark.parametrize("split", [1 << 20, 700, 91])
def test_report(spark, tmp_path, split):
    want = report(random.Random(4), tmp_path / "a.hmmsearch")
    got = {(r.seq, r.domain): (r.start, r.end, r.model_string, r.match_string, r.query_string) for r in alignments.hmm_alignments(spark, str(tmp_path), split).collect()}
    assert got == want
    both = alignments.report_with_alignments(spark, str(tmp_path / "a.hmmsearch"), split).collect()
    assert {(r.seq, r.domain): r.query_string for r in both} == {k: v[4] for k, v in want.items()}


@pytest.mark.parametrize("split", [1 << 20, 333])
def test_stockholm_round_trip(spark, tmp_path, split):
    rng = random.Random(7)
    rows = []
    for a in range(5):
        n = rng.choice([1, 59, 60, 61, 400])
        rows += [(a, f"seq{a}_{i}/1-9", "".join(rng.choices("ACGU-.", k=n))) for i in range(rng.randint(1, 7))]
    alignments.write_stockholm(spark.createDataFrame(rows, "alignment int, name string, text string"), str(tmp_path / "out"))
    got = alignments.stockholm(spark, str(tmp_path / "out"), split).collect()
    assert sorted((r.name, r.text) for r in got) == sorted((n, t) for _, n, t in rows)
    together = {}
    for r in got:
        together.setdefault((r.path, r.alignment), set()).add(r.name)
    want = {}
    for a, n, _ in rows:
        want.setdefault(a, set()).add(n)
    assert sorted(map(sorted, together.values())) == sorted(map(sorted, want.values()))


def test_stockholm_annotations(spark, tmp_path):
    text = "# STOCKHOLM 1.0\r\n#=GF ID  first\n#=GF CC  two\n#=GF CC  lines\n\na  AC\n#=GR a SS  ..\nb  GG\n#=GC SS_cons  <>\n\na  GU\n#=GR a SS  <>\nb  CC\n#=GC SS_cons  ()\n//\n# STOCKHOLM 1.0\na  TTT\n//"
    (tmp_path / "x.sto").write_bytes(text.encode())
    got = {(r.alignment, r.kind, r.name, r.feature): r.text for r in alignments.stockholm(spark, str(tmp_path / "x.sto"), 40).collect()}
    assert got == {
        (1, "GF", "", "ID"): "first", (1, "GF", "", "CC"): "two lines", (1, "row", "a", ""): "ACGU", (1, "row", "b", ""): "GGCC", (1, "GR", "a", "SS"): "..<>", (1, "GC", "", "SS_cons"): "<>()", (2, "row", "a", ""): "TTT",
    }


@pytest.mark.parametrize("split", [1, 3, 7, 1000])
def test_lines(spark, tmp_path, split):
    text = "one\n\ntwo é\r\nthree" if split != 3 else "\n\nx\n"
    (tmp_path / "f.txt").write_bytes(text.encode())
    got = sorted((r.place, r.line) for r in alignments.placed_lines(spark, str(tmp_path / "f.txt"), split).collect())
    want, at = [], 0
    for line in text.encode().split(b"\n"):
        if at < len(text.encode()):
            want.append((at, line.decode().rstrip("\r")))
        at += len(line) + 1
    assert got == want
