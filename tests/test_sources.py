"""Readers and writers on small files, and round trips."""

import gzip

import pytest
from pyspark.sql import functions as F

from tarnflow.sources import sinks as K
from tarnflow.sources import text_formats as T


@pytest.fixture()
def put(tmp_path):
    def write(name, text):
        path = tmp_path / name
        if name.endswith(".gz"):
            with gzip.open(path, "wt") as f:
                f.write(text)
        else:
            path.write_text(text)
        return str(path)

    return write


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", ["a.fa", "a.fa.gz"])
def test_fasta(spark, put, name):
    path = put(name, "# comment\n>s1 first one\nACG-T\nac gt.\n\n>s2\nTTT\n# inner\nGG\n>s3 none\n")
    assert rows(T.fasta(spark, path)) == [("s1", "first one", "ACGTacgt", 8), ("s2", "", "TTTGG", 5), ("s3", "none", "", 0)]
    assert rows(T.fasta(spark, path, upper=True).select("seq"))[1:] == [("ACGTACGT",), ("TTTGG",)]


def test_fasta_round_trip(spark, put, tmp_path):
    df = T.fasta(spark, put("a.fa", ">s1\n" + "ACGT" * 40 + "\n>s2\nTT\n"))
    K.fasta(df, f"{tmp_path}/out", {"organism": F.lit("E. coli"), "gcode": F.lit(11)})
    back = T.fasta(spark, f"{tmp_path}/out")
    assert rows(back.select("id", "description", "seq")) == [("s1", "[organism=E. coli] [gcode=11]", "ACGT" * 40), ("s2", "[organism=E. coli] [gcode=11]", "TT")]


def test_hit_tables(spark, put):
    path = put("h.tab", "nid\tisquery\tqpid\tspid\tqcov\tscov\tbits\tpide\tlali\tdesc\tspecies\tqseq\tvote\tgenename\n1\t0\tq\ts\t0.5\t0.6\t77.5\t0.9\t100\tA \"b\" c\tX\tn.d.\t3\tg\n")
    r = T.hits(spark, path).first()
    assert (r.nid, r.bits, r.desc, r.qseq, r.vote) == (1, 77.5, 'A "b" c', None, 3)
    path = put("b.tab", "# c\nq1\ts1\t90.0\t50\t1\t0\t1\t50\t2\t51\t1e-9\t88.5\n")
    lengths = spark.createDataFrame([("q1", 100), ("s1", 200)], "id string, length int")
    b = T.blast(spark, path, lengths).first()
    assert (b.pide, b.qcov, b.scov, b.bits) == (0.9, 0.5, 0.25, 88.5)


def test_tagged_hits(spark, put):
    path = put("x.sgml", '<QUERY nid=1 vote=5 len=99>\n>q1 text\n<SBJCT bits=50.5 pide=0.8 lali=80 len=199>\n>s1 Some protein OS=X\n</SBJCT><SBJCT bits=bad pide=0.7 lali=50 len=99>\n>s2 Other\n</SBJCT></QUERY>\n')
    got = {r.spid: r for r in T.tagged_hits(spark, path).collect()}
    assert got["s1"].qpid == "q1" and got["s1"].bits == 50.5 and got["s1"].qcov == 0.8 and got["s1"].scov == 0.4
    assert (got["s1"].desc, got["s1"].species, got["s1"].genename, got["s1"].isquery) == ("Some protein", "X", "", "0") and got["s2"].bits is None
    assert (got["q1"].isquery, got["q1"].qcov, got["q1"].lali, got["q1"].desc) == ("1", 1.0, 99, "text")
    assert (got["s1"].rank, got["s2"].rank, got["s1"].vote) == (1, 2, "5")


def test_tagged_hits_as_printed(spark, put):
    """Attributes stand apart from their values; ranges and sequences."""
    text = "# comment\n<DATABASE= x y 1 z 2 >\n<QUERY nid= 3 LSEQ= 9 >\n>q9 Query protein OS=Homo sapiens GN=ABC PE=1\nMKLVMKLVA\n"
    text += "<SBJCT VOTE= 4 PIDE= 0.5 LALI= 8 BITS= 33.5 LSEQ= 15 QFROM= 1 QTO= 8 SFROM= 2 STO= 9 >\n>tr|A|A_X Some kinase OS=Mus musculus GN=Xy1 PE=2\nMKLV\n</SBJCT>\n</QUERY>\n"
    path = put("y.sgml", text)
    q, s = T.tagged_hits(spark, path, ranges=True).orderBy("rank").collect()
    assert (q.qpid, q.nid, q.species, q.qseq, q.qseqlen, q.desc, q.genename) == ("q9", 3, "Homo sapiens", "MKLVMKLVA", 9, "Query protein", "")
    assert (s.spid, s.qcov, s.scov, s.species, s.genename, s.desc, s.qseq) == ("tr|A|A_X", 0.8, 0.5, "Mus musculus", "Xy1", "Some kinase", None)
    assert (s.qfrom, s.qto, s.sfrom, s.sto, s.sseqlen, s.vote) == (1, 8, 2, 9, 15, "4")
    assert T.tagged_hits(spark, path, plus_one=False).filter("rank = 1").first().qcov == 8 / 9


def test_dictionaries(spark, put):
    path = put("d.tab", "key\tvalue\na\t1\nb\t\na\t2\n\t9\nc\n")
    assert rows(T.dictionary(spark, path, header=True)) == [("a", "2"), ("b", "b"), ("c", "c")]
    assert rows(T.counts(spark, put("u.txt", "   12 some key\n  3 x\nbad\n"))) == [("SOME KEY", 12), ("X", 3)]
    assert rows(T.header_index(spark, put("i.txt", ">sp|P1|N_X Kinase OS=E coli\n>plain Text\n"))) == [("N_X", "Kinase"), ("P1", "Kinase"), ("plain", "Text")]
    df = spark.createDataFrame([("GO:1, GO:2;3 .",)], "c string")
    assert df.select(T.term_list(F.col("c"))).first()[0] == ["1", "2", "3"]


def test_ontology(spark, put):
    path = put("o.obo", "format-version: 1.2\n\n[Term]\nid: T:1\nname: root\nnamespace: mf\n\n[Term]\nid: T:2\nalt_id: T:9\nname: leaf one\nnamespace: mf\nis_a: T:1 ! root\nrelationship: part_of T:5\n\n[Term]\nid: T:3\nis_obsolete: true\nis_a: T:1\n\n[Typedef]\nid: part_of\n")
    o = T.obo(spark, path)
    assert rows(o["terms"]) == [("T:1", "T:1", "root", "mf"), ("T:2", "T:2", "leaf one", "mf"), ("T:9", "T:2", "leaf one", "mf")]
    assert rows(o["edges"]) == [("T:2", "T:1", "is_a"), ("T:2", "T:5", "part_of"), ("T:9", "T:1", "is_a"), ("T:9", "T:5", "part_of")]


def test_annotation_files(spark, put):
    path = put("a.gaf", "!gaf\nDB\tP1\tsym\t\tGO:7\tref\tIEA\tx\n")
    assert rows(T.gaf(spark, path)) == [("P1", "GO:7", "IEA")]
    path = put("sp.dat", "ID   A_X  Reviewed\nAC   P1; P2;\nFT   NON_STD         21\nFT   NON_STD         35\n//\nID   B_X\nAC   P3;\n//\n")
    assert rows(T.flat_entries(spark, path)) == [("A_X", "P1", 21), ("A_X", "P1", 35), ("B_X", "P3", None)]


def test_search_outputs(spark, put):
    line = "t1 - 100 q1 - 200 1e-5 50.5 0.1 1 2 1e-3 bad 40.0 0.2 1 90 5 95 4 96 0.9 some words here"
    r = T.hmm_domains(spark, put("d.tbl", f"# x\n{line}\n")).first()
    assert (r.target, r.tlen, r.evalue, r.ievalue, r.hmmto, r.description) == ("t1", 100, 1e-5, None, 90, "some words here")
    cm = "chr1 - tRNA - cm 1 72 900 829 - no 1 0.5 0.0 61.2 1e-12 !\n"
    assert rows(T.covariance_hits(spark, put("c.tbl", cm))) == [("tRNA", "chr1", 829, 900, "-", 61.2, 1e-12, "")]
    assert rows(T.predictor(spark, put("p.txt", "# h\nc1 10 99 12.5 +\nc1 x\n"), ["seq_id", "start", "end", "score", "strand"])) == [("c1", 10, 99, 12.5, "+"), ("c1", None, None, None, None)]
    assert rows(T.model_scores(spark, put("m.tsv", "id\tAla\tmito_Gly\nx\t1.5\t-\n"))) == [("x", "Ala", 1.5, "nuclear"), ("x", "Gly", None, "mito")]


def test_newick_and_subsequences(spark, put):
    got = rows(T.newick(spark, put("t.nwk", "((a:1,b:2.5):1,c);\n")).select("leaf", "length"))
    assert got == [("a", 1.0), ("b", 2.5), ("c", None)]
    seqs = spark.createDataFrame([("s", "ABCDEFG")], "id string, seq string")
    assert rows(T.subsequences(spark.createDataFrame([("s", 2, 4)], "id string, start int, end int"), seqs)) == [("s", 2, 4, "BCD")]


def test_sheet_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("q", ["A", "B"], None, True, 1.5), ("r", ["C"], "x", False, 2.0)], "qpid string, word array<string>, d string, status boolean, hidden double")
    K.sheet(df, f"{tmp_path}/s", hide=("hidden",), status="status")
    assert rows(T.table(spark, f"{tmp_path}/s", "qpid string, word string, d string")) == [("q", "A B", None)]


def test_feature_table(spark, tmp_path):
    df = spark.createDataFrame(
        [("CDS", "c1", 10, 90, -1, True, False, {"product": ["kinase"], "pseudo": ["_no_value"], "note": [""]}), ("tRNA", "c1", 5, 8, 1, False, False, {})],
        "primary_tag string, seq_id string, start int, end int, strand int, start_partial boolean, end_partial boolean, tags map<string,array<string>>",
    )
    lines = {r.start: r.lines for r in K.feature_lines(df).collect()}
    assert lines == {10: "90\t<10\tCDS\n\t\t\tproduct\tkinase\n\t\t\tpseudo", 5: "5\t8\ttRNA"}
    K.feature_table(df, f"{tmp_path}/f")
    assert spark.read.text(f"{tmp_path}/f").count() == 6
    assert rows(K.structured_comment(df)) == [("CDS\t1",), ("tRNA\t1",)]


def test_xml_and_intermediate(spark, tmp_path):
    df = spark.createDataFrame([("a", 3), ("b", 1)], "name string, n int")
    K.xml(df, f"{tmp_path}/x")
    back = spark.read.format("xml").option("rowTag", "entry").schema("name string, n int").load(f"{tmp_path}/x")
    assert rows(back) == [("a", 3), ("b", 1)]
    K.intermediate(df, f"{tmp_path}/i", ["n"])
    assert rows(spark.read.parquet(f"{tmp_path}/i")) == [("a", 3), ("b", 1)]


def test_profile_reports(spark, put):
    path = put("t.tbl", "# head\nT1 - Q1 PF1 1e-5 33.1 0.1 2e-5 30.0 0.0 1 1 0 0 1 1 1 1 text more\n\nT2 - Q1 PF1 bad 3 0 1 2 0\n")
    got = {r.target: r for r in T.hmm_targets(spark, path).collect()}
    assert (got["T1"].query, got["T1"].evalue, got["T1"].dscore) == ("Q1", 1e-5, 30.0) and got["T2"].evalue is None
    path = put("r.txt", "Scores:\nseq1   1/2   10   1500 [.     1  1400 ..   900.5   1e-30\nseq1   2/2  3000  4500 ..     1  1400 .]   -2.0       3\n   alignment *->acgt\n")
    assert rows(T.hmm_report(spark, path)) == [("seq1", 1, 10, 1500, 900.5, 1e-30), ("seq1", 2, 3000, 4500, -2.0, 3.0)]


def test_prediction_reports(spark, put):
    text = "sequence name= chr1\nlength= 1000\nstart position= 10 end position= 81\npotential tRNA sequence=  ACGT\nscore= 12.5\ntRNA predict as a tRNA- Ala : anticodon tgc\n"
    text += "sequence name= chr1\nlength= 1000\nstart position= 300 end position= 229\nscore= 9\ntRNA predict as a tRNA- Gly : anticodon gcc\nnothing\n"
    got = rows(T.raw_trnas(spark, put("raw.txt", text)))
    assert got == [("chr1", 10, 81, "+", 10, "Ala", "tgc", 12.5, 1000), ("chr1", 229, 300, "-", 701, "Gly", "gcc", 9.0, 1000)]
    text = "Sequence\t\ttRNA\ttRNA\tAnti\tInf\tHMM\nName\ttRNA #\tBegin\tEnd\tCodon\tScore\tScore\n--------\t------\t-----\t----\t-----\t---\t---\nchr1 \t1\t100\t171\tTGC\t75.2\t50.1\n"
    (r,) = T.final_table(spark, put("final.out", text)).collect()
    assert (r.seqname, r.start, r.end, r.anticodon, r.score, r.profile_score) == ("chr1", 100, 171, "TGC", 75.2, 50.1)
    text = "chr1.t1 (100-171)\tLength: 72 bp\nType: Ala\tAnticodon: TGC at 34-36 (133-135)\tScore: 75.2\n         *    |\nSeq: GGGCGTG\nStr: >>>..<<\n\nchr1.t2 (300-229)\tLength: 72 bp\nType: Gly\tAnticodon: GCC at 1-2\tScore: 60\nSeq: GCG\nStr: >.<\n"
    assert rows(T.structures(spark, put("x.ss", text))) == [("chr1.t1", 100, 171, 72, "Ala", "TGC", 75.2, "GGGCGTG", ">>>..<<"), ("chr1.t2", 300, 229, 72, "Gly", "GCC", 60.0, "GCG", ">.<")]
    assert rows(T.position_map(spark, put("p.txt", "#x\nt1\t1:1\t2:17a\tbad\n"))) == [("t1", 1, "1"), ("t1", 2, "17a")]
    assert rows(T.motif_counts(spark, put("m.txt", "x: 1\na: 9 9\nMotif counts:\na:  1 2\nc: 3  4\nend\n"))) == [("a", 1, 1), ("a", 2, 2), ("c", 1, 3), ("c", 2, 4)]


def test_term_tables(spark, put):
    assert rows(T.key_value_lines(spark, put("k.txt", "P1\tGO:1,GO:2\tmore\n\nP2\n"))) == [("P1", "GO:1,GO:2\tmore"), ("P2", None)]
    df = spark.createDataFrame([("a", "GO:1;GO:2", None), ("a", "GO:2", "GO:7"), ("b", None, None)], "k string, x string, y string")
    assert rows(T.term_sets(df, "k", ["x", "y"])) == [("a", ["1", "2", "7"]), ("b", [])]


def test_feature_lines_of_nine_columns(spark, tmp_path):
    df = spark.createDataFrame([("s", "rRNA", 90, 10, 5.5, -1, None, "16s"), ("s", "rRNA", 1, 5, None, 1, 0, None)], "seq_id string, feature string, start int, end int, score double, strand int, frame int, attribute string")
    assert {tuple(r) for r in K.gff_lines(df, "x").collect()} == {("s\tx\trRNA\t1\t5\t.\t+\t0\t.",), ("s\tx\trRNA\t10\t90\t5.5\t-\t.\t16s",)}
    K.gff(df, f"{tmp_path}/g", "x")
    assert [r.value.split("\t")[3] for r in spark.read.text(f"{tmp_path}/g").collect()] == ["1", "10"]
    K.suppressed_hits(df, f"{tmp_path}/m", ["seq_id", "start", "score"])
    assert sorted(map(tuple, spark.read.option("sep", "\t").csv(f"{tmp_path}/m").collect())) == [("s", "1", None), ("s", "90", "5.5")]
    p = spark.createDataFrame([("q", "DE", float(i), i / 20, f"t{i:02d}") for i in range(15)], "qpid string, type string, score double, ppv double, id string")
    got = rows(K.report_rows(p, "qpid", "type", "score").select("id", "rank", "colour"))
    assert len(got) == 10 and got[-1] == ("t14", 1, 70)
