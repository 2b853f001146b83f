"""Streaming corpus encoder and file scans on small written fixtures."""

import os

from pyspark.sql import functions as F

from assayspark.functions.tokens import decode
from assayspark.sources import files as R
from assayspark.streaming import corpus_stream, encoded_corpus


def test_corpus_stream_matches_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("CCO\nC1CC1\nxyz\n\nC(=O)O\n")
    (src / "b.txt").write_text("[NH4+]\n" + "C" * 200 + "\n")
    q = corpus_stream(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    got = sorted(r.s for r in out.collect())
    batch = encoded_corpus(spark.read.text(str(src)).select("value", "_metadata"))
    assert got == sorted(r.s for r in batch.collect()) == sorted(["CCO", "C1CC1", "C(=O)O", "[NH4+]"])
    dec = out.select(decode(F.transform("tokens", lambda t: t.cast("int"))).alias("d"), "s").collect()
    assert all(r.d == r.s for r in dec)


def test_first_line_comment_and_header(spark, tmp_path):
    p = tmp_path / "mut.tsv"
    p.write_text("#version 1\nHugo_Symbol\tTumor_Sample_Barcode\tConsequence\nTP53\tS1\tmissense\n#odd\tS2\tstop\n")
    m = R.read_mutations(spark, str(p))
    rows = sorted(tuple(r) for r in m.collect())
    assert rows == [("#odd", "S2", "stop"), ("TP53", "S1", "missense")]


def test_files_with_and_without_a_comment_line(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("#version 1\nHugo_Symbol\tTumor_Sample_Barcode\tConsequence\nA\tS1\tx\nB\tS2\ty\n")
    (tmp_path / "b.tsv").write_text("Consequence\tHugo_Symbol\tTumor_Sample_Barcode\nz\tC\tS3\n\tD\tS4\n")
    m = R.read_mutations(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")])
    assert sorted(tuple(r) for r in m.collect()) == [("A", "S1", "x"), ("B", "S2", "y"), ("C", "S3", "z"), ("D", "S4", None)]


def test_cohorts_with_different_samples(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("Hugo_Symbol\tEntrez_Gene_Id\tS1\tS2\nG1\t1\t1.5\tx\nG2\t2\t\t4\n")
    (tmp_path / "b.tsv").write_text("Hugo_Symbol\tEntrez_Gene_Id\tT9\tT8\tS1\nG1\t1\t9\t8\t7\n")
    e = R.read_expression(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")])
    got = sorted((r.dataset[-5:], r.feature, r["sample"], r.value) for r in e.fillna(-1.0).collect())
    assert got == [
        ("a.tsv", "G1", "S1", 1.5), ("a.tsv", "G1", "S2", -1.0), ("a.tsv", "G2", "S1", -1.0), ("a.tsv", "G2", "S2", 4.0),
        ("b.tsv", "G1", "S1", 7.0), ("b.tsv", "G1", "T8", 8.0), ("b.tsv", "G1", "T9", 9.0),
    ]
    t = R.read_tsv_table(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")])
    assert t.columns == ["Hugo_Symbol", "Entrez_Gene_Id", "S1", "S2", "T9", "T8", "dataset"]


def test_row_index_follows_file_order(spark, tmp_path):
    d = tmp_path / "lines"
    d.mkdir()
    (d / "part-0.txt").write_text("".join(f"a{i}\n" for i in range(5)))
    (d / "part-1.txt").write_text("".join(f"b{i}\n" for i in range(3)))
    got = [r.value for r in R.read_lines(spark, str(d)).orderBy("row_idx").collect()]
    assert got == [f"a{i}" for i in range(5)] + [f"b{i}" for i in range(3)]


def test_fasta_scan(spark, tmp_path):
    p = tmp_path / "g.fa"
    p.write_text(">chr1 desc\nACGT\nacgn\n>chr2\n\n>chr3\nTT\n")
    for chunk, one in ((100, ["ACGTacgn"]), (3, ["ACG", "Tac", "gn"])):
        got = {}
        for r in sorted(R.read_fasta(spark, str(p), chunk).collect(), key=lambda r: (r.chrom, r.chunk_id)):
            assert r.chunk_start == r.chunk_id * chunk
            got.setdefault(r.chrom, []).append(r.seq)
        assert got == {"chr1": one, "chr2": [""], "chr3": ["TT"]}


def test_manifest_unknown_label_fails(spark, tmp_path):
    p = tmp_path / "m.txt"
    p.write_text("DMSO a b c\nNotALabel d e f\n")
    import pytest

    with pytest.raises(Exception):
        R.read_manifest(spark, str(p), {"DMSO": 3}).collect()


def test_track_folder_region_filter(spark, tmp_path):
    d = tmp_path / "tracks"
    d.mkdir()
    (d / "h3k4.bed").write_text("c1\t0\t10\t1.0\nc1\t10\t20\t2.0\nc2\t0\t5\t9.0\n")
    (d / "dnase.bed").write_text("c1\t5\t15\tnan\n")
    t = R.read_tracks(spark, str(d), chrom="c1", start=12, end=30)
    assert sorted((r.track, r.start) for r in t.collect()) == [("dnase", 5), ("h3k4", 10)]
    assert os.path.exists(str(d))
