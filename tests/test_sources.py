"""Readers and writers on small files."""

from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F

from strandloom.sources import bed, gtf, matrix, samplesheet, sequences, sinks
from strandloom.streaming import ingest

GTF = """#head
c1\tx\tgene\t1\t50\t.\t+\t.\tgene_id "G1";
c1\tx\texon\t1\t10\t.\t+\t.\tgene_id "G1"; transcript_id "T1"; tag "basic"; tag "CCDS"; empty; gene_biotype=coding
c1\tx\texon\t21\t30\t.\t+\t.\tgene_id=G1; transcript_id=T1
c1\tx\texon\t1\t10\t.\t+\t.\tgene_id "G2"; transcript_id "T2"
c2\tx\texon\t1\t10\t.\t+\t.\tgene_id "G2"; transcript_id "T2"
c1\tx\texon\t1\t10\t.\t+\t.\tgene_id "G3"
short\tline
"""


def put(path, text):
    path.write_text(text)
    return str(path)


def test_gtf(spark, tmp_path):
    p = put(tmp_path / "a.gtf", GTF)
    with gzip.open(tmp_path / "b.gtf.gz", "wt") as f:
        f.write(GTF)
    rows = gtf.read_gtf(spark, p)
    first = rows.filter("feature = 'exon'").first()
    assert (first.start0, first.end0, first.tags, first.attrs["gene_biotype"]) == (0, 10, ["basic", "CCDS"], "coding")
    assert rows.count() == gtf.read_gtf(spark, str(tmp_path / "b.gtf.gz")).count() == 6
    assert {r.tx for r in gtf.read_exons(spark, p).collect()} == {"T1"}
    mixed = gtf.read_exons(spark, p, "first").filter("tx = 'T2'").collect()
    assert {r.chrom for r in mixed} == {"c1"} and len(mixed) == 2
    out = tmp_path / "out"
    sinks.write_lines(gtf.to_gtf_lines(gtf.read_exons(spark, p)), str(out))
    again = gtf.read_exons(spark, str(out))
    key = lambda df: sorted((r.tx, r.start0, r.end0) for r in df.collect())
    assert key(again) == key(gtf.read_exons(spark, p))


def test_numbered_gff(spark, tmp_path):
    p = put(tmp_path / "x.gff", "c\ts\texon\t1\t9\t.\t+\t.\tT.1.ex2:3\nc\ts\tintron\t10\t19\t.\t+\t.\tT.1.in1:2\nc\ts\tother\t1\t2\t.\t+\t.\tT\n")
    assert sorted(tuple(r) for r in gtf.read_exon_intron_gff(spark, p).collect()) == [("T.1", "ex", 2, 3, "c", 0, 9), ("T.1", "in", 1, 2, "c", 9, 19)]
    g = put(tmp_path / "g.gtf", "c\ts\tgene\t1\t9\t4\t+\t.\tG\n")
    assert tuple(gtf.read_gene_regions(spark, g).first()) == ("c", 0, 9, 4)


def test_bed(spark, tmp_path):
    p = put(tmp_path / "a.bed", "#c\nc\t1\t5\nc\t2\t9\tn\t0\t-\nc\tx\t9\nc\t1\n")
    assert sorted((r.start0, r.end0, r.strand) for r in bed.read_bed(spark, p).collect()) == [(1, 5, "."), (2, 9, "-")]
    line = "c\t10\t50\tT\t0\t+\t10\t50\t0,0,0\t2\t5,10,\t0,30,"
    q = put(tmp_path / "b.bed", line + "\nc\t1\t2\n")
    from strandloom.operators import splice

    rows = bed.read_bed12(spark, q)
    assert rows.count() == 1
    assert [(r.start0, r.end0) for r in splice.bed12_exons(rows).orderBy("exon").collect()] == [(10, 15), (40, 50)]
    assert [(r.donor, r.acceptor) for r in splice.bed12_junctions(rows).collect()] == [(15, 40)]
    assert bed.to_bed12_lines(rows).first().value == line
    ids = spark.createDataFrame([("T",)], "tx string")
    assert sinks.failed_rows(rows, ids).count() == 1


def test_fasta_fai_fastq_sam(spark, tmp_path):
    fa = put(tmp_path / "g.fa", ">c1 text\nACGT\nac\n>c2\nTT\n")
    genome = sequences.read_fasta(spark, fa)
    assert {r.contig: r.seq for r in genome.collect()} == {"c1": "ACGTac", "c2": "TT"}
    assert {r.chrom: r.length for r in sequences.fasta_index(genome).collect()} == {"c1": 6, "c2": 2}
    fai = put(tmp_path / "g.fa.fai", "c1\t6\t9\t4\t5\n")
    assert tuple(sequences.read_fai(spark, fai).first()) == ("c1", 6)
    fq = put(tmp_path / "r.fastq", "@r1 x\nAC\n+\nII\n@r2\nGG\n+\nJJ\n")
    assert sorted(tuple(r) for r in sequences.read_fastq(spark, fq).collect()) == [("r1", "AC", "II"), ("r2", "GG", "JJ")]
    sam = put(tmp_path / "a.sam", "@HD\tx\nr1\t0\tc1\t5\t60\t4M\t*\t0\t0\tACGT\tIIII\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n")
    assert sorted((r.read_id, r.chrom, r.flag, r.pos) for r in sequences.read_sam(spark, sam, "s").collect()) == [("r1", "c1", 0, 4), ("r2", None, 4, -1)]
    sj = put(tmp_path / "SJ.out.tab", "c1\t11\t20\t2\t1\t1\t7\t3\t30\n")
    r = sequences.read_splice_table(spark, sj).first()
    assert (r.donor, r.acceptor, r.strand, r.annotated) == (10, 20, "-", True)


def test_small_tables(spark, tmp_path):
    ids = put(tmp_path / "ids", "a\tx\n\nb\na\n")
    assert {r.tx for r in sequences.read_first_column(spark, ids).collect()} == {"a", "b"}
    lens = put(tmp_path / "len.csv", "id,insertlen\n1,5\n2,7\n")
    assert [r.len for r in sequences.read_insert_lengths(spark, lens, "s").orderBy("len").collect()] == [5, 7]
    groups = put(tmp_path / "g.tsv", "File\tGroup\ns\tA\n")
    assert tuple(sequences.read_group_map(spark, groups).first()) == ("s", "A")
    with pytest.raises(ValueError, match="Group"):
        sequences.read_group_map(spark, put(tmp_path / "bad.tsv", "File\tOther\ns\tA\n"))


def test_matrix(spark, tmp_path):
    p = put(tmp_path / "m.tsv", "#TranscriptID\ts1\ts2\nT1\t1\tbad\nT2\t2.5\tNaN\n")
    got = {(r.tx, r["sample"]): r.value for r in matrix.read_matrix(spark, p, "transcriptid").collect()}
    assert got == {("T1", "s1"): 1.0, ("T1", "s2"): 0.0, ("T2", "s1"): 2.5, ("T2", "s2"): 0.0}
    with pytest.raises(Exception, match="(?i)cast"):
        matrix.read_matrix(spark, p, strict=True).collect()
    with pytest.raises(ValueError, match="no column"):
        matrix.read_matrix(spark, p, "other")
    out = tmp_path / "m.out"
    sinks.write_matrix(matrix.read_matrix(spark, p), ["s1", "s2"], str(out))
    again = {(r.tx, r["sample"]): r.value for r in matrix.read_matrix(spark, str(out)).collect()}
    assert again == got
    assert sinks.short_header(["id", "a/b/c", "x"]) == ["#TranscriptID", "b", "x"]
    sinks.write_ids(spark.createDataFrame([("b",), ("a",), ("b",)], "tx string"), str(tmp_path / "ids.out"))
    assert [r.value for r in spark.read.text(str(tmp_path / "ids.out")).collect()] == ["a", "b"]
    assert sinks.track_groups(spark.createDataFrame([("s",)], "sample string")).first().grp == "ALL"


def test_sample_sheet(spark, tmp_path):
    p = put(tmp_path / "s.csv", "sample,path_to_bam\na,x.bam\nb,y.bam\na,z.bam\n")
    assert sorted(tuple(r) for r in samplesheet.read_sample_sheet(spark, p).collect()) == [("a", "x.bam", 0), ("a", "z.bam", 1), ("b", "y.bam", 0)]
    for text, said in (("sample\na\n", "exactly one"), ("sample,path_to_bam\na,x.txt\n", "end in"), ("sample,path_to_bam\na,\n", "empty")):
        with pytest.raises(ValueError, match=said):
            samplesheet.read_sample_sheet(spark, put(tmp_path / "bad.csv", text))


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "c1", 0), (2, "a", "c1", 4), (3, "b", "chrM", 16)], "read_id long, sample string, chrom string, flag int")
    rows.write.parquet(str(tmp_path / "in"))
    q = ingest.contig_counts(ingest.stream_reads(spark, str(tmp_path / "in"), rows.schema)).writeStream.outputMode("complete").format("memory").queryName("counts").option("checkpointLocation", str(tmp_path / "ck")).start()
    try:
        q.processAllAvailable()
        got = {(r["sample"], r["chrom"]): r["n"] for r in spark.sql("select * from counts").collect()}
    finally:
        q.stop()
    assert got == {("a", "c1"): 1, ("b", "chrM"): 1}
    timed = rows.withColumn("ts", F.lit("2024-01-01 00:30:00").cast("timestamp"))
    assert ingest.windowed_counts(timed).count() == 2


def test_fastq_gz_and_many_splits(spark, tmp_path):
    records = [(f"r{k}", "ACGT" * (k % 7 + 1), "@III" * (k % 7 + 1)) for k in range(3000)]  # qualities begin like a header
    text = "".join(f"@{n} more\n{s}\n+\n{q}\n" for n, s, q in records)
    with gzip.open(tmp_path / "a.fastq.gz", "wt") as f:
        f.write(text)
    plain = put(tmp_path / "b.fastq", text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        for path in (str(tmp_path / "a.fastq.gz"), plain):
            assert sorted(tuple(r) for r in sequences.read_fastq(spark, path).collect()) == sorted(records)
        lines = sequences.numbered_lines(spark, [plain, str(tmp_path / "a.fastq.gz")]).collect()
        want = text.splitlines()
        assert len(lines) == 2 * len(want) and all(want[r.line] == r.value for r in lines)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sequences.read_fastq(spark, put(tmp_path / "empty.fastq", "")).count() == 0


def test_fasta_marks_only_at_line_starts(spark, tmp_path):
    fa = put(tmp_path / "g.fa", ">c1 from A->G edit\r\nAC>GT\r\nac\r\n>c2\n>c3 >x\nTT\n")
    assert {r.contig: r.seq for r in sequences.read_fasta(spark, fa).collect()} == {"c1": "AC>GTac", "c2": "", "c3": "TT"}


def test_gtf_order_is_that_of_the_paths_and_lines(spark, tmp_path):
    row = lambda t, e=9: f'c1\tx\texon\t1\t{e}\t.\t+\t.\tgene_id "G"; transcript_id "{t}"\n'
    small, big = put(tmp_path / "z.gtf", row("A")), put(tmp_path / "a.gtf", "".join(row(f"T{k}") for k in range(400)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # Spark packs large pieces first
    try:
        rows = gtf.read_exons(spark, [small, big])
        assert [r.tx for r in rows.orderBy("ord").collect()] == ["A", *(f"T{k}" for k in range(400))]
        assert gtf.read_exons(spark, [big, small]).orderBy("ord").collect()[-1].tx == "A"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_hierarchy_defaults(spark, tmp_path):
    text = 'c\tx\texon\t21\t30\t.\t-\t.\tgene_id "G"; transcript_id "T"; gene_biotype "p"; tag "a"; tag "b"\nc\tx\texon\t1\t9\t.\t-\t.\tgene_id "G"; transcript_id "T"; exon_number "7"; gene_name "N"\nc\tx\texon\t1\t9\t.\t-\t.\tgene_id "G"\n'
    rows = gtf.read_hierarchy(spark, put(tmp_path / "h.gtf", text)).orderBy("start0").collect()
    assert [(r.exon, r.gene_name, r.transcript_name, r.gene_type, r.tags) for r in rows] == [(7, "N", "T", None, []), (1, "G", "T", "p", ["a", "b"])]


def test_more_formats(spark, tmp_path):
    flat = put(tmp_path / "ref.flat", "G\tT\tc1\t+\t5\t60\t5\t60\t2\t5,40,\t10,60,\n#x\n")
    assert [tuple(r) for r in sequences.read_ref_flat(spark, flat).orderBy("exon").collect()] == [("G", "T", "c1", "+", 0, 5, 10), ("G", "T", "c1", "+", 1, 40, 60)]
    pile = put(tmp_path / "pile", "c1\t5\tA\t0\nc1\t6\tA\t3\t...\tIII\nc1\tx\n")
    assert [tuple(r) for r in sequences.read_pileup(spark, pile).orderBy("pos").collect()] == [("c1", 4, "A", 0), ("c1", 5, "A", 3)]
    assert [sinks.path_token(p, k) for p, k in (("a/b/c.txt", 2), ("a/b/c.txt", -2), ("/x", 3))] == ["b", "b", "/x"]
    order = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), ("c", 0)], "tx string, at int")
    sinks.write_ids_in_order(order, str(tmp_path / "ordered"), ["at"])
    assert [r.value for r in spark.read.text(str(tmp_path / "ordered")).collect()] == ["c", "b", "a"]


def test_sample_sheet_files_are_there(spark, tmp_path):
    bam = put(tmp_path / "x.bam", "")
    assert samplesheet.read_sample_sheet(spark, put(tmp_path / "s.csv", f"sample,path_to_bam\na,{bam}\n"), check_files=True).count() == 1
    with pytest.raises(ValueError, match="gone.bam"):
        samplesheet.read_sample_sheet(spark, put(tmp_path / "t.csv", f"sample,path_to_bam\na,{bam}\nb,{tmp_path}/gone.bam\n"), check_files=True)


def test_configuration_files(tmp_path):
    pytest.importorskip("yaml")
    from strandloom.config import EngineConfig

    base = put(tmp_path / "a.yaml", "samples: s.csv\nremove_isoforms_overlapping_PAR_regions: 'no'\nfilt_tpm_min_count: 2\nmatch_mode: exact\n")
    over = put(tmp_path / "b.yaml", "filt_tpm_min_count: 3\n")
    cfg = EngineConfig.from_files(base, over)
    assert (cfg.filter_par, cfg.tpm_min, cfg.match_mode, cfg.tss_max_distance) == (False, 3, "exact", 10)


def test_one_attribute_is_that_of_the_map(spark):
    texts = ['gene_id "g"; transcript_id "t"; tag "a"; valueless; tag "b";', "gene_id=g1;tag=x y;gene_id = g2 ;", 'gene_id ""; tag  ;other "gene_id 7"; xgene_id 5', "gene_id", "gene_id = ; gene_id\t9", "", None, 'gene_id "a"; gene_id ; tag==z', ' gene_id  " q " ;tag "é;tag 3']
    c = F.col("a")
    rows = spark.createDataFrame([(x,) for x in texts], "a string").select(gtf.attribute_map(c).alias("m"), gtf.attribute(c, "gene_id").alias("one"), gtf.attribute_values(c, "tag").alias("tags"), F.transform(F.filter(gtf._pairs(c), lambda p: p["key"] == "tag"), lambda p: p["value"]).alias("want"))
    got = rows.collect()
    assert [(r.m or {}).get("gene_id") for r in got] == [r.one for r in got] == ["g", "g2", "", None, "9", None, None, "a", " q "]
    assert [r.tags for r in got] == [r.want for r in got]


def test_readers_of_exons_build_no_map(spark, tmp_path):
    (tmp_path / "a.gtf").write_text('c\tx\texon\t1\t9\t.\t+\t.\tgene_id "g"; transcript_id "t"; tag "b";\n')
    for rows in (gtf.read_exons(spark, str(tmp_path / "a.gtf")), gtf.read_hierarchy(spark, str(tmp_path / "a.gtf"))):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "map_from" not in plan and "Expand" not in plan and [r.tags for r in rows.collect()] == [["b"]]
