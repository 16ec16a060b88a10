"""Queries that write the tables as the formats of the domain, read them back, and compare with SQL over the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.lineage import cut, shared_dir
from strandloom.operators import annotation, reports, splice
from strandloom.operators import reads as rd
from strandloom.sources import bed, gtf, matrix, samplesheet, sequences, sinks

from . import screening
from .core import SAMPLES, tx_of
from .fixtures import ctes, exons, expression, genome, read, regions
from .fixtures import reads as alignments

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def place(s: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(s)}/strandloom/{name}-{uuid.uuid4().hex}"


def put(s: SparkSession, lines: DataFrame, name: str, compression: str = "none") -> str:
    """Path of the text lines, written."""
    path = place(s, name)
    lines.write.option("compression", compression).text(path)
    return path


def tabbed(*columns: Column | str) -> Column:
    return F.concat_ws("\t", *((F.col(c) if isinstance(c, str) else c).cast("string") for c in columns)).alias("value")


_TEXT_EXON = "SELECT CAST(tx AS VARCHAR) AS tx, CAST(gene AS VARCHAR) AS gene, chrom, strand, start0, end0 FROM exon"


@query("gtf_exons_read", ctes("exon") + " " + _TEXT_EXON)
def gtf_exons_read(s: SparkSession, d: str) -> DataFrame:
    path = put(s, gtf.to_gtf_lines(exons(s, d)), "exons-gtf", "gzip")
    return gtf.read_exons(s, path).select("tx", "gene", "chrom", "strand", "start0", "end0")


@query("gtf_hierarchy_read", ctes("exon") + " SELECT CAST(tx AS VARCHAR) AS tx, CAST(gene AS VARCHAR) AS gene, CAST(gene AS VARCHAR) AS gene_name, 'coding' AS gene_type, CAST(row_number() OVER (PARTITION BY tx ORDER BY start0) AS INTEGER) AS exon, start0, end0, 'basic' AS tag FROM exon")
def gtf_hierarchy_read(s: SparkSession, d: str) -> DataFrame:
    """Without exon numbers and gene names; biotypes stand for types."""
    lines = gtf.to_gtf_lines(exons(s, d)).select(F.concat("value", F.lit(' gene_biotype "coding"; tag "basic"; valueless;')).alias("value"))
    rows = gtf.read_hierarchy(s, put(s, lines, "hierarchy-gtf"))
    return rows.select("tx", "gene", "gene_name", "gene_type", "exon", "start0", "end0", F.array_join("tags", ",").alias("tag"))


_DEPTH = "dep AS (SELECT tx, chrom, strand, start0, end0, count(*) OVER (PARTITION BY tx) AS depth FROM exon)"


@query("singletons_dropped", ctes("exon") + f", {_DEPTH} SELECT CAST(tx AS VARCHAR) AS tx, chrom, start0, end0, CAST(depth AS BIGINT) AS depth FROM dep WHERE depth <> 1 AND regexp_matches(chrom, '^chr[0-9]+$')")
def singletons_dropped(s: SparkSession, d: str) -> DataFrame:
    """Depths as an attribute of the lines (here the number of exons); single ones go, other chromosomes too."""
    ex_ = exons(s, d)
    depth = ex_.groupBy("tx").agg(F.count("*").alias("n"))
    attrs = F.concat(F.lit('gene_id "g"; transcript_id "'), F.col("tx").cast("string"), F.lit('"; depth "'), F.col("n").cast("string"), F.lit('";'))
    lines = ex_.join(depth, "tx").select(tabbed("chrom", F.lit("x"), F.lit("exon"), F.col("start0") + 1, "end0", F.lit("."), "strand", F.lit("."), attrs))
    odd = s.createDataFrame([('chrUn_1\tx\texon\t1\t9\t.\t+\t.\tgene_id "g"; transcript_id "u"; depth "5";',)], "value string")
    rows = gtf.read_gtf(s, put(s, lines.unionAll(odd), "depth-gtf"), names=("transcript_id", "depth"))
    rows = rows.select(F.col("at__transcript_id").alias("tx"), "chrom", "start0", "end0", F.col("at__depth").try_cast("bigint").alias("depth"))
    return rd.on_chromosomes(rd.drop_singletons(rows))


@query("collapsed_gtf_read", ctes("exon") + f", {screening._GENES}, {screening._COLLAPSE}, {screening._MODEL} SELECT CAST(gene AS VARCHAR) AS gene, gene || '_' || exon AS exon_id, CAST(exon AS INTEGER) AS exon, chrom, strand, start0, end0 FROM num")
def collapsed_gtf_read(s: SparkSession, d: str) -> DataFrame:
    """The collapsed model as GTF lines, read back."""
    path = put(s, annotation.to_gtf(screening.collapse_annotation(s, d)), "collapsed-gtf")
    return gtf.read_hierarchy(s, path).select("gene", "exon_id", "exon", "chrom", "strand", "start0", "end0")


@query("bed_regions_read", ctes("reg") + " SELECT CAST(rid AS VARCHAR) AS name, chrom, start0, end0, '.' AS strand FROM reg")
def bed_regions_read(s: SparkSession, d: str) -> DataFrame:
    return bed.read_bed(s, put(s, regions(s, d).select(tabbed("chrom", "start0", "end0", "rid")), "regions-bed")).select("name", "chrom", "start0", "end0", "strand")


@query("bed12_failed_rows", ctes("exon", "txs") + " SELECT CAST(tx AS VARCHAR) AS name, chrom, strand, row_number() OVER (PARTITION BY tx ORDER BY start0) AS exon, start0, end0 FROM exon WHERE tx IN (SELECT tx FROM txs WHERE n_exons < 3)")
def bed12_failed_rows(s: SparkSession, d: str) -> DataFrame:
    """Rows of a BED12 file whose names failed (here: those with few exons), in the file's order."""
    rows = bed.read_bed12(s, put(s, bed.to_bed12_lines(splice.to_bed12(tx_of(s, d))), "transcripts-bed12"))
    failing = tx_of(s, d).filter("size(exons) < 3").select("tx")
    return splice.bed12_exons(sinks.failed_rows(rows, failing, order=["chrom", "start", "name"]))


@query("fasta_read", ctes("genome") + " SELECT CAST(contig AS VARCHAR) AS contig, CAST(length(seq) AS BIGINT) AS length, md5(seq) AS md5 FROM genome")
def fasta_read(s: SparkSession, d: str) -> DataFrame:
    """Headers hold a ``>`` of their own; sequences are broken into lines of 70 bases."""
    folded = F.regexp_replace("seq", "(.{70})", "$1\n")
    records = genome(s, d).select(F.concat(F.lit(">"), F.col("contig").cast("string"), F.lit(" from A->G\n"), folded).alias("value"))
    found = sequences.read_fasta(s, put(s, records, "genome-fa", "gzip"))
    sizes = sequences.fasta_index(found)
    return found.join(sizes, F.col("contig") == F.col("chrom")).select("contig", "length", F.md5(F.col("seq").cast("binary")).alias("md5"))


@query("fai_read", ctes("genome") + " SELECT CAST(contig AS VARCHAR) AS chrom, CAST(length(seq) AS BIGINT) AS length FROM genome")
def fai_read(s: SparkSession, d: str) -> DataFrame:
    lines = genome(s, d).select(tabbed("contig", F.length("seq"), F.lit(6), F.lit(60), F.lit(61)))
    return sequences.read_fai(s, put(s, lines, "genome-fai"))


@query("matrix_read", ctes("expr") + ", s4 AS (SELECT unnest([0, 1, 2, 3]) AS sample), t AS (SELECT DISTINCT tx FROM expr) SELECT CAST(t.tx AS VARCHAR) AS tx, 's' || s4.sample AS sample, coalesce(value, 0) AS value FROM t CROSS JOIN s4 LEFT JOIN expr e ON e.tx = t.tx AND e.sample = s4.sample")
def matrix_read(s: SparkSession, d: str) -> DataFrame:
    """A count matrix, written and read as integers."""
    names = [f"s{k}" for k in SAMPLES]
    path = place(s, "counts")
    sinks.write_matrix(expression(s, d).withColumn("sample", F.concat(F.lit("s"), F.col("sample").cast("string"))), names, path)
    return matrix.read_matrix(s, path, strict=True)


@query("exon_intron_gff_read", ctes("exon", "junc") + """ SELECT 'T' || tx AS tx, 'ex' AS kind, CAST(row_number() OVER (PARTITION BY tx ORDER BY start0) AS INTEGER) AS ord, CAST(count(*) OVER (PARTITION BY tx) AS INTEGER) AS cnt, chrom, start0, end0 FROM exon
UNION ALL SELECT 'T' || tx, 'in', CAST(row_number() OVER (PARTITION BY tx ORDER BY donor) AS INTEGER), CAST(count(*) OVER (PARTITION BY tx) AS INTEGER), chrom, donor, acceptor FROM junc WHERE acceptor > donor""")
def exon_intron_gff_read(s: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lit("T"), F.col("tx").cast("string"), F.lit("."), F.col("kind"), F.col("ord").cast("string"), F.lit(":"), F.col("cnt").cast("string"))
    lines = splice.numbered(tx_of(s, d)).select(tabbed("chrom", F.lit("x"), "kind", F.col("start0") + 1, "end0", F.lit("."), F.lit("+"), F.lit("."), name))
    return gtf.read_exon_intron_gff(s, put(s, lines, "numbered-gff"))


@query("gene_regions_read", ctes("reg") + " SELECT chrom, start0, end0, CAST(rid % 3 AS INTEGER) AS n_exons FROM reg")
def gene_regions_read(s: SparkSession, d: str) -> DataFrame:
    lines = regions(s, d).select(tabbed("chrom", F.lit("x"), F.lit("gene"), F.col("start0") + 1, "end0", F.col("rid") % 3, F.lit("+"), F.lit("."), "rid"))
    return gtf.read_gene_regions(s, put(s, lines, "gene-regions"))


def _table(df: DataFrame, path: str, sep: str = ",") -> str:
    df.coalesce(1).write.csv(path, header=True, sep=sep)
    return path


@query("insert_lengths_read", "SELECT 'a' AS sample, CAST(n_chars AS INTEGER) AS len FROM documents")
def insert_lengths_read(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "documents").select(F.col("doc_id").alias("id"), F.col("n_chars").alias("insertlen"))
    path = place(s, "insert-lengths")
    rows.write.csv(path, header=True)
    return sequences.read_insert_lengths(s, path, "a")


@query("group_map_read", "SELECT DISTINCT 'n' || n_nationkey AS sample, 'ALL' AS grp FROM nation")
def group_map_read(s: SparkSession, d: str) -> DataFrame:
    """Every sample in one track group, as the file-to-group table has it."""
    groups = sinks.track_groups(read(s, d, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("sample")))
    return sequences.read_group_map(s, _table(groups.select(F.col("sample").alias("File"), F.col("grp").alias("Group")), place(s, "groups"), "\t"))


@query("splice_table_read", ctes("exon", "junc") + " SELECT chrom, donor, acceptor, strand, CAST(1 AS INTEGER) AS motif, tx % 2 = 1 AS annotated, CAST(tx % 9 AS INTEGER) AS unique_reads, CAST(3 AS INTEGER) AS multi_reads, CAST(tx % 50 AS INTEGER) AS overhang FROM junc")
def splice_table_read(s: SparkSession, d: str) -> DataFrame:
    j = splice.junctions(tx_of(s, d))
    strand = F.when(F.col("strand") == "+", 1).otherwise(2)
    lines = j.select(tabbed("chrom", F.col("donor") + 1, "acceptor", strand, F.lit(1), F.col("tx") % 2, F.col("tx") % 9, F.lit(3), F.col("tx") % 50))
    return sequences.read_splice_table(s, put(s, lines, "junction-table"))


@query("ref_flat_read", ctes("exon") + " SELECT CAST(gene AS VARCHAR) AS gene, CAST(tx AS VARCHAR) AS tx, chrom, strand, CAST(row_number() OVER (PARTITION BY tx ORDER BY start0) - 1 AS INTEGER) AS exon, start0, end0 FROM exon")
def ref_flat_read(s: SparkSession, d: str) -> DataFrame:
    ends = lambda c: F.concat(F.array_join(F.transform("exons", lambda e: e[c].cast("string")), ","), F.lit(","))
    lines = tx_of(s, d).select(tabbed("gene", "tx", "chrom", "strand", "lo", "hi", "lo", "hi", F.size("exons"), ends("start0"), ends("end0")))
    return sequences.read_ref_flat(s, put(s, lines, "ref-flat"))


@query("sam_read", ctes("reads") + " SELECT 'r' || read_id AS read_id, 'a' AS sample, chrom, flag, pos FROM reads")
def sam_read(s: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lit("r"), F.col("read_id").cast("string"))
    star = F.lit("*")
    lines = alignments(s, d).select(tabbed(name, "flag", "chrom", F.col("pos") + 1, F.lit(60), star, star, F.lit(0), F.lit(0), F.lit("AC"), F.lit("II")))
    return sequences.read_sam(s, put(s, lines, "reads-sam"), "a").select("read_id", "sample", "chrom", "flag", "pos")


@query("named_reads_cap", ctes("reads") + """, prim AS (SELECT 'r' || read_id AS read_id, sample, chrom, flag FROM reads WHERE (flag & 2308) = 0), ranked AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY md5(read_id || ':7'), read_id) AS r FROM prim WHERE chrom = 'chrM')
SELECT read_id, sample, chrom FROM prim WHERE chrom <> 'chrM' UNION ALL SELECT read_id, sample, chrom FROM ranked WHERE r <= 100""")
def named_reads_cap(s: SparkSession, d: str) -> DataFrame:
    """Reads by name, capped in each sample."""
    named = alignments(s, d).withColumn("read_id", F.concat(F.lit("r"), F.col("read_id").cast("string")))
    return rd.reservoir_cap(named, 100, 7, keys=("sample",)).select("read_id", "sample", "chrom")


@query("id_list_read", ctes("exon") + " SELECT DISTINCT CAST(gene AS VARCHAR) AS tx FROM exon")
def id_list_read(s: SparkSession, d: str) -> DataFrame:
    path = place(s, "ids")
    sinks.write_ids(exons(s, d), path, "gene")
    return sequences.read_first_column(s, path)


@query("ids_in_bed_order", ctes("exon", "txs") + " SELECT CAST(tx AS VARCHAR) AS tx, row_number() OVER (ORDER BY chrom, lo, tx) - 1 AS line FROM txs")
def ids_in_bed_order(s: SparkSession, d: str) -> DataFrame:
    """Ids in the order of the BED file that they were found in: the lines of the written file, numbered."""
    path = place(s, "ordered-ids")
    sinks.write_ids_in_order(tx_of(s, d), path, ["chrom", "lo", "tx"])
    return _in_order(s, path)


def _in_order(s: SparkSession, path: str) -> DataFrame:
    """tx and line of a folder's lines, its files in the order of their names."""
    lines = cut(sequences.numbered_lines(s, path), "numbered-lines")
    files = lines.groupBy("file").agg(F.count("*").alias("n"))  # one row a file
    before = files.select(F.col("file").alias("g"), (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("first"))
    return lines.join(before, F.col("file") == F.col("g")).select(F.col("value").alias("tx"), (F.col("line") + F.col("first")).alias("line"))


@query("ids_sorted", "SELECT tx, row_number() OVER (ORDER BY tx) - 1 AS line FROM (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS tx FROM lineitem)")
def ids_sorted(s: SparkSession, d: str) -> DataFrame:
    """Ids as written: distinct, and in order over all files."""
    path = place(s, "sorted-ids")
    sinks.write_ids(exons(s, d), path)
    return _in_order(s, path)


@query("matrix_sorted", ctes("expr") + " SELECT CAST(tx AS VARCHAR) AS tx, row_number() OVER (ORDER BY tx) - 1 AS line FROM (SELECT DISTINCT tx FROM expr)")
def matrix_sorted(s: SparkSession, d: str) -> DataFrame:
    """The ids of a matrix in the order of its file (rows sorted by id)."""
    path = place(s, "sorted-matrix")
    sinks.to_matrix(expression(s, d), SAMPLES).select(F.col("`#TranscriptID`").cast("string").alias("value")).write.text(path)
    return _in_order(s, path)


@query("header_rewritten", ctes("expr") + ", s4 AS (SELECT unnest([0, 1, 2, 3]) AS sample), t AS (SELECT DISTINCT tx FROM expr) SELECT CAST(t.tx AS VARCHAR) AS tx, 's' || s4.sample AS sample, CAST(coalesce(value, 0) AS BIGINT) AS value FROM t CROSS JOIN s4 LEFT JOIN expr e ON e.tx = t.tx AND e.sample = s4.sample")
def header_rewritten(s: SparkSession, d: str) -> DataFrame:
    """A matrix whose columns are paths, read with the samples' names."""
    path = place(s, "path-matrix")
    sinks.write_matrix(expression(s, d).withColumn("sample", F.concat(F.lit("03_x/s"), F.col("sample").cast("string"), F.lit("/s.txt"))), [f"03_x/s{k}/s.txt" for k in SAMPLES], path, "id")
    rows = sinks.read_short_matrix(s, path).withColumnRenamed("#TranscriptID", "tx")
    return rows.unpivot("tx", [f"s{k}" for k in SAMPLES], "sample", "value").withColumn("value", F.col("value").cast("bigint"))


@query("path_tokens", "WITH p AS (SELECT page_id, url, list_filter(string_split(url, '/'), lambda x: x <> '') AS t FROM pages) SELECT page_id, coalesce(t[2], url) AS second, coalesce(t[-1], url) AS last, coalesce(t[7], url) AS seventh FROM p")
def path_tokens(s: SparkSession, d: str) -> DataFrame:
    """Components of the pages' addresses, from the front and the back."""
    return read(s, d, "pages").select("page_id", *(sinks.path_tokens(F.col("url"), k).alias(n) for n, k in (("second", 2), ("last", -1), ("seventh", 7))))


@query("attributes_completed", """WITH p AS (SELECT p_partkey AS k, 'g' || p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS name, p_type AS type, CASE WHEN p_partkey % 3 = 0 THEN 'T' || p_size END AS tname, p_brand FROM part)
SELECT k, 'gene_id "' || id || '"; transcript_id "' || id || '"; gene_type "' || type || '"; gene_name "' || coalesce(name, id) || '"; transcript_type "' || type || '"; transcript_name "' || coalesce(tname, name, id) || '"; level "2"; brand "' || p_brand || '";' AS attributes FROM p""")
def attributes_completed(s: SparkSession, d: str) -> DataFrame:
    """Gene attributes, some missing, completed for the transcript."""
    entry = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    key = F.col("p_partkey")
    parts = F.array(entry("gene_id", F.concat(F.lit("g"), key.cast("string"))), entry("gene_type", F.col("p_type")), entry("level", F.lit("2")), entry("brand", F.col("p_brand")), entry("gene_name", F.when(key % 2 == 0, F.col("p_name"))), entry("transcript_name", F.when(key % 3 == 0, F.concat(F.lit("T"), F.col("p_size").cast("string")))))
    attrs = F.map_from_entries(F.filter(parts, lambda e: e["value"].isNotNull()))
    return read(s, d, "part").select(key.alias("k"), annotation.complete_attributes(attrs).alias("attributes"))


@query("gtf_mixed_places", ctes("exon") + """, g AS (SELECT CAST(tx AS VARCHAR) AS tx, CAST(gene AS VARCHAR) AS gene, chrom, strand, start0, end0, tx % 3 = 0 AS mixed FROM exon),
h AS (SELECT DISTINCT tx, chrom, strand FROM g)
SELECT 'first' AS mode, tx, gene, chrom, strand, start0, end0 FROM g UNION ALL SELECT 'first', g.tx, g.gene, h.chrom, h.strand, start0 + 7, end0 + 9 FROM g JOIN h ON h.tx = g.tx WHERE mixed
UNION ALL SELECT 'drop', tx, gene, chrom, strand, start0, end0 FROM g WHERE NOT mixed""")
def gtf_mixed_places(s: SparkSession, d: str) -> DataFrame:
    """Transcripts with lines on a second chromosome: dropped, or taken to the place of their first line."""
    ex_ = exons(s, d)
    odd = ex_.filter("tx % 3 = 0").select("tx", "gene", F.lit("zz").alias("chrom"), "strand", (F.col("start0") + 7).alias("start0"), (F.col("end0") + 9).alias("end0"))
    lines = gtf.to_gtf_lines(ex_.unionByName(odd)).repartition(F.regexp_extract("value", 'transcript_id "([^"]+)"', 1)).sortWithinPartitions("value")
    path = put(s, lines, "mixed-gtf")  # a transcript's lines in one file, those of the second chromosome after the others
    cols = ["tx", "gene", "chrom", "strand", "start0", "end0"]
    return gtf.read_exons(s, path, "first").select(F.lit("first").alias("mode"), *cols).unionByName(gtf.read_exons(s, path, "drop").select(F.lit("drop").alias("mode"), *cols))


def _fastq(s: SparkSession, d: str) -> DataFrame:
    """Reads from the genome's contigs; qualities follow the bases."""
    qual = F.translate(F.col("seq"), "ACGT", "5?I+")
    rows = genome(s, d).filter("seq <> ''").select(F.concat(F.lit("@c"), F.col("contig").cast("string"), F.lit(" part\n"), F.col("seq"), F.lit("\n+\n"), qual).alias("value"))
    return sequences.read_fastq(s, put(s, rows, "reads-fastq", "gzip"))


@query("fastq_read", ctes("genome") + " SELECT 'c' || contig AS read_id, md5(seq) AS seq, md5(translate(seq, 'ACGT', '5?I+')) AS qual FROM genome WHERE seq <> ''")
def fastq_read(s: SparkSession, d: str) -> DataFrame:
    md5 = lambda c: F.md5(F.col(c).cast("binary")).alias(c)
    return _fastq(s, d).select("read_id", md5("seq"), md5("qual"))


@query("quality_shares", ctes("genome") + """, n AS (SELECT contig % 2 AS sample, sum(length(seq)) AS n, sum(length(replace(replace(replace(seq, 'C', ''), 'G', ''), 'T', ''))) AS a, sum(length(replace(replace(replace(seq, 'A', ''), 'G', ''), 'T', ''))) AS c, sum(length(replace(replace(replace(seq, 'A', ''), 'C', ''), 'T', ''))) AS g FROM genome WHERE seq <> '' GROUP BY 1)
SELECT sample, round((a + c + g) / n * 100, 2) AS q20_pct, round((c + g) / n * 100, 2) AS q30_pct, round(-10 * log10((a * pow(10, -2.0) + c * pow(10, -3.0) + g * pow(10, -4.0) + (n - a - c - g) * pow(10, -1.0)) / n), 2) AS avg_qual FROM n""")
def quality_shares(s: SparkSession, d: str) -> DataFrame:
    return reports.quality_shares(_fastq(s, d).withColumn("sample", F.substring("read_id", 2, 20).cast("bigint") % 2))


@query("sample_sheet_read", "SELECT 's' || s_nationkey AS sample, 'x/' || s_suppkey || '.bam' AS path, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS INTEGER) AS part FROM supplier")
def sample_sheet_read(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "supplier").orderBy("s_suppkey").select(F.concat(F.lit("s"), F.col("s_nationkey").cast("string")).alias("sample"), F.concat(F.lit("x/"), F.col("s_suppkey").cast("string"), F.lit(".bam")).alias("path_to_bam"))
    return samplesheet.read_sample_sheet(s, _table(rows, place(s, "sheet")))


@query("parts_written", "SELECT CAST((count(*) + 999) // 1000 AS BIGINT) AS parts, count(*) AS n FROM (SELECT DISTINCT l_orderkey FROM lineitem)")
def parts_written(s: SparkSession, d: str) -> DataFrame:
    """Transcripts cut into tables of at most 1,000 rows."""
    path = place(s, "parts")
    sinks.write_parts(read(s, d, "lineitem").select("l_orderkey").distinct(), path, 1000)
    files = s.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
    return files.agg(F.count_if(F.col("n") <= 1000).alias("parts"), F.sum("n").alias("n"))


_PILE = "pile AS (SELECT 'chr' || (l_suppkey % 5) AS chrom, l_orderkey * 8 + l_linenumber AS pos, CAST(l_quantity AS BIGINT) - 1 AS depth, CAST(l_linenumber AS BIGINT) AS reads2 FROM lineitem)"


def _pileup(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "lineitem").select(F.concat(F.lit("chr"), (F.col("l_suppkey") % 5).cast("string")).alias("chrom"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pos"), (F.col("l_quantity").cast("bigint") - 1).alias("depth"), F.col("l_linenumber").cast("bigint").alias("reads2"))


@query("covered_positions", f"WITH {_PILE} SELECT chrom, pos, depth FROM pile WHERE depth <> 0")
def covered_positions(s: SparkSession, d: str) -> DataFrame:
    lines = _pileup(s, d).select(tabbed("chrom", F.col("pos") + 1, F.lit("A"), "depth", F.lit("..,"), F.lit("III")))
    return rd.covered(sequences.read_pileup(s, put(s, lines, "pileup"))).select("chrom", "pos", "depth")


@query("called_variants", f"WITH {_PILE} SELECT chrom, pos, depth, reads2 FROM pile WHERE depth >= 20 AND reads2 >= 4")
def called_variants(s: SparkSession, d: str) -> DataFrame:
    return rd.called_variants(_pileup(s, d))


@query("modal_ends_applied", ctes("exon", "txs") + """, pt AS (SELECT gene, CASE WHEN strand = '-' THEN hi ELSE lo END AS a, CASE WHEN strand = '-' THEN lo ELSE hi END AS b FROM txs),
na AS (SELECT gene, a, count(*) AS n FROM pt GROUP BY ALL), nb AS (SELECT gene, b, count(*) AS n FROM pt GROUP BY ALL),
ma AS (SELECT gene, arg_min(a, (-n) * 100000000000 + a) AS a FROM na GROUP BY gene), mb AS (SELECT gene, arg_min(b, (-n) * 100000000000 + b) AS b FROM nb GROUP BY gene),
m AS (SELECT t.*, CASE WHEN strand = '-' THEN mb.b ELSE ma.a END AS nlo, CASE WHEN strand = '-' THEN ma.a ELSE mb.b END AS nhi FROM txs t JOIN ma USING (gene) JOIN mb USING (gene))
SELECT tx, gene, strand, CASE WHEN nlo < nhi THEN nlo ELSE lo END AS lo, CASE WHEN nlo < nhi THEN nhi ELSE hi END AS hi FROM m""")
def modal_ends_applied(s: SparkSession, d: str) -> DataFrame:
    """Every transcript with the commonest start and end of its gene."""
    tx = cut(tx_of(s, d).select("tx", "gene", "chrom", "strand", "lo", "hi"), "transcripts")
    ends = splice.ends(tx).join(tx.select("tx", "gene"), "tx")
    starts, stops = (rd.modal_ends(ends.select("gene", F.col(c).alias("pos")), ("gene",)) for c in ("tss", "tes"))
    return rd.with_modal_ends(tx, starts, stops, "gene").select("tx", "gene", "strand", "lo", "hi")
