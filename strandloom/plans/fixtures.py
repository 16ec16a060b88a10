"""The driver's tables, projected into the transcript domain, for Spark and as SQL text for DuckDB.

Integer arithmetic only, so both engines get the same rows. Genes are blocks of 1,280 bases that never overlap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """exon(tx, gene, chrom, strand, start0, end0), 0-based half-open.

    A transcript's different slots are gathered as bits of one number, so repeated rows end on the map side, one shuffle
    brings a transcript together, and what groups exons by transcript next needs none.
    """
    slot = (F.col("l_partkey") % 12).cast("int")  # -11 to 11, or null
    bit = F.coalesce(slot + 11, F.lit(23))
    held = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("tx"), bit.alias("bit")).groupBy("tx").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    rows = held.select("tx", F.explode(F.filter(F.sequence(F.lit(0), F.lit(23)), lambda k: F.getbit("bits", k) == 1)).alias("bit"))
    gene = F.col("tx") - F.col("tx") % 32
    start = gene * 40 + F.when(F.col("bit") < 23, F.col("bit") - 11).cast("bigint") * 100
    chrom = F.concat(F.lit("chr"), ((gene * 40) % 28160).cast("string"))
    strand = F.when(gene % 64 == 0, "+").otherwise("-")
    return rows.select("tx", gene.alias("gene"), chrom.alias("chrom"), strand.alias("strand"), start.alias("start0"), (start + 60).alias("end0"))


def expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """expr(tx, sample, value): four samples.

    A transcript's sums are columns of one row: they are combined on the map side, and what groups or joins by transcript
    next needs no shuffle.
    """
    sample = F.col("l_suppkey") % 4  # -3 to 3, or null
    slot = F.coalesce(sample + 3, F.lit(7)).cast("int")
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("tx"), slot.alias("slot"), "l_quantity")
    held = rows.groupBy("tx").agg(F.bit_or(F.expr("shiftleft(1L, slot)")).alias("bits"), *(F.sum(F.when(F.col("slot") == k, F.col("l_quantity"))).alias(f"v{k}") for k in range(8)))
    each = F.array(*(F.struct(F.lit(k).alias("slot"), F.col(f"v{k}").alias("v")) for k in range(8)))
    cells = held.select("tx", F.explode(F.filter(each, lambda c: F.getbit(F.col("bits"), c["slot"]) == 1)).alias("c"))
    return cells.select("tx", F.when(F.col("c.slot") < 7, F.col("c.slot") - 3).cast("bigint").alias("sample"), F.col("c.v").cast("bigint").alias("value"))


def regions(spark: SparkSession, sf_dir: str, keep: str = "true") -> DataFrame:
    """region(rid, chrom, start0, end0): stands in for repeats, segmental duplications, reference TSS; ``keep`` selects by p_partkey."""
    at = F.col("p_partkey") * 300
    chrom = F.concat(F.lit("chr"), ((at - at % 1280) % 28160).cast("string"))
    return read(spark, sf_dir, "part").filter(keep).select(F.col("p_partkey").alias("rid"), chrom.alias("chrom"), at.alias("start0"), (at + F.col("p_size") * 4).alias("end0"))


def reference(ex: DataFrame) -> DataFrame:
    """Exons of reference transcripts: every fifth, those of every tenth on the other strand."""
    flip = F.when(F.col("tx") % 10 != 0, F.col("strand")).when(F.col("strand") == "+", "-").otherwise("+")
    return ex.filter("tx % 5 = 0").withColumn("strand", flip)


def genome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """genome(contig, seq): letters of all documents, mapped to bases."""
    seq = F.upper(F.translate(F.regexp_replace(F.lower("text"), "[^a-z]", ""), "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC"))
    return read(spark, sf_dir, "documents").select(F.col("doc_id").alias("contig"), seq.alias("seq"))


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """read(read_id, sample, chrom, flag, pos): events as alignment records; 'error' plays the mitochondrion."""
    flag = F.when(F.col("event_id") % 17 == 0, 4).when(F.col("event_id") % 13 == 0, 256).when(F.col("event_id") % 11 == 0, 2048).otherwise((F.col("event_id") % 2) * 16)
    chrom = F.when(F.col("event_type") == "error", "chrM").otherwise(F.col("event_type"))
    return read(spark, sf_dir, "events").select(F.col("event_id").alias("read_id"), (F.col("user_id") % 4).alias("sample"), chrom.alias("chrom"), flag.cast("int").alias("flag"), (F.col("event_id") * 37 % 100000).alias("pos"))


#: The same projections for DuckDB, as common table expressions.
SQL = {
    "exon": """exon AS (
  SELECT DISTINCT l_orderkey AS tx, l_orderkey - l_orderkey % 32 AS gene,
         concat('chr', CAST(((l_orderkey - l_orderkey % 32) * 40) % 28160 AS VARCHAR)) AS chrom,
         CASE WHEN (l_orderkey - l_orderkey % 32) % 64 = 0 THEN '+' ELSE '-' END AS strand,
         (l_orderkey - l_orderkey % 32) * 40 + (l_partkey % 12) * 100 AS start0,
         (l_orderkey - l_orderkey % 32) * 40 + (l_partkey % 12) * 100 + 60 AS end0
  FROM lineitem)""",
    "expr": "expr AS (SELECT l_orderkey AS tx, l_suppkey % 4 AS sample, CAST(sum(l_quantity) AS BIGINT) AS value FROM lineitem GROUP BY 1, 2)",
    "reg": """reg AS (
  SELECT p_partkey AS rid, concat('chr', CAST((p_partkey*300 - (p_partkey*300) % 1280) % 28160 AS VARCHAR)) AS chrom,
         p_partkey*300 AS start0, p_partkey*300 + p_size*4 AS end0 FROM part)""",
    "ref": "ref AS (SELECT tx, gene, chrom, CASE WHEN tx % 10 <> 0 THEN strand WHEN strand = '+' THEN '-' ELSE '+' END AS strand, start0, end0 FROM exon WHERE tx % 5 = 0)",
    "genome": """genome AS (
  SELECT doc_id AS contig, upper(translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC')) AS seq
  FROM documents)""",
    "reads": """reads AS (
  SELECT event_id AS read_id, user_id % 4 AS sample, CASE WHEN event_type = 'error' THEN 'chrM' ELSE event_type END AS chrom,
         CAST(CASE WHEN event_id % 17 = 0 THEN 4 WHEN event_id % 13 = 0 THEN 256 WHEN event_id % 11 = 0 THEN 2048 ELSE (event_id % 2) * 16 END AS INT) AS flag,
         event_id * 37 % 100000 AS pos FROM events)""",
    # derived relations
    "junc": """ordered AS (SELECT *, lead(start0) OVER (PARTITION BY tx ORDER BY start0, end0) AS nxt FROM exon),
junc AS (SELECT tx, gene, chrom, strand, end0 AS donor, nxt AS acceptor FROM ordered WHERE end0 <= nxt)""",
    "txs": "txs AS (SELECT tx, gene, chrom, strand, count(*) AS n_exons, min(start0) AS lo, max(end0) AS hi FROM exon GROUP BY ALL)",
    "chain": """chain AS (
  SELECT t.tx, t.gene, t.chrom, t.strand, t.lo, t.hi, t.n_exons, count(j.donor) AS n,
         coalesce('|' || string_agg(j.donor || '-' || j.acceptor, '|' ORDER BY j.donor, j.acceptor) || '|', '') AS c
  FROM txs t LEFT JOIN junc j ON t.tx = j.tx GROUP BY ALL)""",
}


def ctes(*names: str) -> str:
    """``WITH`` and the named expressions, in order."""
    return "WITH " + ",\n".join(SQL[n] for n in names)
