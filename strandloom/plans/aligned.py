"""Queries over alignments: binary files written and read, exons and variants from CIGAR and MD, depth, end regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.lineage import cut
from strandloom.operators import alignments, breakpoints, correction, regions, splice
from strandloom.sources import bam, indexed, splittext

from .core import tx_of
from .fixtures import ctes, exons, expression, genome, read
from .fixtures import regions as fixture_regions
from .formats import ORACLES as ORACLES_OF_FORMATS
from .formats import place, put

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


#: Line items as spliced alignments: 3S aM bN cM 2D dM 1I 4M, with one mismatch in the first block and one at the end of d.
_SPLICED = """spliced AS (
  SELECT l_orderkey || '/' || l_linenumber || '/' || l_partkey || '/' || l_suppkey AS read_id, l_suppkey % 2 AS sample, 'chr' || (l_suppkey % 3) AS chrom,
         CASE WHEN l_partkey % 4 = 0 THEN 16 ELSE 0 END AS flag, (l_orderkey % 997) * 3 AS pos, CAST(l_quantity AS INTEGER) AS mapq,
         10 + l_partkey % 20 AS a, 50 + l_suppkey % 50 AS b, 5 + l_linenumber AS c, 8 + l_orderkey % 9 AS d,
         l_partkey % (10 + l_partkey % 20) AS x, substr('TCG', CAST(l_orderkey % 3 + 1 AS INTEGER), 1) AS alt1, substr('TAG', CAST(l_linenumber % 3 + 1 AS INTEGER), 1) AS alt2
  FROM lineitem)"""


def spliced(s: SparkSession, d: str) -> DataFrame:
    """read_id, sample, chrom, flag, pos, mapq, cigar, seq, qual, tags: the same in Spark."""
    key = lambda c: F.col(f"l_{c}")
    size = {"a": 10 + key("partkey") % 20, "b": 50 + key("suppkey") % 50, "c": 5 + key("linenumber"), "d": 8 + key("orderkey") % 9}
    of = lambda x: size[x].cast("string")
    first = key("partkey") % size["a"]
    pick = lambda letters, n: F.substring(F.lit(letters), (n % 3 + 1).cast("int"), F.lit(1))
    fill = lambda n: F.repeat(F.lit("G"), n.cast("int"))
    cigar = F.concat(F.lit("3S"), of("a"), F.lit("M"), of("b"), F.lit("N"), of("c"), F.lit("M2D"), of("d"), F.lit("M1I4M"))
    md = F.concat(first.cast("string"), F.lit("A"), (size["a"] - 1 - first + size["c"]).cast("string"), F.lit("^GT"), (size["d"] - 1).cast("string"), F.lit("C4"))
    seq = F.concat(fill(first + 3), pick("TCG", key("orderkey")), fill(size["a"] - 1 - first + size["c"] + size["d"] - 1), pick("TAG", key("linenumber")), fill(F.lit(5)))
    return read(s, d, "lineitem").select(
        F.concat_ws("/", *(key(c).cast("string") for c in ("orderkey", "linenumber", "partkey", "suppkey"))).alias("read_id"), (key("suppkey") % 2).alias("sample"), F.concat(F.lit("chr"), (key("suppkey") % 3).cast("string")).alias("chrom"), F.when(key("partkey") % 4 == 0, 16).otherwise(0).alias("flag"),
        ((key("orderkey") % 997) * 3).alias("pos"), key("quantity").cast("int").alias("mapq"), cigar.alias("cigar"), seq.alias("seq"), F.repeat(F.lit("I"), F.length(seq)).alias("qual"), F.create_map(F.lit("MD"), md, F.lit("NM"), F.lit("3")).alias("tags"),
    )


def from_bam(s: SparkSession, d: str, columns: list[str]) -> DataFrame:
    """``spliced``, written as binary alignments sorted by place, and read back by splits of 256 kB."""
    path = place(s, "alignments")
    bam.write_bam(spliced(s, d), path, coordinate_sorted=True)
    return bam.read_bam(s, path, columns=columns, split_bytes=1 << 18)


_CIGAR = "'3S' || a || 'M' || b || 'N' || c || 'M2D' || d || 'M1I4M'"
_SEQ = "repeat('G', CAST(x + 3 AS INTEGER)) || alt1 || repeat('G', CAST(a - 1 - x + c + d - 1 AS INTEGER)) || alt2 || 'GGGGG'"
_MD = "x || 'A' || (a - 1 - x + c) || '^GT' || (d - 1) || 'C4'"


@query("bam_read", f"WITH {_SPLICED} SELECT read_id, chrom, flag, pos, mapq, {_CIGAR} AS cigar, {_SEQ} AS seq, repeat('I', CAST(a + c + d + 8 AS INTEGER)) AS qual, {_MD} AS md, '3' AS nm FROM spliced")
def bam_read(s: SparkSession, d: str) -> DataFrame:
    tag = lambda k: F.try_element_at("tags", F.lit(k)).alias(k.lower())
    return from_bam(s, d, ["read_id", "chrom", "flag", "pos", "mapq", "cigar", "seq", "qual", "tags"]).select("read_id", "chrom", "flag", "pos", "mapq", "cigar", "seq", "qual", tag("MD"), tag("NM"))


_BLOCKS = """blk AS (
  SELECT read_id, sample, chrom, flag, pos AS start0, pos + a AS end0, 1 AS k FROM spliced
  UNION ALL SELECT read_id, sample, chrom, flag, pos + a + b, pos + a + b + c, 2 FROM spliced
  UNION ALL SELECT read_id, sample, chrom, flag, pos + a + b + c + 2, pos + a + b + c + d + 6, 3 FROM spliced)"""


@query("bam_exons", f"""WITH {_SPLICED} SELECT read_id AS tx, chrom, CASE WHEN flag = 16 THEN '-' ELSE '+' END AS strand, start0, end0 FROM (
  SELECT read_id, chrom, flag, pos AS start0, pos + a AS end0 FROM spliced UNION ALL SELECT read_id, chrom, flag, pos + a + b, pos + a + b + c + d + 6 FROM spliced)""")
def bam_exons(s: SparkSession, d: str) -> DataFrame:
    """Exon rows of the reads of a binary file."""
    return alignments.read_exons(from_bam(s, d, ["read_id", "chrom", "flag", "pos", "cigar"])).select("tx", "chrom", "strand", "start0", "end0")


@query("bam_chains", f"WITH {_SPLICED} SELECT chrom, CASE WHEN flag = 16 THEN '-' ELSE '+' END AS strand, pos + a AS donor, pos + a + b AS acceptor, count(DISTINCT read_id) AS n FROM spliced GROUP BY ALL")
def bam_chains(s: SparkSession, d: str) -> DataFrame:
    """Junctions of transcripts made from a binary file's reads, with the reads that have them."""
    tx = splice.transcripts(alignments.read_exons(from_bam(s, d, ["read_id", "chrom", "flag", "pos", "cigar"])))
    return splice.junctions(tx).groupBy("chrom", "strand", "donor", "acceptor").agg(F.countDistinct("tx").alias("n"))


_DEPTH = """ev AS (SELECT sample, chrom, p, sum(delta) AS delta FROM (
  SELECT sample, chrom, start0 AS p, 1 AS delta FROM blk UNION ALL SELECT sample, chrom, end0, -1 FROM blk) GROUP BY ALL),
run AS (
  SELECT sample, chrom, p AS start0, lead(p) OVER w AS end0, CAST(sum(delta) OVER w AS BIGINT) AS depth FROM ev WHERE delta <> 0 WINDOW w AS (PARTITION BY sample, chrom ORDER BY p))"""


@query("read_depth", f"WITH {_SPLICED}, {_BLOCKS}, {_DEPTH} SELECT * FROM run WHERE depth > 0")
def read_depth(s: SparkSession, d: str) -> DataFrame:
    """Runs of equal depth, in narrow bins so that runs cross them."""
    return alignments.depth_runs(alignments.aligned_blocks(spliced(s, d)), width=64)


@query("snp_table", f"""WITH {_SPLICED}, {_BLOCKS}, {_DEPTH},
mm AS (SELECT sample, chrom, pos + x AS pos, 'A' AS ref, alt1 AS alt FROM spliced WHERE alt1 <> 'A' UNION ALL SELECT sample, chrom, pos + a + b + c + d + 1, 'C', alt2 FROM spliced WHERE alt2 <> 'C'),
n AS (SELECT *, count(*) AS n FROM mm GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY sample, chrom, pos, ref) AS others, row_number() OVER (PARTITION BY sample, chrom, pos, ref ORDER BY n DESC, alt) AS r FROM n)
SELECT r.sample, r.chrom, pos, ref, alt, depth, CAST(depth - others AS BIGINT) AS reads1, n AS reads2, n / depth AS var_freq
FROM r JOIN run ON run.sample = r.sample AND run.chrom = r.chrom AND pos >= start0 AND pos < end0 WHERE r = 1 AND n >= 4 AND depth >= 20""")
def snp_table(s: SparkSession, d: str) -> DataFrame:
    return alignments.snp_table(spliced(s, d).withColumn("md", F.try_element_at("tags", F.lit("MD"))), width=64)


_POINTS = """pt AS (SELECT t.tx, chrom, strand, CASE WHEN strand = '-' THEN hi + t.tx % 7 ELSE lo + t.tx % 7 END AS pos, sample, value AS n FROM txs t JOIN expr USING (tx)),
p1 AS (SELECT chrom, strand, pos, sum(n) AS n FROM pt GROUP BY ALL),
fl AS (SELECT *, CASE WHEN pos - lag(pos) OVER w <= 50 THEN 0 ELSE 1 END AS f FROM p1 WINDOW w AS (PARTITION BY chrom, strand ORDER BY pos)),
isl AS (SELECT *, sum(f) OVER (PARTITION BY chrom, strand ORDER BY pos) AS g FROM fl),
reg AS (SELECT chrom, strand, g, min(pos) AS start0, max(pos) + 1 AS end0, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_pos, arg_min(pos, (-n) * 100000000000 + pos) AS mode FROM isl GROUP BY chrom, strand, g)"""


def _starts(s: SparkSession, d: str) -> DataFrame:
    """Transcription starts with their counts by sample, scattered over seven bases."""
    starts = splice.ends(tx_of(s, d)).select("tx", "chrom", "strand", (F.col("tss") + F.col("tx") % 7).alias("pos"))
    return cut(starts.join(expression(s, d), "tx").select("chrom", "strand", "sample", "pos", F.col("value").alias("n")), "starts")


@query("end_regions", ctes("exon", "txs", "expr") + f", {_POINTS} SELECT chrom, strand, start0, end0, n, n_pos, mode FROM reg WHERE n >= 20")
def end_regions(s: SparkSession, d: str) -> DataFrame:
    """Start regions with at least 20 reads, in bins so narrow that regions cross them."""
    return regions.end_regions(_starts(s, d), min_reads=20, width=128)[0]


@query("end_region_counts", ctes("exon", "txs", "expr") + f", {_POINTS} SELECT r.chrom, r.strand, start0, sample, CAST(sum(pt.n) AS BIGINT) AS n FROM reg r JOIN pt ON pt.chrom = r.chrom AND pt.strand = r.strand AND pt.pos >= start0 AND pt.pos < end0 WHERE r.n >= 20 GROUP BY ALL")
def end_region_counts(s: SparkSession, d: str) -> DataFrame:
    return regions.end_regions(_starts(s, d), min_reads=20, width=128)[1]


@query("region_mode_ends", ctes("exon", "txs", "expr") + f""", {_POINTS},
en AS (SELECT tx, chrom, strand, lo, hi, CASE WHEN strand = '-' THEN hi ELSE lo END AS p FROM txs),
mv AS (SELECT en.*, r.mode AS m FROM en LEFT JOIN reg r ON r.chrom = en.chrom AND r.strand = en.strand AND p >= start0 AND p < end0),
nw AS (SELECT tx, chrom, strand, lo, hi, CASE WHEN strand = '-' THEN lo ELSE coalesce(m, p) END AS nlo, CASE WHEN strand = '-' THEN coalesce(m, p) ELSE hi END AS nhi FROM mv)
SELECT tx, chrom, strand, CASE WHEN nlo < nhi THEN nlo ELSE lo END AS lo, CASE WHEN nlo < nhi THEN nhi ELSE hi END AS hi FROM nw""")
def region_mode_ends(s: SparkSession, d: str) -> DataFrame:
    """Transcripts whose start moves to the mode of its region; ends stay, as no region of ends is given."""
    starts = regions.end_regions(_starts(s, d))[0]
    tx = tx_of(s, d).select("tx", "chrom", "strand", "lo", "hi")
    return regions.with_region_modes(tx, starts, starts.limit(0))


@query("region_scan", ctes("exon", "reg") + " SELECT DISTINCT e.tx, e.chrom, e.start0, e.end0 FROM exon e JOIN reg r ON r.chrom = e.chrom AND r.start0 < e.end0 AND e.start0 < r.end0")
def region_scan(s: SparkSession, d: str) -> DataFrame:
    """Exons on any region, from a sorted store by its index."""
    path = place(s, "store")
    indexed.write_indexed(exons(s, d), path, files=16)
    return indexed.scan_regions(s, path, fixture_regions(s, d)).select("tx", "chrom", "start0", "end0")


#: Known junctions: those of the exons, each with a motif class; reads' exons are a few bases shorter or longer.
_JITTER = """known AS (SELECT chrom, strand, donor, acceptor, max(tx % 3) AS motif, CAST(sum(tx % 9) AS BIGINT) AS support FROM junc GROUP BY ALL),
own AS (SELECT tx, chrom, strand, row_number() OVER (PARTITION BY tx ORDER BY donor, acceptor) AS junction, donor - (tx + donor) % 5 AS donor, acceptor + (tx + acceptor) % 9 AS acceptor FROM junc),
best AS (
  SELECT o.*, k.donor AS new_donor, k.acceptor AS new_acceptor, abs(o.donor - k.donor) + abs(o.acceptor - k.acceptor) AS "offset",
         row_number() OVER (PARTITION BY o.tx, o.junction ORDER BY abs(o.donor - k.donor) + abs(o.acceptor - k.acceptor), support DESC, k.donor, k.acceptor) AS r
  FROM own o JOIN known k ON k.chrom = o.chrom AND k.strand = o.strand AND abs(o.donor - k.donor) <= 5 AND abs(o.acceptor - k.acceptor) <= 5 AND motif > 0
  WHERE NOT EXISTS (SELECT 1 FROM known x WHERE x.chrom = o.chrom AND x.strand = o.strand AND x.donor = o.donor AND x.acceptor = o.acceptor))"""


def _jittered(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    j = cut(splice.junctions(tx_of(s, d)), "junctions")
    known = j.select("chrom", "strand", "donor", "acceptor", (F.col("tx") % 3).alias("motif"), (F.col("tx") % 9).alias("unique_reads"))
    own = j.select("tx", "chrom", "strand", "junction", (F.col("donor") - (F.col("tx") + F.col("donor")) % 5).alias("donor"), (F.col("acceptor") + (F.col("tx") + F.col("acceptor")) % 9).alias("acceptor"))
    return own, known


@query("junctions_moved", ctes("exon", "junc") + f", {_JITTER} SELECT tx, chrom, strand, junction, donor, acceptor, new_donor, new_acceptor, \"offset\" FROM best WHERE r = 1")
def junctions_moved(s: SparkSession, d: str) -> DataFrame:
    """Reads' junctions, some bases off, moved to known ones."""
    return correction.correction_log(*_jittered(s, d))


@query("chains_corrected", ctes("exon", "txs", "junc") + f""", {_JITTER},
final AS (SELECT o.tx, o.junction, o.donor, o.acceptor, coalesce(new_donor, o.donor) AS nd, coalesce(new_acceptor, o.acceptor) AS na, new_donor IS NOT NULL AS moved FROM own o LEFT JOIN best b ON b.tx = o.tx AND b.junction = o.junction AND b.r = 1),
ok AS (SELECT t.tx, bool_and(coalesce(nd > prev, true)) AND bool_and(nd <= na) AND max(na) < any_value(hi) AS ok, count(*) FILTER (moved) AS n_moved
       FROM (SELECT *, lag(na) OVER (PARTITION BY tx ORDER BY junction) AS prev FROM final) f JOIN txs t USING (tx) GROUP BY t.tx, lo HAVING min(nd) > lo OR true),
low AS (SELECT f.tx, min(nd) > any_value(lo) AS above FROM final f JOIN txs USING (tx) GROUP BY f.tx)
SELECT f.tx, f.junction, CASE WHEN ok AND above AND n_moved > 0 THEN nd ELSE f.donor END AS donor, CASE WHEN ok AND above AND n_moved > 0 THEN na ELSE f.acceptor END AS acceptor, CAST(n_moved AS INTEGER) AS n_moved, ok AND above AND n_moved > 0 AS corrected
FROM final f JOIN ok USING (tx) JOIN low USING (tx)""")
def chains_corrected(s: SparkSession, d: str) -> DataFrame:
    """Whole transcripts of the same, junction by junction."""
    own, known = _jittered(s, d)
    chains = own.groupBy("tx", "chrom", "strand").agg(F.array_sort(F.collect_list(F.struct("donor", "acceptor"))).alias("chain"))
    tx = chains.join(tx_of(s, d).select(F.col("tx").alias("t"), "gene", "exons", "lo", "hi"), F.col("tx") == F.col("t")).drop("t")
    out = correction.correct_junctions(tx, known)
    return out.select("tx", F.posexplode("chain").alias("k", "j"), "n_moved", "corrected").select("tx", (F.col("k") + 1).alias("junction"), "j.donor", "j.acceptor", "n_moved", "corrected")


#: Orders as breakpoints: a customer's orders lie scattered about two places.
_BREAKS = """brk AS (
  SELECT 'r' || o_orderkey AS read_id, o_orderkey % 4 AS sample, 'chr' || (o_custkey % 3) AS chrom_a, CASE WHEN o_custkey % 2 = 0 THEN '+' ELSE '-' END AS strand_a,
         'chr' || (o_custkey % 5) AS chrom_b, '+' AS strand_b, o_custkey * 1000 + o_orderkey % 190 AS pos_a, o_custkey * 700 + (o_orderkey * 13) % 210 AS pos_b
  FROM orders),
spot AS (SELECT DISTINCT chrom_a, strand_a, chrom_b, strand_b, pos_a, pos_b FROM brk),
lk AS (SELECT a AS spot, b AS other FROM spot a JOIN spot b ON a.chrom_a = b.chrom_a AND a.strand_a = b.strand_a AND a.chrom_b = b.chrom_b AND a.strand_b = b.strand_b AND b.pos_a BETWEEN a.pos_a - 40 AND a.pos_a + 40 AND b.pos_b BETWEEN a.pos_b - 40 AND a.pos_b + 40),
walk AS (SELECT spot AS node, spot AS root FROM lk UNION SELECT lk.other, w.root FROM walk w JOIN lk ON lk.spot = w.node),
grp AS (SELECT node, min(root) AS root FROM walk GROUP BY node)"""


def _breaks(s: SparkSession, d: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    chrom = lambda n: F.concat(F.lit("chr"), (cust % n).cast("string"))
    return read(s, d, "orders").select(F.concat(F.lit("r"), key.cast("string")).alias("read_id"), (key % 4).alias("sample"), chrom(3).alias("chrom_a"), F.when(cust % 2 == 0, "+").otherwise("-").alias("strand_a"), chrom(5).alias("chrom_b"), F.lit("+").alias("strand_b"), (cust * 1000 + key % 190).alias("pos_a"), (cust * 700 + (key * 13) % 210).alias("pos_b"), (key % 30).cast("int").alias("mapq"), (1 - (key % 10) / 100).alias("identity"))


@query("breakpoint_groups", f"""WITH RECURSIVE {_BREAKS},
mem AS (SELECT b.*, g.root FROM brk b JOIN grp g ON g.node.chrom_a = b.chrom_a AND g.node.strand_a = b.strand_a AND g.node.chrom_b = b.chrom_b AND g.node.strand_b = b.strand_b AND g.node.pos_a = b.pos_a AND g.node.pos_b = b.pos_b),
cnt AS (SELECT root, pos_a, pos_b, row_number() OVER (PARTITION BY root ORDER BY count(*) DESC, pos_a, pos_b) AS r FROM mem GROUP BY root, pos_a, pos_b)
SELECT m.chrom_a, m.strand_a, m.chrom_b, m.strand_b, count(DISTINCT read_id) AS n_reads, count(DISTINCT sample) AS n_samples, c.pos_a, c.pos_b, round(avg((abs(m.pos_a - c.pos_a) + abs(m.pos_b - c.pos_b)) / 2), 6) AS variability
FROM mem m JOIN cnt c ON c.root = m.root AND c.r = 1 GROUP BY m.root, m.chrom_a, m.strand_a, m.chrom_b, m.strand_b, c.pos_a, c.pos_b""")
def breakpoint_groups(s: SparkSession, d: str) -> DataFrame:
    found, _ = breakpoints.groups(_breaks(s, d), max_distance=40)
    return found.select("chrom_a", "strand_a", "chrom_b", "strand_b", "n_reads", "n_samples", "pos_a", "pos_b", F.round("variability", 6).alias("variability"))


_SPLIT = """sp AS (
  SELECT l_orderkey || '/' || l_linenumber || '/' || l_partkey || '/' || l_suppkey AS read_id, l_suppkey % 2 AS sample, l_partkey % 2 = 0 AS rev, l_orderkey * 10 AS p, 20 + l_linenumber AS n, l_partkey * 20 AS q, 15 + l_suppkey % 9 AS m
  FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem))"""


@query("read_breakpoints", f"""WITH {_SPLIT} SELECT read_id, sample, 'c1' AS chrom_a, CASE WHEN rev THEN '-' ELSE '+' END AS strand_a, 'c2' AS chrom_b, '+' AS strand_b,
  CASE WHEN rev THEN p ELSE p + n + 100 + 9 END AS pos_a, q AS pos_b FROM sp""")
def read_breakpoints(s: SparkSession, d: str) -> DataFrame:
    """Breakpoints between a read's spliced first part and its second, which the SA tag tells of."""
    key = [F.col(f"l_{c}") for c in ("orderkey", "linenumber", "partkey", "suppkey")]
    items = read(s, d, "lineitem").select(*key).distinct()
    rev, n, m = key[2] % 2 == 0, 20 + key[1], 15 + key[3] % 9
    text = lambda *x: F.concat(*((F.lit(c) if isinstance(c, str) else c.cast("string")) for c in x))
    cigar = F.when(rev, text(m, "S", n, "M100N10M")).otherwise(text(n, "M100N10M", m, "S"))
    sa = text("c2,", key[2] * 20 + 1, ",+,", n + 10, "S", m, "M,60,0;")
    rows = items.select(F.concat_ws("/", *(k.cast("string") for k in key)).alias("read_id"), (key[3] % 2).alias("sample"), F.lit("c1").alias("chrom"), F.when(rev, 16).otherwise(0).alias("flag"), (key[0] * 10).alias("pos"), cigar.alias("cigar"), F.lit(60).alias("mapq"), sa.alias("sa"), F.lit(0).alias("nm"))
    return breakpoints.breakpoints(breakpoints.segments(rows)).select("read_id", "sample", "chrom_a", "strand_a", "chrom_b", "strand_b", "pos_a", "pos_b")


@query("fastq_by_split", ORACLES_OF_FORMATS["fastq_read"])
def fastq_by_split(s: SparkSession, d: str) -> DataFrame:
    """Reads from the genome's contigs, from plain files by splits of 64 kB."""
    qual = F.translate(F.col("seq"), "ACGT", "5?I@")  # qualities may look like a name's line
    rows = genome(s, d).filter("seq <> ''").select(F.concat(F.lit("@c"), F.col("contig").cast("string"), F.lit(" part\n"), F.col("seq"), F.lit("\n+\n"), qual).alias("value"))
    md5 = lambda c: F.md5(c.cast("binary"))
    found = splittext.read_fastq_splits(s, put(s, rows, "reads-fastq"), 1 << 16)
    return found.select("read_id", md5(F.col("seq")).alias("seq"), md5(F.translate("qual", "@", "+")).alias("qual"))


def _fasta(s: SparkSession, d: str) -> str:
    folded = F.regexp_replace("seq", "(.{70})", "$1\n")
    return put(s, genome(s, d).select(F.concat(F.lit(">"), F.col("contig").cast("string"), F.lit(" from A->G\n"), folded).alias("value")), "genome-fa")


@query("fasta_by_split", ctes("genome") + """ SELECT CAST(contig AS VARCHAR) AS contig, chunk, chunk * 1000 AS start0, md5(substr(seq, CAST(chunk * 1000 + 1 AS BIGINT), 1064)) AS seq
FROM (SELECT contig, seq, CAST(unnest(range(0, greatest((length(seq) + 999) // 1000, 1))) AS INTEGER) AS chunk FROM genome)""")
def fasta_by_split(s: SparkSession, d: str) -> DataFrame:
    """Contigs in chunks of 1,000 bases, from splits of 32 kB that cut contigs anywhere."""
    return splittext.read_fasta_chunks(s, _fasta(s, d), 1000, 64, 1 << 15).select("contig", "chunk", "start0", F.md5(F.col("seq").cast("binary")).alias("seq"))


@query("fasta_lengths", ctes("genome") + " SELECT CAST(contig AS VARCHAR) AS chrom, CAST(length(seq) AS BIGINT) AS length FROM genome")
def fasta_lengths(s: SparkSession, d: str) -> DataFrame:
    return splittext.fasta_lengths(s, _fasta(s, d), 1 << 15)


@query("bam_to_fastq", f"""WITH {_SPLICED}, f AS (SELECT read_id, flag, {_SEQ} AS seq FROM spliced)
SELECT read_id, CASE WHEN flag = 16 THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END AS seq, repeat('I', length(seq)) AS qual FROM f""")
def bam_to_fastq(s: SparkSession, d: str) -> DataFrame:
    """A binary file's reads as compressed text, read back."""
    path = place(s, "from-bam-fastq")
    bam.write_fastq(bam.to_fastq(from_bam(s, d, ["read_id", "flag", "seq", "qual"])), path)
    return splittext.read_fastq_splits(s, path)


@query("bam_region", f"WITH {_SPLICED} SELECT read_id, chrom, pos, {_CIGAR} AS cigar FROM spliced WHERE chrom = 'chr1' AND pos < 1200 AND pos + a + b + c + d + 6 > 900")
def bam_region(s: SparkSession, d: str) -> DataFrame:
    """Reads on a stretch of a chromosome, from sorted files by their index."""
    path = place(s, "indexed-alignments")
    bam.write_bam(spliced(s, d), path, coordinate_sorted=True)
    bam.index_bam(s, path, window=256)
    return bam.read_bam_region(s, path, "chr1", 900, 1200, ["read_id", "chrom", "pos", "cigar"])
