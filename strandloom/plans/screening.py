"""Queries over screens, intervals, sequences and reads, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.lineage import cut
from strandloom.operators import annotation, reads, reports, screens, splice
from strandloom.operators.intervals import interval_join, subtract_intervals, union_intervals
from strandloom.operators.numbering import number_by_range

from .core import tx_of
from .fixtures import ctes, exons, expression, genome, read, reference, regions
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


# --- intervals


@query("interval_overlap_bp", ctes("exon", "reg") + " SELECT e.tx, e.start0, r.rid, least(e.end0, r.end0) - greatest(e.start0, r.start0) AS bp FROM exon e JOIN reg r ON e.chrom = r.chrom AND e.start0 < r.end0 AND r.start0 < e.end0")
def interval_overlap_bp(s: SparkSession, d: str) -> DataFrame:
    hits = interval_join(exons(s, d), regions(s, d), width=1024)
    return hits.select(F.col("a_tx").alias("tx"), F.col("a_start0").alias("start0"), F.col("b_rid").alias("rid"), (F.least("a_end0", "b_end0") - F.greatest("a_start0", "b_start0")).alias("bp"))


# Islands: a running maximum of the ends before starts a new one.
_UNION = """isl AS (SELECT chrom, start0, end0, CASE WHEN start0 <= max(end0) OVER (PARTITION BY chrom ORDER BY start0, end0 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM {0}),
isg AS (SELECT *, sum(new) OVER (PARTITION BY chrom ORDER BY start0, end0 ROWS UNBOUNDED PRECEDING) AS g FROM isl),
uni AS (SELECT chrom, min(start0) AS start0, max(end0) AS end0 FROM isg GROUP BY chrom, g)"""


@query("interval_union", ctes("reg") + f", {_UNION.format('reg')} SELECT * FROM uni")
def interval_union(s: SparkSession, d: str) -> DataFrame:
    return union_intervals(regions(s, d))


@query("interval_subtract", ctes("exon", "reg") + f""", {_UNION.format('reg')}, pt AS (SELECT DISTINCT e.tx, e.chrom, e.start0, e.end0, p FROM exon e JOIN uni u ON e.chrom = u.chrom AND e.start0 < u.end0 AND u.start0 < e.end0, LATERAL (SELECT unnest([e.start0, e.end0, greatest(u.start0, e.start0), least(u.end0, e.end0)]) AS p)),
seg AS (SELECT tx, chrom, start0 AS es, end0 AS ee, p AS s, lead(p) OVER (PARTITION BY tx, start0, end0 ORDER BY p) AS e FROM pt)
SELECT tx, chrom, s AS start0, e AS end0 FROM seg WHERE e IS NOT NULL AND NOT EXISTS (SELECT 1 FROM uni u WHERE u.chrom = seg.chrom AND u.start0 <= seg.s AND u.end0 >= seg.e)
UNION ALL SELECT tx, chrom, start0, end0 FROM exon e WHERE NOT EXISTS (SELECT 1 FROM uni u WHERE u.chrom = e.chrom AND e.start0 < u.end0 AND u.start0 < e.end0)""")
def interval_subtract(s: SparkSession, d: str) -> DataFrame:
    out = subtract_intervals(exons(s, d).select("tx", "chrom", "start0", "end0"), regions(s, d).select("chrom", "start0", "end0"), ("tx", "chrom"), width=1024)
    return out.select("tx", "chrom", "start0", "end0")


@query("coord_sort", ctes("exon") + " SELECT tx, chrom, start0, row_number() OVER (PARTITION BY chrom ORDER BY start0, tx) AS rank FROM exon")
def coord_sort(s: SparkSession, d: str) -> DataFrame:
    """Coordinate order, as ranks by contig; ranked within stretches of a contig."""
    rows = number_by_range(exons(s, d).select("tx", "chrom", "start0"), ["chrom"], F.floor(F.col("start0") / 65536), ["start0", "tx"], "rank")
    return rows.select("tx", "chrom", "start0", (F.col("rank") + 1).alias("rank"))


@query("chrom_sizes", ctes("genome") + " SELECT contig, length(seq) AS length FROM genome")
def chrom_sizes(s: SparkSession, d: str) -> DataFrame:
    return genome(s, d).select("contig", F.length("seq").cast("bigint").alias("length"))


# --- screens

_TSS = "tssrow AS (SELECT tx, chrom, CASE WHEN strand = '-' THEN hi ELSE lo END AS start0 FROM txs), mono AS (SELECT tx FROM txs WHERE n_exons = 1)"


def _reference_tss(s: SparkSession, d: str) -> DataFrame:
    return regions(s, d).withColumn("end0", F.col("start0") + 1)


@query("monoexon_no_tss", ctes("exon", "txs", "reg") + f", {_TSS} SELECT DISTINCT t.tx FROM tssrow t WHERE tx IN (FROM mono) AND NOT EXISTS (SELECT 1 FROM reg r WHERE r.chrom = t.chrom AND greatest(t.start0 - 100, 0) < r.start0 + 1 AND r.start0 < t.start0 + 101)")
def monoexon_no_tss(s: SparkSession, d: str) -> DataFrame:
    tx = tx_of(s, d)
    tss = splice.ends(tx).select("tx", "chrom", F.col("tss").alias("start0"), (F.col("tss") + 1).alias("end0"))
    return screens.monoexon_no_tss(tx, tss, _reference_tss(s, d), distance=100)


_SIZES = "sz AS (SELECT chrom, max(end0) - 150 AS length FROM reg GROUP BY chrom)"


@query("monoexon_no_tss_clipped", ctes("exon", "txs", "reg") + f""", {_TSS}, {_SIZES} SELECT DISTINCT t.tx FROM tssrow t JOIN sz ON sz.chrom = t.chrom WHERE tx IN (FROM mono)
 AND NOT EXISTS (SELECT 1 FROM reg r WHERE r.chrom = t.chrom AND greatest(t.start0 - 300, 0) < r.start0 + 1 AND r.start0 < least(t.start0 + 301, sz.length) AND greatest(t.start0 - 300, 0) < least(t.start0 + 301, sz.length))""")
def monoexon_no_tss_clipped(s: SparkSession, d: str) -> DataFrame:
    """Windows clipped to the chromosomes' lengths, which here end inside the last region."""
    tx = tx_of(s, d)
    tss = splice.ends(tx).select("tx", "chrom", F.col("tss").alias("start0"), (F.col("tss") + 1).alias("end0"))
    sizes = regions(s, d).groupBy("chrom").agg((F.max("end0") - 150).alias("length"))
    return screens.monoexon_no_tss(tx, tss, _reference_tss(s, d), sizes, distance=300)


_REF = """rtx AS (SELECT tx, chrom, strand, count(*) AS n, min(start0) AS lo, max(end0) AS hi FROM ref GROUP BY ALL),
rin AS (SELECT * FROM (SELECT tx, chrom, strand, end0 AS s, lead(start0) OVER (PARTITION BY tx ORDER BY start0) AS e FROM ref) WHERE e > s)"""


@query("premrna_monoexon", ctes("exon", "txs", "ref") + f""", {_REF}, m AS (SELECT * FROM txs WHERE n_exons = 1 AND tx % 5 <> 0)
SELECT tx FROM m WHERE EXISTS (SELECT 1 FROM rtx r WHERE r.chrom = m.chrom AND r.strand = m.strand AND r.lo < m.hi AND m.lo < r.hi)
 AND EXISTS (SELECT 1 FROM rin i WHERE i.chrom = m.chrom AND i.strand = m.strand AND least(i.e, m.hi) - greatest(i.s, m.lo) >= 10)
 AND NOT EXISTS (SELECT 1 FROM rtx r WHERE r.n = 1 AND r.chrom = m.chrom AND r.strand = m.strand AND r.lo < m.hi AND m.lo < r.hi)""")
def premrna_monoexon(s: SparkSession, d: str) -> DataFrame:
    ex_ = exons(s, d)
    return screens.premrna_monoexon(splice.transcripts(ex_).filter("tx % 5 <> 0"), splice.transcripts(reference(ex_)))


def _local_junctions(s: SparkSession, d: str) -> DataFrame:
    """Junctions in coordinates of their gene's contig: the genes are dealt over all documents."""
    j = splice.junctions(tx_of(s, d))
    at, n = F.col("gene") * 40, read(s, d, "documents").count()
    return j.select("tx", "gene", "chrom", "strand", "junction", F.expr(f"gene div 32 % {max(n, 1)}L").alias("contig"), (F.col("donor") - at).alias("donor"), (F.col("acceptor") - at).alias("acceptor"))


_LOCAL = "loc AS (SELECT tx, gene, chrom, strand, row_number() OVER (PARTITION BY tx ORDER BY donor) AS junction, (gene // 32) % (SELECT count(*) FROM documents) AS contig, donor - gene * 40 AS donor, acceptor - gene * 40 AS acceptor FROM junc)"
_MOTIF = """mot0 AS (SELECT l.*, CASE WHEN g.seq IS NULL THEN NULL ELSE substr(seq, donor + 1, 2) || substr(seq, acceptor - 1, 2) END AS f FROM loc l LEFT JOIN genome g ON g.contig = l.contig),
mot AS (SELECT tx, junction, coalesce(CASE WHEN strand = '-' THEN reverse(translate(f, 'ACGT', 'TGCA')) ELSE f END, 'NNNN') AS motif FROM mot0)"""


@query("splice_motif", ctes("exon", "junc", "genome") + f", {_LOCAL}, {_MOTIF} SELECT tx, junction, motif FROM mot")
def splice_motif(s: SparkSession, d: str) -> DataFrame:
    return screens.motifs(_local_junctions(s, d), genome(s, d)).select("tx", "junction", "motif")


@query("noncanonical_splice", ctes("exon", "junc", "genome") + f", {_LOCAL}, {_MOTIF} SELECT tx, string_agg(DISTINCT motif, ',' ORDER BY motif) AS motifs FROM mot WHERE motif NOT IN ('GTAG', 'GCAG', 'ATAC') GROUP BY tx")
def noncanonical_splice(s: SparkSession, d: str) -> DataFrame:
    return screens.noncanonical_splice(_local_junctions(s, d), genome(s, d))


def _slice(start: str) -> str:
    return f"CASE WHEN {start} < 0 THEN '' ELSE substr(seq, {start} + 1, 12) END"


_WIN = f"""win AS (SELECT l.*, CASE WHEN strand = '+' THEN {_slice('donor - 12')} ELSE reverse(translate({_slice('acceptor - 1')}, 'ACGT', 'TGCA')) END AS seq_exon,
  CASE WHEN strand = '+' THEN {_slice('acceptor - 11')} ELSE reverse(translate({_slice('donor - 2')}, 'ACGT', 'TGCA')) END AS seq_intron FROM loc l JOIN genome g ON g.contig = l.contig)"""


@query("rt_windows", ctes("exon", "junc", "genome") + f", {_LOCAL}, {_WIN} SELECT tx, junction, seq_exon, seq_intron FROM win")
def rt_windows(s: SparkSession, d: str) -> DataFrame:
    return screens.rt_windows(_local_junctions(s, d), genome(s, d)).select("tx", "junction", "seq_exon", "seq_intron")


@query("rt_switching", ctes("exon", "junc", "genome") + f""", {_LOCAL}, {_WIN},
hit AS (SELECT w.*, i, instr(seq_intron, substr(seq_exon, i + 1, 5)) - 1 AS j, row_number() OVER (PARTITION BY tx, junction ORDER BY i) AS k
  FROM win w, (SELECT unnest(range(0, 12)) AS i) WHERE i + 5 <= length(seq_exon) AND length(seq_intron) >= 5 AND instr(seq_intron, substr(seq_exon, i + 1, 5)) > 0)
SELECT tx, junction, chrom, strand, donor, acceptor, 5 AS match_len, substr(seq_exon, i + 1, 5) AS match_pat, 0 AS mismatch FROM hit WHERE k = 1 AND i + 5 <= length(seq_exon) - 1 AND j + 5 <= length(seq_exon) - 1""")
def rt_switching(s: SparkSession, d: str) -> DataFrame:
    """Five bases: long matches are rare in the fixture's sequences."""
    return screens.rt_switching(screens.rt_windows(_local_junctions(s, d), genome(s, d)), 5)


_MM = """sd AS (SELECT w.*, i, j, least(length(seq_exon) - i, length(seq_intron) - j) AS most FROM win w, (SELECT unnest(range(0, 9)) AS i), (SELECT unnest(range(0, 9)) AS j)
  WHERE i <= length(seq_exon) - 4 AND j <= length(seq_intron) - 4 AND substr(seq_exon, i + 1, 4) = substr(seq_intron, j + 1, 4)),
rn AS (SELECT *, coalesce(list_min(list_filter(range(0, most), lambda t: substr(seq_exon, i + t + 1, 1) <> substr(seq_intron, j + t + 1, 1))), most) AS k FROM sd),
df AS (SELECT *, 8 - k AS m, len(list_filter(range(0, 8 - k), lambda t: substr(seq_exon, i + k + t + 1, 1) <> substr(seq_intron, j + k + t + 1, 1))) AS r,
  len(list_filter(range(0, 8 - k), lambda t: substr(seq_exon, i - (8 - k) + t + 1, 1) <> substr(seq_intron, j - (8 - k) + t + 1, 1))) AS l FROM rn),
ht AS (SELECT *, CASE WHEN i + 8 <= length(seq_exon) AND j + 8 <= length(seq_intron) AND r <= 1 THEN 0 WHEN i - m >= 0 AND j - m >= 0 AND l <= 1 THEN m END AS back, CASE WHEN i + 8 <= length(seq_exon) AND j + 8 <= length(seq_intron) AND r <= 1 THEN r ELSE l END AS mismatch FROM df),
ft AS (SELECT *, row_number() OVER (PARTITION BY tx, junction ORDER BY i, j) AS o FROM ht WHERE back IS NOT NULL)"""


@query("rt_switching_mm", ctes("exon", "junc", "genome") + f", {_LOCAL}, {_WIN}, {_MM} SELECT tx, junction, chrom, strand, donor, acceptor, 8 AS match_len, substr(seq_exon, i - back + 1, 8) AS match_pat, CAST(mismatch AS INTEGER) AS mismatch FROM ft WHERE o = 1 AND i - back + 8 <= length(seq_exon) - 1 AND j - back + 8 <= length(seq_exon) - 1")
def rt_switching_mm(s: SparkSession, d: str) -> DataFrame:
    """One mismatch allowed."""
    return screens.rt_switching_mismatch(screens.rt_windows(_local_junctions(s, d), genome(s, d)), 8)


@query("antisense_compat", ctes("exon", "junc") + " SELECT DISTINCT a.tx FROM junc a JOIN junc b ON a.chrom = b.chrom AND a.donor = b.donor AND a.acceptor = b.acceptor WHERE a.tx % 5 <> 0 AND b.tx % 15 = 0")
def antisense_compat(s: SparkSession, d: str) -> DataFrame:
    """Every third reference name occurs on both strands; only its later rows count."""
    ref = splice.transcripts(reference(exons(s, d))).withColumn("ord", F.col("tx"))
    other = F.when(F.col("strand") == "+", "-").otherwise("+")
    both = ref.unionByName(ref.filter("tx % 15 = 0").withColumns({"strand": other, "ord": F.col("ord") + 1_000_000_000}))
    return screens.antisense(tx_of(s, d).filter("tx % 5 <> 0"), both, "compat")


@query("antisense_intended", ctes("exon", "junc") + " SELECT DISTINCT a.tx FROM junc a JOIN junc b ON a.chrom = b.chrom AND a.donor = b.donor AND a.acceptor = b.acceptor WHERE a.tx % 5 <> 0 AND b.tx % 5 = 0 AND a.strand <> CASE WHEN b.tx % 10 <> 0 THEN b.strand WHEN b.strand = '+' THEN '-' ELSE '+' END")
def antisense_intended(s: SparkSession, d: str) -> DataFrame:
    ref = splice.transcripts(reference(exons(s, d))).withColumn("ord", F.col("tx"))
    return screens.antisense(tx_of(s, d).filter("tx % 5 <> 0"), ref, "intended")


_COVER = """tot AS (SELECT tx, CAST(sum(end0 - start0) AS BIGINT) AS total_exon_bp FROM exon GROUP BY tx),
cov AS (SELECT e.tx, CAST(sum(least(e.end0, u.end0) - greatest(e.start0, u.start0)) AS BIGINT) AS bp FROM exon e JOIN uni u ON e.chrom = u.chrom AND e.start0 < u.end0 AND u.start0 < e.end0 GROUP BY e.tx),
ovl AS (SELECT t.tx, total_exon_bp, coalesce(bp, 0) AS overlap_bp FROM tot t LEFT JOIN cov c ON c.tx = t.tx)"""


@query("exon_overlap_stats", ctes("exon", "reg") + f", {_UNION.format('reg')}, {_COVER} SELECT tx, total_exon_bp, overlap_bp, round(overlap_bp / total_exon_bp, 4) AS overlap_fraction FROM ovl")
def exon_overlap_stats(s: SparkSession, d: str) -> DataFrame:
    return screens.exon_overlap(exons(s, d), regions(s, d))


_STRANDED = """rs AS (SELECT chrom, CASE WHEN rid % 2 = 0 THEN '+' ELSE '-' END AS strand, start0, end0 FROM reg),
isl AS (SELECT *, CASE WHEN start0 <= max(end0) OVER (PARTITION BY chrom, strand ORDER BY start0, end0 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM rs),
isg AS (SELECT *, sum(new) OVER (PARTITION BY chrom, strand ORDER BY start0, end0 ROWS UNBOUNDED PRECEDING) AS g FROM isl),
uni AS (SELECT chrom, strand, min(start0) AS start0, max(end0) AS end0 FROM isg GROUP BY chrom, strand, g),
tot AS (SELECT tx, CAST(sum(end0 - start0) AS BIGINT) AS total_exon_bp FROM exon GROUP BY tx),
cov AS (SELECT e.tx, CAST(sum(least(e.end0, u.end0) - greatest(e.start0, u.start0)) AS BIGINT) AS bp FROM exon e JOIN uni u ON e.chrom = u.chrom AND e.strand = u.strand AND e.start0 < u.end0 AND u.start0 < e.end0 GROUP BY e.tx)"""


@query("stranded_overlap", ctes("exon", "reg") + f", {_STRANDED} SELECT t.tx, total_exon_bp, coalesce(bp, 0) AS overlap_bp, round(coalesce(bp, 0) / total_exon_bp, 4) AS overlap_fraction FROM tot t LEFT JOIN cov c ON c.tx = t.tx")
def stranded_overlap(s: SparkSession, d: str) -> DataFrame:
    """Regions with a strand of their own."""
    stranded = regions(s, d).withColumn("strand", F.when(F.col("rid") % 2 == 0, "+").otherwise("-"))
    return screens.exon_overlap(exons(s, d), stranded, stranded=True)


@query("repeat_overlap", ctes("exon", "reg") + f", {_UNION.format('reg')}, {_COVER} SELECT tx FROM ovl WHERE overlap_bp / total_exon_bp >= 0.6")
def repeat_overlap(s: SparkSession, d: str) -> DataFrame:
    return screens.region_overlap(exons(s, d), regions(s, d), 0.6)


def _par(s: SparkSession, d: str) -> DataFrame:
    """The first base of every region."""
    return regions(s, d).withColumn("end0", F.col("start0") + 1)


@query("par_overlap", ctes("exon", "reg") + f", few AS (SELECT rid, chrom, start0, start0 + 1 AS end0 FROM reg), {_UNION.format('few')}, {_COVER} SELECT tx FROM ovl WHERE overlap_bp > 0")
def par_overlap(s: SparkSession, d: str) -> DataFrame:
    return screens.region_overlap(exons(s, d), _par(s, d), 0.0)


def _segdup(s: SparkSession, d: str, tx: DataFrame | None = None) -> DataFrame:
    genes = regions(s, d, "p_partkey % 2 = 1").select("chrom", "start0", (F.col("start0") + 20).alias("end0"), (F.col("rid") % 3).alias("n_exons"))
    return screens.segdup_report(tx_of(s, d) if tx is None else tx, regions(s, d, "p_partkey % 2 = 0"), genes)


_SEGDUP = """sd AS (SELECT * FROM reg WHERE rid % 2 = 0), gen AS (SELECT chrom, start0, start0 + 20 AS end0, rid % 3 AS n_exons FROM reg WHERE rid % 2 = 1),
inside AS (SELECT DISTINCT t.tx FROM txs t JOIN sd ON sd.chrom = t.chrom AND sd.start0 <= t.lo + 1 AND sd.end0 >= t.hi AND t.lo + 1 < t.hi),
ne AS (SELECT tx, chrom, start0, end0, row_number() OVER (PARTITION BY tx ORDER BY start0) AS ord, count(*) OVER (PARTITION BY tx) AS cnt FROM exon),
ni AS (SELECT tx, chrom, donor, acceptor, row_number() OVER (PARTITION BY tx ORDER BY donor) AS ord, count(*) OVER (PARTITION BY tx) AS cnt FROM junc WHERE acceptor > donor),
lv AS (SELECT unnest([1, 2, 3, 4]) AS level),
ehit AS (SELECT * FROM ne WHERE EXISTS (SELECT 1 FROM sd WHERE sd.chrom = ne.chrom AND least(sd.end0, ne.end0) - greatest(sd.start0, ne.start0) >= 0.9 * (ne.end0 - ne.start0))),
el AS (SELECT tx, level, count(*) FILTER (WHERE ord <= level) = level AS f, count(*) FILTER (WHERE ord >= cnt - (level - 1)) = level AS l FROM ehit, lv WHERE cnt > level GROUP BY tx, level),
gl AS (SELECT tx, level, count(*) FILTER (WHERE ord = level AND n_exons = 1) AS fm, count(*) FILTER (WHERE ord = level AND n_exons <> 1) AS fx, coalesce(max(CASE WHEN ord = level THEN acceptor - donor END), 0) AS fl,
  count(*) FILTER (WHERE ord = cnt - (level - 1) AND n_exons = 1) AS lm, count(*) FILTER (WHERE ord = cnt - (level - 1) AND n_exons <> 1) AS lx, coalesce(max(CASE WHEN ord = cnt - (level - 1) THEN acceptor - donor END), 0) AS ll
  FROM ni JOIN gen g ON g.chrom = ni.chrom AND g.start0 >= ni.donor AND g.end0 <= ni.acceptor, lv WHERE cnt >= level GROUP BY tx, level),
rep AS (SELECT coalesce(e.tx, g.tx) AS tx, coalesce(e.level, g.level) AS level, coalesce(f, false) AS first_segdup, coalesce(fm, 0) AS first_mono, coalesce(fx, 0) AS first_multi, coalesce(fl, 0) AS first_len,
  coalesce(l, false) AS last_segdup, coalesce(lm, 0) AS last_mono, coalesce(lx, 0) AS last_multi, coalesce(ll, 0) AS last_len FROM el e FULL JOIN gl g ON e.tx = g.tx AND e.level = g.level)"""


@query("segdup_report", ctes("exon", "junc", "txs", "reg") + f", {_SEGDUP} SELECT *, tx IN (FROM inside) AS contained FROM rep")
def segdup_report(s: SparkSession, d: str) -> DataFrame:
    return _segdup(s, d)


@query("segdup_terminal", ctes("exon", "junc", "txs", "reg") + f", {_SEGDUP} SELECT DISTINCT tx FROM rep WHERE tx NOT IN (FROM inside) AND ((first_segdup AND first_multi > 0 AND first_len > 100) OR (last_segdup AND last_multi > 0 AND last_len > 100))")
def segdup_terminal(s: SparkSession, d: str) -> DataFrame:
    return screens.segdup_terminal(_segdup(s, d), 100)


# --- set operations and the balance sheet


def _failures(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Transcripts, written once, and the (screen, tx) that fail: every screen reads what is written."""
    tx = cut(tx_of(s, d), "transcripts")
    ex_ = splice.exon_rows(tx)
    found = {"par": screens.region_overlap(ex_, _par(s, d), 0.0), "repeats": screens.region_overlap(ex_, regions(s, d), 0.6), "segdup": screens.segdup_terminal(_segdup(s, d, tx), 100)}
    return tx, screens.failed(found)


_FAIL = f"{_UNION.format('reg')}, {_COVER}, few AS (SELECT rid, chrom, start0, start0 + 1 AS end0 FROM reg), fails AS (SELECT 'repeats' AS screen, tx FROM ovl WHERE overlap_bp / total_exon_bp >= 0.6 UNION SELECT 'par', e.tx FROM exon e JOIN few u ON e.chrom = u.chrom AND e.start0 < u.end0 AND u.start0 < e.end0 UNION SELECT 'segdup', tx FROM rep WHERE tx NOT IN (FROM inside) AND ((first_segdup AND first_multi > 0 AND first_len > 100) OR (last_segdup AND last_multi > 0 AND last_len > 100)))"
_FAIL_HEAD = ctes("exon", "junc", "txs", "reg") + f", {_SEGDUP}, {_FAIL}"


@query("fail_union", _FAIL_HEAD + " SELECT DISTINCT tx FROM fails")
def fail_union(s: SparkSession, d: str) -> DataFrame:
    return _failures(s, d)[1].select("tx").distinct()


@query("semi_by_id", _FAIL_HEAD + " SELECT tx, chrom, lo, hi FROM txs WHERE tx IN (SELECT tx FROM fails)")
def semi_by_id(s: SparkSession, d: str) -> DataFrame:
    tx, failures = _failures(s, d)
    return tx.join(failures.select("tx"), "tx", "left_semi").select("tx", "chrom", "lo", "hi")


@query("anti_by_id", _FAIL_HEAD + " SELECT tx, chrom, lo, hi FROM txs WHERE tx NOT IN (SELECT tx FROM fails)")
def anti_by_id(s: SparkSession, d: str) -> DataFrame:
    tx, failures = _failures(s, d)
    return tx.join(failures.select("tx"), "tx", "left_anti").select("tx", "chrom", "lo", "hi")


@query("filter_totals", _FAIL_HEAD + """ SELECT 'removed' AS metric, count(DISTINCT tx) AS value, screen AS filter FROM fails GROUP BY screen
UNION ALL SELECT 'removed_union', (SELECT count(DISTINCT tx) FROM fails), 'all' UNION ALL SELECT 'original', (SELECT count(*) FROM txs), 'all' UNION ALL SELECT 'remaining', (SELECT count(*) FROM txs WHERE tx NOT IN (SELECT tx FROM fails)), 'all'""")
def filter_totals(s: SparkSession, d: str) -> DataFrame:
    tx, failures = _failures(s, d)
    return reports.balance(tx.select("tx"), failures)


@query("depth_gt1", "SELECT l_orderkey AS tx, count(*) AS depth FROM lineitem WHERE regexp_matches(concat('chr', CAST(l_orderkey % 30 AS VARCHAR)), '^chr([0-9]+|[XYxy])$') AND l_orderkey % 30 < 23 GROUP BY 1 HAVING count(*) > 1")
def depth_gt1(s: SparkSession, d: str) -> DataFrame:
    """Transcripts seen more than once on whitelisted chromosomes."""
    chrom = F.concat(F.lit("chr"), F.when(F.col("l_orderkey") % 30 < 23, (F.col("l_orderkey") % 30).cast("string")).otherwise("Un"))
    rows = read(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("tx"), chrom.alias("chrom")).agg(F.count("*").alias("depth"))
    return reads.drop_singletons(reads.on_chromosomes(rows)).select("tx", "depth")


# --- annotation collapse

_COLLAPSE = """ok AS (SELECT * FROM gx WHERE tx % 13 <> 0), pt AS (SELECT chrom, start0 AS p FROM ok UNION SELECT chrom, end0 FROM ok),
seg AS (SELECT chrom, p AS s, lead(p) OVER (PARTITION BY chrom ORDER BY p) AS e FROM pt),
own AS (SELECT g.gene, g.chrom, g.strand, s.s, s.e FROM seg s JOIN ok g ON g.chrom = s.chrom AND g.start0 <= s.s AND g.end0 >= s.e WHERE s.e IS NOT NULL GROUP BY ALL),
solo AS (SELECT *, count(*) OVER (PARTITION BY chrom, s, e) AS genes FROM own),
kept AS (SELECT *, CASE WHEN lag(e) OVER (PARTITION BY gene, chrom, strand ORDER BY s) = s THEN 0 ELSE 1 END AS new FROM (SELECT * FROM solo WHERE genes = 1)),
grp AS (SELECT *, sum(new) OVER (PARTITION BY gene, chrom, strand ORDER BY s ROWS UNBOUNDED PRECEDING) AS g FROM kept),
mod AS (SELECT gene, chrom, strand, min(s) AS start0, max(e) AS end0 FROM grp GROUP BY gene, chrom, strand, g),
good AS (SELECT * FROM mod WHERE gene IN (SELECT gene FROM mod GROUP BY gene HAVING max(end0 - start0) > 1))"""
_GENES = "gx AS (SELECT tx, tx - tx % 8 AS gene, chrom, strand, start0 + (tx % 8) * 7 AS start0, end0 + (tx % 8) * 7 + (tx % 3) * 30 AS end0 FROM exon)"


_MODEL = "num AS (SELECT gene, chrom, strand, row_number() OVER (PARTITION BY gene ORDER BY CASE WHEN strand = '-' THEN -start0 ELSE start0 END) AS exon, start0, end0 FROM good)"


@query("collapse_annotation", ctes("exon") + f", {_GENES}, {_COLLAPSE}, {_MODEL} SELECT * FROM num")
def collapse_annotation(s: SparkSession, d: str) -> DataFrame:
    """Genes of eight transcripts that overlap their neighbours; a thirteenth of the transcripts is excluded."""
    ex_ = exons(s, d).withColumns({"gene": F.col("tx") - F.col("tx") % 8, "start0": F.col("start0") + F.col("tx") % 8 * 7, "end0": F.col("end0") + F.col("tx") % 8 * 7 + F.col("tx") % 3 * 30})
    ex_ = ex_.withColumn("transcript_type", F.when(F.col("tx") % 13 == 0, "retained_intron").otherwise("protein_coding"))
    return annotation.collapse(ex_)


@query("collapsed_bed12", ctes("exon") + f""", {_GENES}, {_COLLAPSE} SELECT chrom, min(start0) AS start, max(end0) AS "end", gene AS name, strand, count(*) AS block_count, string_agg(end0 - start0, ',' ORDER BY start0) AS block_sizes, string_agg(start0 - m, ',' ORDER BY start0) AS block_starts
FROM (SELECT *, min(start0) OVER (PARTITION BY gene, chrom, strand) AS m FROM good) GROUP BY gene, chrom, strand""")
def collapsed_bed12(s: SparkSession, d: str) -> DataFrame:
    """One BED12 row a gene's collapsed model."""
    model = splice.transcripts(collapse_annotation(s, d).withColumn("tx", F.col("gene")))
    return splice.to_bed12(model).select("chrom", "start", "end", "name", "strand", "block_count", "block_sizes", "block_starts")


# --- reads


@query("reservoir_cap", ctes("reads") + """, prim AS (SELECT * FROM reads WHERE (flag & 2308) = 0), ranked AS (SELECT *, row_number() OVER (ORDER BY md5(read_id || ':4232'), read_id) AS r FROM prim WHERE chrom = 'chrM')
SELECT read_id, sample, chrom, flag, pos FROM prim WHERE chrom <> 'chrM' UNION ALL SELECT read_id, sample, chrom, flag, pos FROM ranked WHERE r <= 500""")
def reservoir_cap(s: SparkSession, d: str) -> DataFrame:
    return reads.reservoir_cap(alignments(s, d), cap=500)


_FLAG = "count(*) AS total, count(*) FILTER (WHERE (flag & 2304) = 0) AS primary, count(*) FILTER (WHERE (flag & 256) <> 0) AS secondary, count(*) FILTER (WHERE (flag & 2048) <> 0) AS supplementary, count(*) FILTER (WHERE (flag & 4) = 0) AS mapped, count(*) FILTER (WHERE (flag & 2308) = 0) AS primary_mapped".replace("AS primary,", 'AS "primary",')


@query("flagstat", ctes("reads") + f" SELECT sample, {_FLAG} FROM reads GROUP BY sample")
def flagstat(s: SparkSession, d: str) -> DataFrame:
    return reads.flagstat(alignments(s, d))


@query("idxstats", ctes("reads") + " SELECT sample, chrom, count(*) FILTER (WHERE (flag & 4) = 0) AS mapped, count(*) FILTER (WHERE (flag & 4) <> 0) AS unmapped FROM reads GROUP BY ALL")
def idxstats(s: SparkSession, d: str) -> DataFrame:
    return reads.idxstats(alignments(s, d))


_MITO = "mito AS (SELECT sample, count(*) FILTER (WHERE (flag & 4) = 0 AND chrom = 'chrM') AS n FROM reads GROUP BY sample), st AS (SELECT sample, n, CASE WHEN n <= 460 THEN 'PASS (' || n || ' <= 460)' ELSE 'FAIL (' || n || ' > 460)' END AS status FROM mito)"


@query("chrm_status", ctes("reads") + f", {_MITO} SELECT * FROM st")
def chrm_status(s: SparkSession, d: str) -> DataFrame:
    return reads.mito_status(reads.idxstats(alignments(s, d)), 460)


_SUMMARY = f"""{_MITO}, fl AS (SELECT sample, {_FLAG} FROM reads GROUP BY sample), lng AS (SELECT f.sample, unnest([{{'m': 'total', 'v': total::VARCHAR}}, {{'m': 'primary', 'v': "primary"::VARCHAR}}, {{'m': 'secondary', 'v': secondary::VARCHAR}}, {{'m': 'supplementary', 'v': supplementary::VARCHAR}}, {{'m': 'mapped', 'v': mapped::VARCHAR}},
  {{'m': 'primary_mapped', 'v': primary_mapped::VARCHAR}}, {{'m': 'pct_mapped', 'v': CASE WHEN total = 0 THEN 'NA' ELSE printf('%.4f', mapped / total * 100) END}}, {{'m': 'chrM_reads', 'v': n::VARCHAR}}, {{'m': 'chrM_status', 'v': status}}]) AS x FROM fl f JOIN st ON st.sample = f.sample)"""


@query("bam_qc_summary", ctes("reads") + f", {_SUMMARY} SELECT sample, x.m AS metric, x.v AS value FROM lng")
def bam_qc_summary(s: SparkSession, d: str) -> DataFrame:
    return reads.qc_summary(alignments(s, d), 460)


@query("qc_long", ctes("reads") + f", {_SUMMARY} SELECT sample, x.m AS metric, x.v AS value FROM lng UNION ALL SELECT 10 + sample, x.m, x.v FROM lng")
def qc_long(s: SparkSession, d: str) -> DataFrame:
    """Cohort tables under one another."""
    one = reads.qc_summary(alignments(s, d), 460)
    return reads.union_all([one, one.withColumn("sample", F.col("sample") + 10)])


_METRICS = ["click", "error", "purchase", "signup", "view"]


@query("qc_wide", "WITH e AS (SELECT user_id % 10 AS sample, event_type AS metric, value::VARCHAR AS v, event_id AS pos FROM events) SELECT sample, " + ", ".join(f"coalesce(arg_min(CAST(CAST(pos AS BIGINT) AS VARCHAR), pos) FILTER (WHERE metric = '{m}'), 'NA') AS \"{m}\"" for m in _METRICS) + " FROM e GROUP BY sample")
def qc_wide(s: SparkSession, d: str) -> DataFrame:
    """First value (here: the id of the first event) by sample and kind."""
    long = read(s, d, "events").select((F.col("user_id") % 10).alias("sample"), F.col("event_type").alias("metric"), F.col("event_id").cast("string").alias("value"), F.col("event_id").alias("pos"))
    return reports.to_wide(long, metrics=_METRICS)


@query("qc_wide_found", ORACLES["qc_wide"])
def qc_wide_found(s: SparkSession, d: str) -> DataFrame:
    """The metrics are found, in order of appearance."""
    long = read(s, d, "events").select((F.col("user_id") % 10).alias("sample"), F.col("event_type").alias("metric"), F.col("event_id").cast("string").alias("value"), F.col("event_id").alias("pos"))
    return reports.to_wide(long)


@query("qc_wide_mean", "WITH e AS (SELECT user_id % 10 AS sample, event_type AS metric, event_id % 100 AS v FROM events) SELECT sample, " + ", ".join(f"round(avg(v) FILTER (WHERE metric = '{m}'), 6) AS \"{m}\"" for m in _METRICS) + " FROM e GROUP BY sample")
def qc_wide_mean(s: SparkSession, d: str) -> DataFrame:
    long = read(s, d, "events").select((F.col("user_id") % 10).alias("sample"), F.col("event_type").alias("metric"), (F.col("event_id") % 100).cast("string").alias("value"), F.col("event_id").alias("pos"))
    wide = reports.to_wide(long, "mean", _METRICS)
    return wide.select("sample", *(F.round(F.expr(f"try_cast({m} as double)"), 6).alias(m) for m in _METRICS))


@query("retained_pct", ctes("expr") + """, a AS (SELECT sample, CAST(sum(value) AS DOUBLE) AS assigned_reads FROM expr GROUP BY sample), r AS (SELECT user_id % 3 AS sample, count(*) * 1000 AS raw_reads FROM events GROUP BY 1)
SELECT a.sample, CAST(coalesce(raw_reads, 0) AS DOUBLE) AS raw_reads, assigned_reads, CASE WHEN raw_reads > 0 THEN round(assigned_reads / raw_reads * 100, 9) END AS retained_pct FROM a LEFT JOIN r ON a.sample = r.sample""")
def retained_pct(s: SparkSession, d: str) -> DataFrame:
    raw = read(s, d, "events").groupBy((F.col("user_id") % 3).alias("sample")).agg((F.count("*") * 1000).alias("raw_reads"))
    return reports.retained(raw, expression(s, d).groupBy("sample").agg(F.sum("value").cast("double").alias("assigned_reads"))).withColumn("retained_pct", F.round("retained_pct", 9))


def _lengths(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "documents").select(F.col("source").alias("sample"), F.col("n_chars").alias("len"))


_LEN = "lens AS (SELECT source AS sample, n_chars AS len FROM documents), fq AS (SELECT sample, len, count(*) AS freq FROM lens GROUP BY ALL)"


@query("seq_stats", f"WITH {_LEN}, cumu AS (SELECT sample, len, sum(freq * len) OVER (PARTITION BY sample ORDER BY len DESC) AS upto, sum(freq * len) OVER (PARTITION BY sample) AS total FROM fq), n50 AS (SELECT sample, max(len) AS n50 FROM cumu WHERE 2 * upto >= total GROUP BY sample) SELECT l.sample, count(*) AS num_seqs, CAST(sum(len) AS BIGINT) AS sum_len, min(len) AS min_len, round(avg(len), 4) AS avg_len, max(len) AS max_len, quantile_cont(len, 0.25) AS q1, quantile_cont(len, 0.5) AS q2, quantile_cont(len, 0.75) AS q3, any_value(n50) AS n50 FROM lens l JOIN n50 ON n50.sample = l.sample GROUP BY l.sample")
def seq_stats(s: SparkSession, d: str) -> DataFrame:
    return reports.sequence_stats(_lengths(s, d))


@query("len_box", f"WITH {_LEN} SELECT * FROM fq")
def len_box(s: SparkSession, d: str) -> DataFrame:
    return reports.frequencies(_lengths(s, d))


@query("len_box_grouped", f"WITH {_LEN} SELECT CASE WHEN sample IN ('src1', 'src2', 'src3') THEN 'A' ELSE 'Unmapped' END AS grp, len, CAST(sum(freq) AS BIGINT) AS freq FROM fq GROUP BY ALL")
def len_box_grouped(s: SparkSession, d: str) -> DataFrame:
    groups = s.createDataFrame([("src1", "A"), ("src2", "A"), ("src3", "A")], "sample string, grp string")
    return reports.grouped_lengths(reports.frequencies(_lengths(s, d)), groups)


@query("len_hist", f"WITH {_LEN}, b AS (SELECT sample, len // 200 * 200 AS bin, quantile_cont(freq, 0.5) AS v FROM fq GROUP BY ALL) SELECT sample, bin, round(v / sum(v) OVER (PARTITION BY sample), 8) AS density FROM b")
def len_hist(s: SparkSession, d: str) -> DataFrame:
    return reports.histogram(_lengths(s, d)).withColumn("density", F.round("density", 8))


@query("len_sliding", f"""WITH {_LEN}, ends AS (SELECT sample, min(len) AS lo, max(len) AS hi FROM fq GROUP BY sample), w AS (SELECT sample, lo, unnest(range(lo, hi - 1000 + 1, 100)) AS s FROM ends WHERE hi - 1000 >= lo),
v AS (SELECT w.sample, w.s, coalesce(quantile_cont(freq, 0.5), 0) AS v FROM w LEFT JOIN fq ON fq.sample = w.sample AND fq.len >= w.s AND fq.len < w.s + 1000 GROUP BY ALL)
SELECT sample, s + 500.0 AS mid, round(CASE WHEN sum(v) OVER (PARTITION BY sample) > 0 THEN v / sum(v) OVER (PARTITION BY sample) ELSE 0 END, 8) AS density FROM v""")
def len_sliding(s: SparkSession, d: str) -> DataFrame:
    return reports.sliding_histogram(_lengths(s, d), 1000, 100).withColumn("density", F.round("density", 8))


# --- collapse, merge, ends, rescue

_COLL = ctes("exon", "junc", "txs", "chain") + ", col AS (SELECT tx % 4 AS sample, chrom, strand, c, CASE WHEN n = 0 THEN lo END AS plo, CASE WHEN n = 0 THEN hi END AS phi, count(*) AS depth, min(lo) AS lo, max(hi) AS hi FROM chain GROUP BY 1, 2, 3, 4, 5, 6)"


def _bars(c: str) -> F.Column:
    bars = F.concat(F.lit("|"), F.array_join(F.transform(c, lambda j: F.concat_ws("-", j["donor"].cast("string"), j["acceptor"].cast("string"))), "|"), F.lit("|"))
    return F.when(F.size(c) > 0, bars).otherwise("")


def _collapsed(s: SparkSession, d: str) -> DataFrame:
    return reads.collapse_reads(tx_of(s, d).withColumn("sample", F.col("tx") % 4))


@query("collapse_reads", _COLL + " SELECT sample, chrom, strand, c AS chain, depth, lo, hi FROM col")
def collapse_reads(s: SparkSession, d: str) -> DataFrame:
    """Mono-exons are one by their ends."""
    return _collapsed(s, d).withColumn("chain", _bars("chain"))


_LOCI = ctes("exon", "txs") + """, m AS (SELECT tx, chrom, strand, tx % 4 AS sample, lo + tx % 11 AS lo, hi + tx % 11 AS hi FROM txs WHERE n_exons = 1),
f AS (SELECT *, CASE WHEN lo < max(hi) OVER (PARTITION BY chrom, strand ORDER BY lo, hi, tx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS f FROM m),
g AS (SELECT *, sum(f) OVER (PARTITION BY chrom, strand ORDER BY lo, hi, tx) AS g FROM f)"""


@query("mono_loci", _LOCI + " SELECT chrom, strand, min(lo) AS lo, max(hi) AS hi, " + ", ".join(f"count(*) FILTER (WHERE sample = {k}) AS depth_{k}" for k in range(4)) + " FROM g GROUP BY chrom, strand, g")
def mono_loci(s: SparkSession, d: str) -> DataFrame:
    """Mono-exon reads whose ends differ by some bases, by the loci that they cover together."""
    shift = F.col("tx") % 11
    mono = tx_of(s, d).filter("size(exons) = 1").select("tx", "chrom", "strand", (F.col("tx") % 4).alias("sample"), "chain", (F.col("lo") + shift).alias("lo"), (F.col("hi") + shift).alias("hi"))
    return reads.merge_samples(reads.collapse_reads(reads.with_loci(mono)), [0, 1, 2, 3]).drop("chain")


@query("merge_samples", _COLL + " SELECT chrom, strand, c AS chain, min(lo) AS lo, max(hi) AS hi, " + ", ".join(f"CAST(coalesce(sum(depth) FILTER (WHERE sample = {k}), 0) AS BIGINT) AS depth_{k}" for k in range(4)) + " FROM col GROUP BY chrom, strand, c, plo, phi")
def merge_samples(s: SparkSession, d: str) -> DataFrame:
    return reads.merge_samples(_collapsed(s, d), [0, 1, 2, 3]).withColumn("chain", _bars("chain"))


@query("modal_ends", ctes("exon", "junc", "txs", "chain") + ", p AS (SELECT gene, CASE WHEN strand = '-' THEN hi ELSE lo END AS pos, count(*) AS n FROM txs GROUP BY ALL) SELECT gene, arg_min(pos, (-n) * 100000000000 + pos) AS pos, max(n) AS n, count(*) AS n_pos FROM p GROUP BY gene")
def modal_ends(s: SparkSession, d: str) -> DataFrame:
    points = tx_of(s, d).join(splice.ends(tx_of(s, d)).select("tx", "tss"), "tx").select("gene", F.col("tss").alias("pos"))
    return reads.modal_ends(points, ("gene",))


@query("novel_gene_rescue", ctes("exon", "txs") + """, present AS (SELECT tx FROM txs WHERE tx % 3 = 0), nov AS (SELECT tx FROM present WHERE tx % 7 IN (0, 1)),
bd AS (SELECT tx, chrom, strand, 's' AS side, start0 AS pos FROM exon UNION ALL SELECT tx, chrom, strand, 'e', end0 FROM exon),
known AS (SELECT DISTINCT chrom, strand, side, pos FROM bd WHERE tx IN (SELECT tx FROM nov))
SELECT tx FROM present UNION SELECT b.tx FROM bd b JOIN known k USING (chrom, strand, side, pos) WHERE b.tx NOT IN (SELECT tx FROM present) AND b.tx % 4 <> 1""")
def novel_gene_rescue(s: SparkSession, d: str) -> DataFrame:
    ex_ = exons(s, d)
    tx = ex_.select("tx").distinct()
    status = tx.select("tx", F.when(F.col("tx") % 7 == 0, "intergenic").when(F.col("tx") % 7 == 1, "antisense").otherwise("known").alias("status"))
    return reports.novel_gene_rescue(tx.filter("tx % 3 = 0"), ex_, status, tx.filter("tx % 4 = 1"))


@query("stages_decisions")
def stages_decisions(s: SparkSession, d: str) -> DataFrame:
    """Screens, defragmentation and pruning as one plan; no SQL of its own, its steps have theirs."""
    from strandloom.config import EngineConfig

    from .stages import Inputs, run_all

    ex_ = exons(s, d).withColumn("ord", F.col("tx"))
    genes = regions(s, d).select("chrom", "start0", (F.col("start0") + 20).alias("end0"), (F.col("rid") % 3).alias("n_exons"))
    inp = Inputs(
        ex_, expression(s, d), reference(exons(s, d)), genome=genome(s, d), junctions=_local_junctions(s, d), reference_tss=_reference_tss(s, d),
        repeats=regions(s, d), par=_par(s, d), segdups=regions(s, d), gene_regions=genes,
    )
    # The fixture's bases are letters of prose: most motifs are allowed, so that something is left for the later stages.
    motifs = tuple(a + b + c + e for a in "ACG" for b in "ACGT" for c in "ACGT" for e in "ACGT")
    out = run_all(inp, EngineConfig(tpm_min=1.0, tss_max_distance=1000, allowed_motifs=motifs, segdup_min_intron=100, repeat_min_overlap_fraction=0.95))
    return out["decisions"].select("tx", "cluster_id", "passes", "kept")
