"""Queries over chains, expression, containment and clusters, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.lineage import cut
from strandloom.operators import containment as con
from strandloom.operators import expression as ex
from strandloom.operators import graph, prune, splice
from strandloom.operators.numbering import number_by_range

from .fixtures import ctes, exons, expression, read, regions

SAMPLES = [0, 1, 2, 3]
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query under ``name`` with its SQL."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def tx_of(s: SparkSession, d: str) -> DataFrame:
    """Transcripts with their position in the annotation."""
    return splice.transcripts(exons(s, d)).withColumn("ord", F.col("tx"))


def text(chain) -> F.Column:
    """A chain as text, for results."""
    return F.array_join(F.transform(chain, lambda j: F.concat_ws("-", j["donor"].cast("string"), j["acceptor"].cast("string"))), ",")


# --- chains and block forms


@query("part_index", "SELECT l_suppkey % 4 AS sample, l_orderkey * 8 + l_linenumber AS path_id, row_number() OVER (PARTITION BY l_suppkey % 4 ORDER BY l_orderkey, l_linenumber) - 1 AS part FROM (SELECT DISTINCT l_suppkey % 4 + 0 AS l_suppkey, l_orderkey, l_linenumber FROM lineitem)")
def part_index(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "lineitem").select((F.col("l_suppkey") % 4).alias("sample"), "l_orderkey", "l_linenumber").distinct()
    rows = number_by_range(rows, ["sample"], F.floor(F.col("l_orderkey") / 65536), ["l_orderkey", "l_linenumber"], "part")
    return rows.select("sample", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("path_id"), "part")


@query("splice_chain", ctes("exon", "junc") + " SELECT tx, gene, chrom, strand, string_agg(donor || '-' || acceptor, ',' ORDER BY donor, acceptor) AS chain, count(*) AS n FROM junc GROUP BY ALL")
def splice_chain(s: SparkSession, d: str) -> DataFrame:
    return tx_of(s, d).filter(F.size("chain") > 0).select(*splice.KEYS, text(F.col("chain")).alias("chain"), F.size("chain").alias("n"))


@query("gtf_to_bed12", ctes("exon") + """ SELECT chrom, min(start0) AS start, max(end0) AS "end", tx AS name, 0 AS score, strand, min(start0) AS thick_start, max(end0) AS thick_end, '0,0,0' AS rgb, count(*) AS block_count,
  string_agg(end0 - start0, ',' ORDER BY start0) AS block_sizes, string_agg(start0 - m, ',' ORDER BY start0) AS block_starts
FROM (SELECT *, min(start0) OVER (PARTITION BY tx) AS m FROM exon) GROUP BY tx, gene, chrom, strand""")
def gtf_to_bed12(s: SparkSession, d: str) -> DataFrame:
    return splice.to_bed12(tx_of(s, d))


@query("bed12_exons", ctes("exon") + " SELECT tx AS name, chrom, strand, row_number() OVER (PARTITION BY tx ORDER BY start0) AS exon, start0, end0 FROM exon")
def bed12_exons(s: SparkSession, d: str) -> DataFrame:
    return splice.bed12_exons(splice.to_bed12(tx_of(s, d)))


@query("bed12_junctions", ctes("exon", "junc") + " SELECT tx AS name, chrom, strand, row_number() OVER (PARTITION BY tx ORDER BY donor) AS junction, donor, acceptor FROM junc")
def bed12_junctions(s: SparkSession, d: str) -> DataFrame:
    return splice.bed12_junctions(splice.to_bed12(tx_of(s, d)))


@query("introns", ctes("exon", "junc") + " SELECT tx, gene, chrom, strand, donor AS start0, acceptor AS end0 FROM junc WHERE acceptor > donor")
def introns(s: SparkSession, d: str) -> DataFrame:
    return splice.introns(tx_of(s, d))


@query("exon_intron_numbered", ctes("exon", "junc") + """ SELECT tx, 'ex' AS kind, row_number() OVER (PARTITION BY tx ORDER BY start0) AS ord, count(*) OVER (PARTITION BY tx) AS cnt, chrom, start0, end0 FROM exon
UNION ALL SELECT tx, 'in', row_number() OVER (PARTITION BY tx ORDER BY donor), count(*) OVER (PARTITION BY tx), chrom, donor, acceptor FROM junc WHERE acceptor > donor""")
def exon_intron_numbered(s: SparkSession, d: str) -> DataFrame:
    return splice.numbered(tx_of(s, d))


@query("tss_tes", ctes("exon", "txs") + " SELECT tx, chrom, strand, CASE WHEN strand = '-' THEN hi ELSE lo END AS tss, CASE WHEN strand = '-' THEN lo ELSE hi END AS tes FROM txs")
def tss_tes(s: SparkSession, d: str) -> DataFrame:
    return splice.ends(tx_of(s, d))


@query("tx_span", ctes("exon", "txs") + " SELECT tx, gene, chrom, strand, lo, hi, n_exons FROM txs")
def tx_span(s: SparkSession, d: str) -> DataFrame:
    return exons(s, d).groupBy(*splice.KEYS).agg(F.min("start0").alias("lo"), F.max("end0").alias("hi"), F.count("*").alias("n_exons"))


# --- expression


@query("expr_long", ctes("expr") + " SELECT tx, sample, CAST(coalesce(try_cast(CASE WHEN tx % 7 = 0 THEN 'bad' ELSE CAST(value AS VARCHAR) END AS DOUBLE), 0) AS DOUBLE) AS value FROM expr")
def expr_long(s: SparkSession, d: str) -> DataFrame:
    """A wide matrix of texts, some of them bad, made long again with lenient numbers."""
    from strandloom.sources.matrix import to_long

    cells = expression(s, d).withColumn("value", F.when(F.col("tx") % 7 == 0, "bad").otherwise(F.col("value").cast("string")))
    wide = cells.groupBy("tx").pivot("sample", SAMPLES).agg(F.first("value"))
    return to_long(wide, "tx", keep_missing=False).select("tx", F.col("sample").cast("bigint").alias("sample"), "value")


@query("cpm", ctes("expr") + " SELECT tx, sample, value, round(1e6 * value / sum(value) OVER (PARTITION BY sample), 4) AS cpm FROM expr")
def cpm(s: SparkSession, d: str) -> DataFrame:
    return ex.cpm(expression(s, d)).withColumn("cpm", F.round("cpm", 4))


@query("tpm_filter", ctes("expr") + " SELECT tx FROM (SELECT tx, 1e6 * value / sum(value) OVER (PARTITION BY sample) AS cpm FROM expr) GROUP BY tx HAVING count(*) FILTER (WHERE cpm >= 50) < 3")
def tpm_filter(s: SparkSession, d: str) -> DataFrame:
    """Transcripts below 50 counts a million in all but two samples."""
    return ex.low_expression(expression(s, d), 50, 3)


_FRACTION = "frac AS (SELECT e.tx, x.gene, x.chrom, x.strand, e.sample, e.value, sum(e.value) OVER (PARTITION BY x.gene, x.chrom, x.strand, e.sample) AS total FROM expr e JOIN txs x ON e.tx = x.tx)"


@query("isoform_fraction", ctes("exon", "txs", "expr") + f", {_FRACTION} SELECT tx, gene, sample, value, total, round(CASE WHEN total > 0 THEN value / total ELSE 0 END, 10) AS fraction FROM frac")
def isoform_fraction(s: SparkSession, d: str) -> DataFrame:
    return ex.fractions(expression(s, d), tx_of(s, d)).select("tx", "gene", "sample", "value", "total", F.round("fraction", 10).alias("fraction"))


_PROTECTED = "prot AS (SELECT tx FROM frac WHERE total > 0 AND value / total >= 0.1 GROUP BY tx HAVING count(*) >= 2)"


@query("protected_tx", ctes("exon", "txs", "expr") + f", {_FRACTION}, {_PROTECTED} SELECT tx FROM prot")
def protected_tx(s: SparkSession, d: str) -> DataFrame:
    return ex.protected(expression(s, d), tx_of(s, d))


_DOMINANCE = """grid AS (SELECT x.tx, x.gene, x.chrom, x.strand, s.sample FROM (SELECT * FROM txs WHERE tx IN (SELECT tx FROM expr)) x, (SELECT unnest([0, 1, 2, 3]) AS sample) s),
vals AS (SELECT g.*, CAST(coalesce(e.value, 0) AS DOUBLE) AS value FROM grid g LEFT JOIN expr e ON e.tx = g.tx AND e.sample = g.sample),
fr AS (SELECT *, CASE WHEN sum(value) OVER w > 0 THEN value / sum(value) OVER w ELSE 0 END AS f FROM vals WINDOW w AS (PARTITION BY gene, chrom, strand, sample)),
dom AS (SELECT gene, chrom, strand, CAST(sample AS BIGINT) AS sample, max(f) AS top_fraction, count(*) FILTER (WHERE f >= 0.1) AS n_ge_10, count(*) FILTER (WHERE f >= 0.05) AS n_ge_5, count(*) FILTER (WHERE f >= 0.01) AS n_ge_1 FROM fr GROUP BY ALL)"""


@query("dominance_groups", ctes("exon", "txs", "expr") + f", {_DOMINANCE} SELECT gene, chrom, strand, sample, round(top_fraction, 6) AS top_fraction, n_ge_10, n_ge_5, n_ge_1 FROM dom")
def dominance_groups(s: SparkSession, d: str) -> DataFrame:
    return ex.dominance(expression(s, d), tx_of(s, d), SAMPLES).withColumn("top_fraction", F.round("top_fraction", 6))


@query("dominance_summary", ctes("exon", "txs", "expr") + f""", {_DOMINANCE}, u AS (SELECT 10 AS threshold_pct, n_ge_10 AS n FROM dom UNION ALL SELECT 5, n_ge_5 FROM dom UNION ALL SELECT 1, n_ge_1 FROM dom)
SELECT threshold_pct, round(avg(n), 6) AS mean_n, quantile_cont(n, 0.5) AS median_n, quantile_cont(n, 0.9) AS p90_n, quantile_cont(n, 0.95) AS p95_n,
  round(avg(CASE WHEN n = 1 THEN 100.0 ELSE 0 END), 6) AS pct_1, round(avg(CASE WHEN n = 2 THEN 100.0 ELSE 0 END), 6) AS pct_2, round(avg(CASE WHEN n = 3 THEN 100.0 ELSE 0 END), 6) AS pct_3, round(avg(CASE WHEN n >= 4 THEN 100.0 ELSE 0 END), 6) AS pct_ge4
FROM u GROUP BY threshold_pct""")
def dominance_summary(s: SparkSession, d: str) -> DataFrame:
    out = ex.dominance_summary(ex.dominance(expression(s, d), tx_of(s, d), SAMPLES))
    return out.select("threshold_pct", *(F.round(c, 6).alias(c) for c in out.columns[1:]))


# --- containment

# Runs of adjacent junctions: the shorter chain's text, with bars at both ends, inside the longer one's.
_EDGES = """edge AS (SELECT a.gene, a.chrom, a.strand, a.tx AS child, b.tx AS parent, b.n - a.n AS extra, a.lo AS clo, a.hi AS chi, b.lo AS plo, b.hi AS phi, a.c AS cc
  FROM chain a JOIN chain b ON a.gene = b.gene AND a.chrom = b.chrom AND a.strand = b.strand AND b.n > a.n AND (a.n = 0 OR contains(b.c, a.c)))"""
_MINIMAL = "mini AS (SELECT * FROM (SELECT *, min(extra) OVER (PARTITION BY child) AS least FROM edge) WHERE extra = least)"
_MAP = "SELECT CAST(child AS VARCHAR) AS contained_transcript, string_agg(CAST(parent AS VARCHAR), ',' ORDER BY CAST(parent AS VARCHAR)) AS superset_transcripts FROM mini GROUP BY child"


@query("containment_map", ctes("exon", "junc", "txs", "chain") + f", {_EDGES}, {_MINIMAL} {_MAP}")
def containment_map(s: SparkSession, d: str) -> DataFrame:
    return con.containment_map(con.containment(tx_of(s, d)))


@query("containment_all", ctes("exon", "junc", "txs", "chain") + """ SELECT a.tx AS child, b.tx AS parent, b.n - a.n AS extra FROM chain a JOIN chain b ON a.gene = b.gene AND a.chrom = b.chrom AND a.strand = b.strand AND b.n > a.n
WHERE NOT EXISTS (SELECT 1 FROM junc j WHERE j.tx = a.tx AND NOT EXISTS (SELECT 1 FROM junc k WHERE k.tx = b.tx AND k.donor = j.donor AND k.acceptor = j.acceptor))""")
def containment_all(s: SparkSession, d: str) -> DataFrame:
    """Subsets of junctions, adjacent or not, in all supersets."""
    return con.containment(tx_of(s, d), terminal_only=False, minimal_superset=False).select("child", "parent", "extra")


@query("containment_refprotect", ctes("exon", "junc", "txs", "chain") + f", edge0 AS (SELECT * FROM (WITH {_EDGES} SELECT * FROM edge)), edge AS (SELECT * FROM edge0 WHERE NOT EXISTS (SELECT 1 FROM chain r WHERE r.tx % 5 = 0 AND r.chrom = edge0.chrom AND r.strand = edge0.strand AND r.c = edge0.cc)), {_MINIMAL} {_MAP}")
def containment_refprotect(s: SparkSession, d: str) -> DataFrame:
    """Chains that equal a reference chain are no children."""
    tx = tx_of(s, d)
    return con.containment_map(con.containment(tx, protect_chains=tx.filter("tx % 5 = 0").select("chrom", "strand", "chain")))


@query("containment_protected", ctes("exon", "junc", "txs", "chain", "reg") + f""", pts AS (SELECT tx, chrom, strand, CASE WHEN strand = '-' THEN hi ELSE lo END AS tss, CASE WHEN strand = '-' THEN lo ELSE hi END AS tes FROM txs),
ktss AS (SELECT DISTINCT p.tx FROM pts p JOIN reg r ON p.chrom = r.chrom AND p.tss BETWEEN r.start0 - 50 AND r.end0 + 50 AND r.rid % 3 = 0),
ktes AS (SELECT DISTINCT p.tx FROM pts p JOIN reg r ON p.chrom = r.chrom AND p.tes BETWEEN r.start0 - 50 AND r.end0 + 50 AND r.rid % 3 = 1),
edge0 AS (SELECT * FROM (WITH {_EDGES} SELECT * FROM edge)),
edge AS (SELECT * FROM edge0 WHERE
  (NOT (child IN (FROM ktss) OR parent IN (FROM ktss)) OR abs(CASE WHEN strand = '+' THEN clo - plo ELSE chi - phi END) <= 50) AND
  (NOT (child IN (FROM ktes) OR parent IN (FROM ktes)) OR abs(CASE WHEN strand = '+' THEN chi - phi ELSE clo - plo END) <= 50)), {_MINIMAL} {_MAP}""")
def containment_protected(s: SparkSession, d: str) -> DataFrame:
    """Ends near known regions must agree."""
    tx = tx_of(s, d)
    ends = splice.ends(tx)
    known = lambda pos, keep: con.near_regions(ends.withColumn("pos", F.col(pos)), regions(s, d, keep).withColumn("strand", F.lit(".")))
    return con.containment_map(con.containment(tx, near_tss=known("tss", "p_partkey % 3 = 0"), near_tes=known("tes", "p_partkey % 3 = 1")))


# --- cascade and rounding

_CASCADE = """prot_edges AS (SELECT * FROM mini WHERE child NOT IN (SELECT tx FROM prot)),
node AS (SELECT tx, gene, n AS len, row_number() OVER (PARTITION BY gene, chrom, strand ORDER BY tx) AS i FROM chain WHERE tx IN (SELECT child FROM prot_edges UNION SELECT parent FROM prot_edges)),
don AS (SELECT c.gene, c.i, c.len, c.tx, list(p.i ORDER BY p.i) AS dest, row_number() OVER (PARTITION BY c.gene ORDER BY c.len, c.tx) AS k FROM prot_edges e JOIN node c ON c.tx = e.child JOIN node p ON p.tx = e.parent GROUP BY c.gene, c.i, c.len, c.tx),
init AS (SELECT n.gene, s.sample, list(CAST(coalesce(e.value, 0) AS DOUBLE) ORDER BY n.i) AS mass FROM node n CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS sample) s LEFT JOIN expr e ON e.tx = n.tx AND e.sample = s.sample GROUP BY ALL),
rec AS (SELECT gene, sample, 0::BIGINT AS step, mass FROM init
  UNION ALL SELECT gene, sample, step, CASE WHEN amt > 0 THEN list_transform(mass, lambda v, q: CASE WHEN q = i THEN 0.0 WHEN list_contains(dest, q) THEN v + amt * {share} ELSE v END) ELSE mass END
  FROM (SELECT r.gene, r.sample, r.step + 1 AS step, r.mass, d.i, d.dest, r.mass[d.i] AS amt, list_sum(list_transform(d.dest, lambda q: greatest(r.mass[q], 0))) AS tot FROM rec r JOIN don d ON d.gene = r.gene AND d.k = r.step + 1)),
fin AS (SELECT gene, sample, mass FROM rec QUALIFY row_number() OVER (PARTITION BY gene, sample ORDER BY step DESC) = 1),
out0 AS (SELECT n.tx, CAST(f.sample AS BIGINT) AS sample, f.mass[n.i] AS value FROM fin f JOIN node n ON n.gene = f.gene),
moved AS (SELECT o.* FROM out0 o LEFT JOIN expr e ON e.tx = o.tx AND e.sample = o.sample WHERE e.tx IS NOT NULL OR o.value <> 0
  UNION ALL SELECT tx, sample, CAST(value AS DOUBLE) FROM expr WHERE tx NOT IN (SELECT tx FROM node))"""
_CASCADE_HEAD = ctes("exon", "junc", "txs", "chain", "expr").replace("WITH", "WITH RECURSIVE", 1) + f", {_EDGES}, {_MINIMAL}, {_FRACTION}, {_PROTECTED}, "
_PROP, _EQUAL = "CASE WHEN tot > 0 THEN v / tot ELSE 1.0 / len(dest) END", "1.0 / len(dest)"


def _cascade_inputs(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Transcripts, expression, containment and protection, each written once: the cascade reads them several times."""
    tx, expr = cut(tx_of(s, d), "transcripts"), cut(expression(s, d), "expression")
    return tx, expr, cut(con.containment(tx), "containment"), cut(ex.protected(expr, tx), "protected")


@query("cascade_redistribute", _CASCADE_HEAD + _CASCADE.format(share=_PROP) + " SELECT tx, sample, round(value, 6) AS value FROM moved WHERE tx NOT IN (SELECT child FROM mini WHERE child NOT IN (SELECT tx FROM prot))")
def cascade_redistribute(s: SparkSession, d: str) -> DataFrame:
    """Contained transcripts give their mass to their supersets and go, unless protected."""
    tx, expr, edges, guard = _cascade_inputs(s, d)
    out = ex.drop_contained(ex.cascade(expr, tx, edges, guard, samples=SAMPLES), edges, guard)
    return out.withColumn("value", F.round("value", 6))


@query("cascade_equal", _CASCADE_HEAD + _CASCADE.format(share=_EQUAL) + " SELECT tx, sample, round(value, 6) AS value FROM moved")
def cascade_equal(s: SparkSession, d: str) -> DataFrame:
    tx, expr, edges, guard = _cascade_inputs(s, d)
    return ex.cascade(expr, tx, edges, guard, proportional=False, samples=SAMPLES).withColumn("value", F.round("value", 6))


def _rounded(base: str, up: str) -> str:
    return f"""{ctes("expr")}, v AS (SELECT tx, sample, value * (tx % 4 + 1) / 8.0 AS x FROM expr), b AS (SELECT *, CAST({base}(x) AS BIGINT) AS base, x - {base}(x) AS rest FROM v),
q AS (SELECT *, CAST(round_even(sum(x) OVER (PARTITION BY sample) - sum(base) OVER (PARTITION BY sample), 0) AS BIGINT) AS diff,
  row_number() OVER (PARTITION BY sample ORDER BY rest DESC, tx) AS up, row_number() OVER (PARTITION BY sample ORDER BY rest, tx) AS down FROM b)
SELECT tx, sample, {up} AS value FROM q"""


@query("round_preserve_sum", _rounded("floor", "base + CASE WHEN up <= diff THEN 1 ELSE 0 END"))
def round_preserve_sum(s: SparkSession, d: str) -> DataFrame:
    return ex.round_preserve_sum(expression(s, d).withColumn("value", F.col("value") * (F.col("tx") % 4 + 1) / 8.0))


@query("round_preserve_sum_ceil", _rounded("ceil", "CASE WHEN down <= -diff THEN greatest(base - 1, 0) ELSE base END"))
def round_preserve_sum_ceil(s: SparkSession, d: str) -> DataFrame:
    return ex.round_preserve_sum(expression(s, d).withColumn("value", F.col("value") * (F.col("tx") % 4 + 1) / 8.0), "ceil")


# --- pairs and clusters

_PAIRS = """ch AS (SELECT tx, n FROM chain),
pair AS (SELECT a.gene, a.chrom, a.strand, a.tx AS a, b.tx AS b, count(*) AS shared FROM junc a JOIN junc b ON a.gene = b.gene AND a.chrom = b.chrom AND a.strand = b.strand AND a.donor = b.donor AND a.acceptor = b.acceptor AND a.tx < b.tx GROUP BY ALL),
sized AS (SELECT p.*, x.n AS size_a, y.n AS size_b FROM pair p JOIN ch x ON x.tx = p.a JOIN ch y ON y.tx = p.b)"""


@query("junction_pairs", ctes("exon", "junc", "txs", "chain") + f", {_PAIRS} SELECT gene, chrom, strand, a, b, size_a, size_b, shared FROM sized")
def junction_pairs(s: SparkSession, d: str) -> DataFrame:
    return graph.junction_pairs(tx_of(s, d))


@query("pair_jaccard", ctes("exon", "junc", "txs", "chain") + f", {_PAIRS} SELECT a, b, round(shared / (size_a + size_b - shared), 6) AS jaccard FROM sized")
def pair_jaccard(s: SparkSession, d: str) -> DataFrame:
    pairs = graph.junction_pairs(tx_of(s, d))
    return pairs.select("a", "b", F.round(F.col("shared") / (F.col("size_a") + F.col("size_b") - F.col("shared")), 6).alias("jaccard"))


def _components(condition: str, tail: str = "SELECT tx, gene, chrom, strand, cluster_id, count(*) OVER (PARTITION BY cluster_id) AS cluster_size FROM clus") -> str:
    return ctes("exon", "junc", "txs", "chain", "expr").replace("WITH", "WITH RECURSIVE", 1) + f""", {_PAIRS},
link AS (SELECT a, b FROM sized WHERE {condition} UNION SELECT b, a FROM sized WHERE {condition}),
walk AS (SELECT tx, tx AS r FROM txs UNION SELECT l.b, w.r FROM walk w JOIN link l ON l.a = w.tx),
clus AS (SELECT w.tx, t.gene, t.chrom, t.strand, min(w.r) AS cluster_id FROM walk w JOIN txs t ON t.tx = w.tx GROUP BY ALL)
{tail}"""


_MODE_SQL = {
    "any": ("any_shared", "shared >= 1"),
    "subset": ("subset", "shared = least(size_a, size_b)"),
    "jaccard": ("jaccard", "shared / (size_a + size_b - shared) >= 0.5"),
    "bridge": ("bridge_safe", "shared >= 2 OR shared / (size_a + size_b - shared) >= 0.15"),
}


def _cluster_query(mode: str):
    def run(s: SparkSession, d: str) -> DataFrame:
        return graph.clusters(tx_of(s, d), mode)

    run.__doc__ = f"Clusters of transcripts linked by {mode}."
    return run


for _name, (_mode, _sql) in _MODE_SQL.items():
    query(f"cluster_{_name}", _components(_sql))(_cluster_query(_mode))
query("junction_clusters", _components("shared >= 1"))(_cluster_query("any_shared"))
query("cluster_exact", ctes("exon", "junc", "txs", "chain") + " SELECT tx, gene, chrom, strand, min(tx) OVER w AS cluster_id, count(*) OVER w AS cluster_size FROM chain WINDOW w AS (PARTITION BY gene, chrom, strand, c)")(_cluster_query("exact"))


# --- pruning

_ALONE = "clus AS (SELECT tx, gene, chrom, strand, min(tx) OVER (PARTITION BY gene, chrom, strand) AS cluster_id, count(*) OVER (PARTITION BY gene, chrom, strand) AS cluster_size FROM txs)"
_SCORES = """sc AS (SELECT c.tx, c.cluster_id, CAST(count(*) OVER (PARTITION BY c.cluster_id) AS BIGINT) AS cluster_size, s.sum AS expr_sum, s.max AS expr_max, s.sum / 4 AS expr_mean
  FROM clus c JOIN (SELECT tx, CAST(sum(value) AS DOUBLE) AS sum, CAST(CASE WHEN count(*) < 4 THEN greatest(max(value), 0) ELSE max(value) END AS DOUBLE) AS max FROM expr GROUP BY tx) s ON s.tx = c.tx)"""


def _locus_clusters(s: SparkSession, d: str) -> DataFrame:
    """Each gene and locus as one cluster: larger than what junctions link, for the windows' sake."""
    by = Window.partitionBy("gene", "chrom", "strand")
    return tx_of(s, d).select("tx", "gene", "chrom", "strand", F.min("tx").over(by).alias("cluster_id"), F.count("*").over(by).alias("cluster_size"))


@query("cluster_score", ctes("exon", "txs", "expr") + f", {_ALONE}, {_SCORES} SELECT tx, cluster_id, expr_sum, expr_max, expr_mean FROM sc")
def cluster_score(s: SparkSession, d: str) -> DataFrame:
    return prune.scored(expression(s, d), _locus_clusters(s, d), samples=SAMPLES).select("tx", "cluster_id", "expr_sum", "expr_max", "expr_mean")


@query("prune_percentile", ctes("exon", "txs", "expr") + f""", {_ALONE}, {_SCORES},
r AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY expr_sum DESC, tx) AS rank, count(*) OVER (PARTITION BY cluster_id) AS n FROM sc),
k AS (SELECT *, rank <= greatest(1, least(n, ceil(0.8 * n))) AS kept FROM r)
SELECT tx, cluster_id, expr_sum AS score, kept, min(CASE WHEN kept THEN expr_sum END) OVER (PARTITION BY cluster_id) AS cutoff FROM k""")
def prune_percentile(s: SparkSession, d: str) -> DataFrame:
    rows = prune.scored(expression(s, d), _locus_clusters(s, d), samples=SAMPLES)
    return prune.keep_percentile(rows, 80.0).select("tx", "cluster_id", "score", "kept", "cutoff")


_CUM = """vals AS (SELECT c.tx, c.cluster_id, s.sample, CAST(coalesce(e.value, 0) AS DOUBLE) AS value FROM clus c CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS sample) s LEFT JOIN expr e ON e.tx = c.tx AND e.sample = s.sample WHERE c.tx IN (SELECT tx FROM expr)),
cum AS (SELECT *, coalesce(sum(value) OVER (PARTITION BY cluster_id, sample ORDER BY value DESC, tx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(value) OVER (PARTITION BY cluster_id, sample) AS total FROM vals)"""


@query("cumexpr_keep", ctes("exon", "txs", "expr") + f", {_ALONE}, {_CUM} SELECT tx, cluster_id, CAST(sample AS BIGINT) AS sample, total > 0 AND before < 0.8 * total AS kept FROM cum")
def cumexpr_keep(s: SparkSession, d: str) -> DataFrame:
    expr = expression(s, d)
    keys = _locus_clusters(s, d).join(expr.select("tx").distinct(), "tx", "left_semi").select("tx", "cluster_id")
    values = cut(ex.dense(expr, keys, SAMPLES), "dense")
    return prune.cumulative_keep(values, 0.8).select("tx", "cluster_id", "sample", "kept")


_SUPPORT = f"""{_CUM}, ps AS (SELECT tx, count(*) FILTER (WHERE (total > 0 AND before < 0.97 * total)) AS passes FROM cum GROUP BY tx),
sup AS (SELECT s.*, p.passes, count(*) FILTER (WHERE p.passes >= 2) OVER (PARTITION BY s.cluster_id) AS good, row_number() OVER (PARTITION BY s.cluster_id ORDER BY s.expr_sum DESC, s.tx) AS best FROM sc s JOIN ps p ON p.tx = s.tx),
dec AS (SELECT *, CASE WHEN good < 1 THEN best <= 1 ELSE passes >= 2 END AS kept FROM sup)"""


@query("sample_support", _components("shared >= 1", f", {_SCORES}, {_SUPPORT} SELECT tx, cluster_id, passes, kept FROM dec"))
def sample_support(s: SparkSession, d: str) -> DataFrame:
    """The pruning decision with the stages' defaults."""
    out = prune.sample_support(expression(s, d), graph.clusters(tx_of(s, d)), samples=SAMPLES)
    return out.select("tx", "cluster_id", "passes", "kept")


@query("dropped_report", _components("shared >= 1", f", {_SCORES}, {_SUPPORT} SELECT tx, cluster_id, cluster_size, 'failed_sample_support' AS reason, 0.0 AS sample_min_rel_expr, 97.0 AS retain_locus_pct, 2 AS min_support_samples, expr_sum, expr_max, round(expr_mean, 6) AS expr_mean FROM dec WHERE NOT kept"))
def dropped_report(s: SparkSession, d: str) -> DataFrame:
    out = prune.sample_support(expression(s, d), graph.clusters(tx_of(s, d)), samples=SAMPLES).filter("not kept")
    return out.select("tx", "cluster_id", "cluster_size", F.lit("failed_sample_support").alias("reason"), F.lit(0.0).alias("sample_min_rel_expr"), F.lit(97.0).alias("retain_locus_pct"), F.lit(2).alias("min_support_samples"), "expr_sum", "expr_max", F.round("expr_mean", 6).alias("expr_mean"))
