"""Genes of very many isoforms: what is compared stays near what is found; and all modes against plain pairs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strandloom.operators import containment, graph

CHAIN = "array<struct<donor:bigint,acceptor:bigint>>"
TX = f"tx long, gene string, chrom string, strand string, chain {CHAIN}, lo long, hi long"


def table(spark, chains, gene="g"):
    return spark.createDataFrame([(i, gene, "c", "+", [(j, j + 5) for j in c], 0, 10**6) for i, c in enumerate(chains)], TX)


def test_a_gene_of_20000_isoforms_with_one_first_junction(spark):
    """Chains (0, k, 10**6 + k) and (0, k): each of the latter lies in one of the former. By the shared junction, 20,000 x 10,000 pairs would meet."""
    n = 10_000
    junction = lambda c: F.struct(c.cast("bigint").alias("donor"), (c + 5).cast("bigint").alias("acceptor"))
    k = F.col("id") % n + 10
    chain = F.when(F.col("id") < n, F.array(junction(F.lit(0)), junction(k))).otherwise(F.array(junction(F.lit(0)), junction(k), junction(k + 10**6)))
    tx = spark.range(2 * n).select(F.col("id").alias("tx"), F.lit("g").alias("gene"), F.lit("c").alias("chrom"), F.lit("+").alias("strand"), chain.alias("chain"), F.lit(0).cast("long").alias("lo"), F.lit(10**7).cast("long").alias("hi"))
    c, p = (tx.select(*(F.col(x).alias(f"{side}_{x}") for x in tx.columns)) for side in ("c", "p"))
    assert containment.runs_of(c, p).count() == n  # pairs compared: one a child
    edges = containment.containment(tx)
    assert edges.count() == n and edges.filter("parent <> child + 10000").count() == 0
    apart = containment.containment(tx, terminal_only=False)
    assert apart.count() == n and apart.filter("parent <> child + 10000").count() == 0


def test_nested_chains_have_one_smallest_superset_each(spark):
    edges = containment.containment(table(spark, [range(10, 10 + k) for k in range(1, 120)]))
    assert edges.count() == 118 and edges.filter("parent <> child + 1 or extra <> 1").count() == 0


@pytest.mark.parametrize("terminal", [True, False])
@pytest.mark.parametrize("minimal", [True, False])
def test_containment_equals_plain_pairs(spark, terminal, minimal):
    rng = random.Random(3)
    chains = [sorted(rng.sample(range(0, 120, 10), rng.choice([0, 1, 1, 2, 3, 4, 6]))) for _ in range(120)]
    got = {(r.child, r.parent, r.extra) for r in containment.containment(table(spark, chains), terminal, minimal).collect()}
    inside = lambda a, b: any(b[i : i + len(a)] == a for i in range(len(b) - len(a) + 1)) if terminal else set(a) <= set(b)
    want = {(i, k, len(b) - len(a)) for i, a in enumerate(chains) for k, b in enumerate(chains) if len(b) > len(a) and inside(a, b)}
    if minimal:
        least = {}
        for i, _, e in want:
            least[i] = min(e, least.get(i, e))
        want = {x for x in want if x[2] == least[x[0]]}
    assert got == want


def brute_clusters(chains, link):
    root = list(range(len(chains)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(chains)):
        for k in range(i):
            a, b = set(chains[i]), set(chains[k])
            if a & b and link(len(a & b), len(a), len(b)):
                x, y = find(i), find(k)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in range(len(chains))}


MODES = [
    ("any_shared", {"min_shared": 2}, lambda s, a, b: s >= 2),
    ("subset", {}, lambda s, a, b: s == min(a, b)),
    ("subset", {"min_shared": 3}, lambda s, a, b: s == min(a, b) and s >= 3),
    ("jaccard", {}, lambda s, a, b: s / (a + b - s) >= 0.5),
    ("jaccard", {"min_jaccard": 0.3, "min_shared": 2}, lambda s, a, b: s / (a + b - s) >= 0.3 and s >= 2),
    ("bridge_safe", {}, lambda s, a, b: s >= 2 or s / (a + b - s) >= 0.15),
    ("bridge_safe", {"strong": 4, "weak": 0.6}, lambda s, a, b: s >= 4 or s / (a + b - s) >= 0.6),
]


@pytest.mark.parametrize(("mode", "options", "link"), MODES)
def test_clusters_equal_plain_pairs(spark, mode, options, link):
    rng = random.Random(len(mode) + len(options))
    chains = [sorted(rng.sample(range(0, 600, 10), rng.choice([0, 1, 2, 3, 5, 8]))) for _ in range(150)]
    chains += [sorted({0, 10, *rng.sample(range(1000, 2000, 10), 3)}) for _ in range(40)] + chains[:20]
    got = {r.tx: r.cluster_id for r in graph.clusters(table(spark, chains), mode, **options).collect()}
    assert got == brute_clusters(chains, link)


@pytest.mark.parametrize(("mode", "options"), [("jaccard", {}), ("subset", {}), ("any_shared", {"min_shared": 2})])
def test_a_common_junction_makes_few_candidates(spark, mode, options):
    """3,000 sets that share one junction and little else: n * (n - 1) / 2 is 4.5 million."""
    rng = random.Random(7)
    chains = [sorted({0, *rng.sample(range(10, 60_000, 10), 3)}) for _ in range(3000)]
    base = table(spark, chains).select("tx", *graph.GROUP, F.array_sort("chain").alias("chain"))
    assert graph.candidate_pairs(base, mode, **options).count() < 10_000


def test_a_cluster_of_very_many_is_ranked_in_ranges(spark):
    """One cluster with most rows, many ties among them: the same as by a window, from more than one task."""
    from pyspark.sql.window import Window

    from strandloom.operators import numbering, prune

    n = 60_000
    rows = spark.range(n).select(F.col("id").alias("tx"), F.when(F.col("id") % 10 == 0, F.col("id") % 97).otherwise(-1).alias("cluster_id"), (F.col("id") % 211 * (F.col("id") % 3)).cast("double").alias("score"))
    rows = rows.withColumn("value", F.col("score")).withColumn("sample", F.lit(0))
    by = Window.partitionBy("cluster_id").orderBy(F.desc("score"), "tx")
    want = {r.tx: (r.rank, r.kept) for r in rows.withColumn("rank", F.row_number().over(by)).withColumn("n", F.count("*").over(Window.partitionBy("cluster_id"))).withColumn("kept", F.col("rank") <= F.ceil(F.lit(0.8) * F.col("n"))).collect()}
    ranked = numbering.running(rows, ["cluster_id"], [F.desc("score"), F.asc("tx")], {"s": F.col("score")}, most=5000)
    got = ranked.collect()
    assert {r.tx: r["rank"] for r in got} == {t: k for t, (k, _) in want.items()}
    before = {}
    for r in sorted(got, key=lambda r: (r.cluster_id, r["rank"])):
        assert r.before_s == before.get(r.cluster_id, 0.0)
        before[r.cluster_id] = r.before_s + r.score
    assert all(before[r.cluster_id] == r.total_s for r in got)
    pieces = numbering.ranged(rows.filter("cluster_id = -1"), ["cluster_id"], [F.desc("score"), F.asc("tx")], {})
    assert pieces.count() == n * 9 // 10
    for most in (5000, 10**6):
        assert {r.tx: r.kept for r in prune.keep_percentile(rows, 80.0, most=most).collect()} == {t: k for t, (_, k) in want.items()}
    summed = prune.cumulative_keep(rows, 0.5, most=5000).filter("kept").groupBy("cluster_id").count().collect()
    assert {r.cluster_id: r["count"] for r in summed} == {r.cluster_id: r["count"] for r in prune.cumulative_keep(rows, 0.5).filter("kept").groupBy("cluster_id").count().collect()}
    assert numbering.running(rows.limit(0), ["cluster_id"], [F.asc("tx")], {"s": F.col("score")}).count() == 0
