"""Pruning by sample support brings a cluster together once; large clusters are spread and give the same rows."""

from __future__ import annotations

import random

import pytest

from strandloom import lineage
from strandloom.operators import prune


def table(spark, seed=4):
    random.seed(seed)
    rows = [(f"t{i:03}", i * i % 7 if i % 9 else None, 1) for i in range(120)]
    rows += [("t003", 9 % 7, 1), ("t004", 16 % 7, 1)]  # repeated rows
    expr = [(f"t{i:03}", s, random.choice([0.0, 0.0, 1.0, 5.0, 30.0, None, -2.0])) for i in range(118) for s in range(4) if random.random() < 0.7]
    expr += [("t010", 1, 4.0), ("t010", 1, 2.0), ("t011", 77, 3.0), ("t012", None, 8.0)]
    return spark.createDataFrame(expr, "tx string, sample int, value double"), spark.createDataFrame(rows, "tx string, cluster_id int, cluster_size int")


@pytest.mark.parametrize("options", [{}, {"min_rel": 0.3}, {"min_rel": 0.5, "pct": None}, {"pct": 60.0, "min_samples": 3, "min_keep": 2}])
def test_clusters_in_one_task_and_spread_ones_agree(spark, options):
    expr, clusters = table(spark)
    if options.get("min_keep") == 2:  # of repeated rows, spread ones would be repeated again
        clusters = clusters.distinct()
    options = {"samples": [0, 1, 2, 3]} | options
    key = lambda df: sorted((str(sorted(r.asDict().items(), key=str)) for r in df.collect()))
    whole = prune.sample_support(expr, clusters, **options)
    assert whole.columns == [*clusters.columns, "expr_sum", "expr_max", "expr_mean", "score", "passes", "kept"]
    want = key(prune.sample_support(expr, clusters, most=0, **options))
    assert key(whole) == want and len(want) > 100
    assert key(prune.sample_support(expr, clusters, most=16, **options)) == want


def test_small_clusters_are_written_once(spark, monkeypatch):
    """The scored rows and the (empty) list of large clusters are written; the values, four a transcript, are not."""
    made, real = [], lineage.cut
    monkeypatch.setattr(prune, "cut", lambda df, name, *rest: made.append(name) or real(df, name, *rest))
    expr, clusters = table(spark)
    assert prune.sample_support(expr, clusters, samples=[0, 1, 2, 3]).count() > 100
    assert made == ["scored", "large-clusters"]
