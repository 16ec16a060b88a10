"""Clusters of small groups are linked in one task each, with the links and components of all pairs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strandloom import lineage
from strandloom.operators import graph

CHAIN = "array<struct<donor:bigint,acceptor:bigint>>"
MODES = [("any_shared", {}), ("any_shared", {"min_shared": 2}), ("subset", {}), ("jaccard", {"min_jaccard": 0.4}), ("bridge_safe", {}), ("bridge_safe", {"strong": 3, "weak": 0.3})]


def brute(rows, mode, min_shared=1, min_jaccard=0.5, strong=2, weak=0.15):
    label = {t: t for t, *_ in rows}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for t, *g, c in rows:
        for u, *h, d in rows:
            n = len(set(c) & set(d))
            if g != h or None in g or not n:
                continue
            j = n / (len(c) + len(d) - n)
            if {"any_shared": n >= min_shared, "subset": n == min(len(c), len(d)) and n >= min_shared, "jaccard": j >= min_jaccard and n >= min_shared, "bridge_safe": n >= strong or j >= weak}[mode]:
                p, q = root(t), root(u)
                label[max(p, q)] = min(p, q)
    found = [(t, *g, root(t)) for t, *g, _ in rows]
    sizes = [r[-1] for r in found]
    return sorted(((*r, sizes.count(r[-1])) for r in found), key=str)


def some(spark, twice):
    random.seed(11)
    rows = []
    for i in range(90):
        g = i % 6
        at = sorted(random.sample(range(9), random.choice([0, 1, 2, 3, 5])))
        rows.append((f"t{i:02}", f"g{g}" if g < 5 else None, "c", "+-"[g % 2], [(100 * k, 100 * k + 50) for k in at]))
    if twice:  # names on both strands
        rows += [(f"t{i:02}", "g8", "c", "-", [(7, 9 + i // 12)]) for i in (0, 6, 13, 19)]
    return rows, spark.createDataFrame(rows, f"tx string, gene string, chrom string, strand string, chain {CHAIN}")


# All groups in tasks, some of them, none.
CASES = [(m, o, True, most) for m, o in MODES for most in (1000, 30)] + [("bridge_safe", {}, False, most) for most in (1000, 30, 0)]


@pytest.mark.parametrize(("mode", "options", "twice", "most"), CASES)
def test_clusters_equal_all_pairs(spark, mode, options, twice, most, monkeypatch):
    rows, tx = some(spark, twice)
    monkeypatch.setattr(graph, "_PAIRS", 40)
    got = sorted((tuple(r) for r in graph.clusters(tx, mode, most=most, **options).collect()), key=str)
    assert got == brute(rows, mode, **options)


def test_small_groups_need_no_rounds(spark, monkeypatch):
    """What is written: the chains and the (empty) list of large groups, not tables for each round."""
    made, real = [], lineage.cut
    monkeypatch.setattr(graph, "cut", lambda df, name, *rest: made.append(name) or real(df, name, *rest))
    for mode in ("any_shared", "bridge_safe"):
        made.clear()
        assert graph.clusters(some(spark, False)[1], mode).count() == 90
        assert made == ["chains", "large-groups"]
    assert graph.clusters(some(spark, True)[1].filter(F.lit(False))).count() == 0
