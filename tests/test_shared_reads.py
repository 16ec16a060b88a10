"""What queries read, and how often: a step's input is gathered once and shared."""

from __future__ import annotations

import pytest

from strandloom.operators import alignments
from strandloom.operators.levels import filed, level_join
from strandloom.plans import fixtures, screening


@pytest.mark.parametrize("name", ["anti_by_id", "filter_totals", "semi_by_id", "fail_union"])
def test_screens_share_the_transcripts(spark, sf_dir, monkeypatch, name):
    """All screens and the query itself read line items once (seven times before)."""
    seen, read = [], fixtures.read
    monkeypatch.setattr(fixtures, "read", lambda s, d, table: seen.append(table) or read(s, d, table))
    screening.QUERIES[name](spark, sf_dir)
    assert seen.count("lineitem") == 1


def test_semi_joins_by_levels_do_not_join_rows_back(spark):
    """Each row that meets something once, repeated rows each, without a join of all rows with their numbers."""
    a = spark.createDataFrame([("c", 0, 10, "x"), ("c", 0, 10, "x"), ("c", 5, 9000, "y"), ("c", 50, 60, "z"), (None, 0, 10, "n")], "chrom string, start0 long, end0 long, name string")
    b = spark.createDataFrame([("c", 3, 8), ("c", 7, 9), ("c", 8000, 8500)], "chrom string, start0 long, end0 long")
    got = level_join(filed(a), filed(b), how="left_semi")
    assert sorted(r.name for r in got.collect()) == ["x", "x", "y"] and got.columns == a.columns
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, (__id" not in plan and "Join LeftSemi, (__id" not in plan


def test_variants_read_alignments_once(spark, monkeypatch):
    """Depth and mismatches come from one pass over the reads (each had its own before); a read's odd strings show nothing."""
    rows = [("s", "c", 0, 5, "2S4M3N2M1D2M", "AACGTTGGTT", "1A4^C2"), ("s", "c", 0, 5, "*", "ACGT", "4"), ("s", "c", 0, 5, None, "ACGT", None), ("s", "c", 0, 7, "3M", None, "0A2"), ("s", "c", 4, 7, "3M", "AAA", "3")]
    reads = spark.createDataFrame(rows, "sample string, chrom string, flag int, pos long, cigar string, seq string, md string")
    made, cut = [], alignments.cut
    monkeypatch.setattr(alignments, "cut", lambda df, name, *rest: made.append((name, df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow"))) or cut(df, name, *rest))
    got = alignments.snp_table(reads, 1, 1)
    assert [n for n, scans in made if scans] == ["shown"] and dict(made)["shown"] == 1
    assert [(r.pos, r.ref, r.alt, r.depth, r.reads2) for r in got.collect()] == [(6, "A", "G", 1, 1)]
    assert sorted((r.start0, r.end0) for r in alignments.aligned_blocks(reads).collect()) == [(5, 9), (7, 10), (12, 14), (15, 17)]
