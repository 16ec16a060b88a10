"""Sorted stores by index, corrected junctions, breakpoint groups: against plain loops and by what is opened."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from strandloom.operators import breakpoints, correction, splice
from strandloom.sources import indexed

ROWS = "chrom string, start0 long, end0 long, name string, __x string"


# Store


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", "c"]), s, s + rng.choice([1, 5, 4000]), f"n{i}", None) for i, s in enumerate(rng.choices(range(100_000), k=4000))] + [(None, 5, 9, "lost", None), ("a", None, 9, "lost", None)]
    path = str(tmp_path_factory.mktemp("store") / "s")
    indexed.write_indexed(spark.createDataFrame(rows, ROWS), path, files=12, stripe=100)
    return rows, path


def opened(df):
    return {os.path.basename(f) for f in df.inputFiles()}


def test_a_region_opens_the_files_it_needs(spark, store):
    rows, path = store
    every = opened(indexed.read_sorted(spark, path))
    assert len(every) == 12
    for chrom, lo, hi in (("a", 50_000, 50_400), ("b", 0, 1), ("c", 99_000, 200_000), ("z", 0, 10)):
        df = indexed.scan_region(spark, path, chrom, lo, hi)
        assert sorted(r.name for r in df.collect()) == sorted(r[3] for r in rows if r[0] == chrom and r[1] is not None and r[1] < hi and r[2] > lo)
        assert len(opened(df)) <= 3
        if df.inputFiles():
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "EqualTo(chrom" in plan and "LessThan(start0" in plan
    assert indexed.read_sorted(spark, path).count() == len(rows)


def test_regions_from_a_table(spark, store):
    rows, path = store
    regions = [("a", 10, 40), ("a", 20, 60), ("b", 70_000, 70_100), ("q", 1, 5), (None, 1, 5)]
    got = indexed.scan_regions(spark, path, spark.createDataFrame(regions, "chrom string, start0 long, end0 long"))
    want = [r[3] for r in rows if any(r[0] == c and r[1] is not None and r[1] < e and s < r[2] for c, s, e in regions)]
    assert sorted(r.name for r in got.collect()) == sorted(want)
    assert got.columns == ["chrom", "start0", "end0", "name", "__x"]


def test_index_and_order(spark, store):
    rows, path = store
    index = indexed.index_of(spark, path).collect()
    assert sum(r.n for r in index) == len(rows) and len({(r.file, r.stripe) for r in index}) >= 40
    stored = indexed.read_sorted(spark, path).select("chrom", "start0", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")).collect()
    places = [(r.chrom is None, r.chrom or "", r.start0 is None, r.start0 or 0) for r in sorted(stored, key=lambda r: (r.f, r.i))]
    assert places == sorted(places)


def test_a_hot_place_is_many_files(spark, tmp_path):
    df = spark.range(20_000).select(F.lit("a").alias("chrom"), F.lit(7).cast("long").alias("start0"), F.lit(9).cast("long").alias("end0"), F.col("id").cast("string").alias("name"))
    indexed.write_indexed(df, str(tmp_path / "hot"), files=8)
    sizes = [r["count"] for r in indexed.read_sorted(spark, str(tmp_path / "hot")).groupBy(F.col("_metadata.file_path")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 8000
    indexed.write_indexed(df.limit(0), str(tmp_path / "none"))
    assert indexed.scan_region(spark, str(tmp_path / "none"), "a", 0, 10).count() == 0


# Junctions


def nearest(j, known, most):
    """known: (chrom, strand, donor, acceptor) -> (motif, support)."""
    if j in known:
        return None
    near = [(abs(j[2] - k[2]) + abs(j[3] - k[3]), -s, k[2], k[3]) for k, (m, s) in known.items() if k[:2] == j[:2] and m > 0 and abs(j[2] - k[2]) <= most and abs(j[3] - k[3]) <= most]
    return min(near)[2:] if near else None


@pytest.mark.parametrize("most", [0, 3, 5])
def test_moves_equal_plain_loops(spark, most):
    rng = random.Random(most)
    place = lambda: (rng.choice("ab"), rng.choice("+-"), rng.randrange(100), rng.randrange(100, 200))
    table = [(*place(), rng.randrange(3), rng.randrange(5)) for _ in range(300)]
    known = {}
    for *k, m, s in table:
        had = known.get(tuple(k), (0, 0))
        known[tuple(k)] = (max(had[0], m), had[1] + s)
    own = [place() for _ in range(400)] + [tuple(t[:4]) for t in table[:20]] + [(None, "+", 5, 105), ("a", "+", None, 105)]
    got = correction.moves(spark.createDataFrame(own, "chrom string, strand string, donor long, acceptor long"), spark.createDataFrame(table, "chrom string, strand string, donor long, acceptor long, motif int, unique_reads long"), most).collect()
    want = {j: m for j in set(own) if None not in j and (m := nearest(j, known, most))}
    assert {tuple(r)[:4]: (r.new_donor, r.new_acceptor) for r in got} == want and len(got) == len(want)


def test_chains_are_corrected_whole_or_not_at_all(spark):
    exon = [("near", 0, 98), ("near", 203, 300), ("near", 402, 500), ("known", 0, 100), ("known", 200, 300), ("mono", 5, 50), ("far", 0, 80), ("far", 220, 300), ("short", 0, 100), ("short", 198, 201), ("short", 402, 500)]
    tx = splice.transcripts(spark.createDataFrame([(t, "g", "c", "+", s, e) for t, s, e in exon], "tx string, gene string, chrom string, strand string, start0 long, end0 long"))
    known = spark.createDataFrame([("c", "+", 100, 200), ("c", "+", 300, 400), ("c", "+", 199, 402), ("c", "-", 98, 203)], "chrom string, strand string, donor long, acceptor long")
    got = {r.tx: r for r in correction.correct_junctions(tx, known).collect()}
    assert [tuple(e) for e in got["near"].exons] == [(0, 100), (200, 300), (400, 500)] and (got["near"].n_moved, got["near"].corrected) == (2, True)
    assert got["near"].chain == [(100, 200), (300, 400)]
    # Its first junction would move to 200, its second to 199: no base would be left between them.
    assert (got["short"].n_moved, got["short"].corrected) == (2, False) and [tuple(e) for e in got["short"].exons] == [(0, 100), (198, 201), (402, 500)]
    for t in ("known", "mono", "far"):
        assert (got[t].n_moved, got[t].corrected) == (0, False)
    assert correction.correct_junctions(tx.limit(0), known).count() == 0 and correction.correct_junctions(tx, known.limit(0)).filter("corrected").count() == 0


# Breakpoints

POINT = "chrom_a string, strand_a string, chrom_b string, strand_b string, pos_a long, pos_b long"


@pytest.mark.parametrize(("most", "seed"), [(0, 1), (3, 2), (10, 3), (25, 4)])
def test_groups_equal_all_pairs(spark, most, seed):
    rng = random.Random(seed)
    pts = [(rng.choice("ab"), "+", "b", rng.choice("+-"), rng.randrange(-100, 300), rng.randrange(300)) for _ in range(700)] + [(None, "+", "b", "+", 1, 1), ("a", "+", "b", "+", None, 1)]
    pts += [("z", "+", "z", "+", 26 * k, -26 * k + (k % 2)) for k in range(40)]  # corner to corner, downwards
    pts += [("y", "+", "z", "+", 11 * k, 11 * k) for k in range(40)]
    own = sorted({p for p in pts if None not in p})
    root = {p: p for p in own}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, p in enumerate(own):
        for q in own[i + 1 :]:
            if p[:4] == q[:4] and abs(p[4] - q[4]) <= most and abs(p[5] - q[5]) <= most:
                root[find(p)] = find(q)
    got = {tuple(r)[:6]: r.group for r in breakpoints.grouped(spark.createDataFrame(pts, POINT), most).collect()}
    assert set(got) == set(own)
    assert len({(find(p), got[p]) for p in own}) == len({find(p) for p in own}) == len(set(got.values()))


def test_a_hot_cell_makes_no_pairs(spark):
    """A million reads of one break in a thousand places: a cell, and no edge."""
    df = spark.range(200_000).select(F.lit("a").alias("chrom_a"), F.lit("+").alias("strand_a"), F.lit("b").alias("chrom_b"), F.lit("+").alias("strand_b"), (F.col("id") % 900).alias("pos_a"), (F.col("id") % 37).alias("pos_b"))
    assert breakpoints.grouped(df, 1000).select("group").distinct().count() == 1


READ = "read_id string, sample string, flag int, chrom string, pos long, cigar string, mapq int, sa string, nm long"


def test_pieces_and_their_breaks(spark):
    rows = [
        ("fwd", "s", 0, "c1", 100, "50M1000N50M40S", 60, "c2,501,-,40M100S,30,4;", 2),  # the second piece is the read's end, reversed
        ("rev", "s", 16, "c1", 100, "40S60M", 20, "c1,5001,-,40M60H,60,0;", 0),  # both reversed: the larger place comes first
        ("three", "s", 0, "c1", 0, "30M70S", 60, "c2,11,+,30S30M40S,60,0;c3,21,+,60S40M,60,1;", None),
        ("again", "s", 2048, "c1", 0, "30M70S", 60, "c2,11,+,30S70M,60,0;", 0),
        ("plain", "s", 0, "c1", 0, "30M", 60, None, 0),
        ("odd", "s", 0, "c1", 0, "30M70S", 60, "broken;c2,x,+,30S70M,60,0;", 0),
    ]
    pieces = breakpoints.segments(spark.createDataFrame(rows, READ))
    got = {(r.read_id, r.chrom, r.query_start): r for r in pieces.collect()}
    assert (got["fwd", "c1", 0].end0, got["fwd", "c2", 100].query_end, got["rev", "c1", 0].query_end) == (1200, 140, 60)
    assert got["fwd", "c1", 0].identity == pytest.approx(0.98) and got["three", "c1", 0].identity is None
    brk = {(r.read_id, r.chrom_a, r.chrom_b): (r.strand_a, r.pos_a, r.strand_b, r.pos_b, r.mapq) for r in breakpoints.breakpoints(pieces).collect()}
    assert brk["three", "c1", "c2"] == ("+", 29, "+", 10, 60) and brk["three", "c2", "c3"] == ("+", 39, "+", 20, 60)
    assert brk["rev", "c1", "c1"] == ("-", 100, "-", 5039, 20)
    assert not any(k[0] in ("again", "plain") for k in brk)


def test_groups_are_judged(spark):
    def reads(name, n, a, b, mapq=60, identity=0.99, chrom_b="c2", strand_b="+"):
        return [(f"{name}{i}", "s1" if i % 2 else "s2", "c1", "+", chrom_b, strand_b, a + i, b + i, mapq, identity) for i in range(n)]

    rows = reads("good", 5, 1000, 2000) + reads("lone", 1, 50_000, 90_000) + reads("weak", 4, 100_000, 200_000, mapq=3, identity=0.8) + reads("near", 3, 300_000, 320_000, chrom_b="c1")
    breaks = spark.createDataFrame(rows, "read_id string, sample string, chrom_a string, strand_a string, chrom_b string, strand_b string, pos_a long, pos_b long, mapq int, identity double")
    found, members = breakpoints.groups(breaks, 100)
    genes = spark.createDataFrame([("A", "c1", "+", 900, 1100), ("A2", "c1", "+", 1004, 1100), ("B", "c2", "+", 1900, 2100), ("B2", "c2", "+", 1950, 2300), ("B3", "c2", "+", 1990, 2300), ("OFF", "c2", "-", 0, 10**6)], "gene string, chrom string, strand string, start0 long, end0 long")
    named = breakpoints.with_genes(members, genes)
    total = spark.createDataFrame([("A", 400), ("B", 10_000)], "gene string, n long")
    got = {(r.pos_a // 1000): r for r in breakpoints.judged(found, named, total, max_genes_in_event=4).collect()}
    assert list(got[1].genes_a) == ["A"] and list(got[1].genes_b) == ["B", "B2", "B3"]  # one read in five is not a quarter
    assert (got[1].n_reads, got[1].n_samples, got[1].pos_a, got[1].variability) == (5, 2, 1000, 2.0)
    assert list(got[1].reasons) == ["fraction"] and got[1].quality == "LOW"
    assert list(got[50].reasons) == ["coverage"] and list(got[100].reasons) == ["identity", "mapq"] and list(got[300].reasons) == ["readthrough"]
    kind = {(r.pos_a // 1000): (r.quality, list(r.reasons)) for r in breakpoints.judged(found, named, prom_filter=2).collect()}
    assert kind[1] == ("LOW", ["genes", "promiscuous"])
    assert {(r.pos_a // 1000): r.quality for r in breakpoints.judged(found).collect()}[1] == "MEDIUM"
    empty, none = breakpoints.groups(breaks.limit(0))
    assert empty.count() == none.count() == breakpoints.judged(empty).count() == 0


@pytest.mark.parametrize("most", [0, 1, 5])
def test_a_junction_meets_few_cells(spark, most):
    rows = spark.range(4000).selectExpr("id * 7 % 4001 as donor", "id * 13 % 3989 - 500 as acceptor")
    n = correction._around(rows, most).count()
    assert 4000 <= n <= 2.4 * 4000
    near = F.explode(F.sequence(F.lit(-most), F.lit(most)))
    moved = rows.select("donor", "acceptor", near.alias("x")).select("donor", "acceptor", (F.col("donor") + F.col("x")).alias("kd"), (F.col("acceptor") - F.col("x")).alias("ka"))
    met = correction._around(moved, most).filter((F.col("bd") == correction._cell(F.col("kd"), most)) & (F.col("ba") == correction._cell(F.col("ka"), most)))
    assert met.count() == 4000 * (2 * most + 1)  # each place within reach by one of the cells
