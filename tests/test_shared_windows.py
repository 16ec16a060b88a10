"""Junctions meet the genome once for all their windows."""

from __future__ import annotations

import random

from strandloom import lineage
from strandloom.operators import screens


def junctions(spark):
    random.seed(2)
    genome = [("a", "".join(random.choice("ACGT") for _ in range(900))), ("b", "ACGTACGTAC"), ("n", None)]
    rows = [(f"t{i}", 1, c, "+-"[i % 2], c, d, d + i % 90 + 1) for c in ("a", "b", "n", "none") for i, d in enumerate(range(-3, 910, 7))]
    return spark.createDataFrame(rows, "tx string, junction int, chrom string, strand string, contig string, donor long, acceptor long"), spark.createDataFrame(genome, "contig string, seq string")


def test_one_meeting_gives_what_two_give(spark, monkeypatch):
    j, genome = junctions(spark)
    key = lambda df: sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=str)
    want, sides = key(screens.motifs(j, genome)), key(screens.rt_windows(j, genome))
    made, real = [], lineage.cut
    monkeypatch.setattr(screens, "cut", lambda df, name, *rest: made.append(name) or real(df, name, *rest))
    bases, windows = screens.motifs_and_windows(j, genome)
    assert made == ["chunks", "junction-windows"]
    assert key(bases) == want and key(windows) == sides and len(want) == j.count()


def test_windows_in_different_chunks(spark):
    j, genome = junctions(spark)
    both = screens._motif_windows() | screens._rt_sides(1)
    key = lambda df: sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=str)
    assert key(screens.with_windows(j, genome, both, width=64)) == key(screens.with_windows(j, genome, both))
    assert key(screens.with_windows(j, screens.chunked(genome), both)) == key(screens.with_windows(j, genome, both))
