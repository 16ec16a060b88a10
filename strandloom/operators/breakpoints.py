"""Breakpoints of split alignments, their groups by proximity of both ends, and what makes a group a likely fusion.

A read that aligns in pieces (its primary alignment and those listed in its SA tag) has a breakpoint between each two
pieces that follow one another along the read. Two breakpoints of the same two chromosomes and strands are linked if both
their ends lie within ``max_distance``; groups are what links connect.

No pairs of reads are made. Reads with the same breakpoint count together. Places are filed in square cells of
``max_distance`` + 1 bases: all in one cell are linked anyway; cells side by side are linked if their extremes are near
enough; and cells corner to corner by those places alone that no other place of the cell beats in both directions, of which
a cell has at most as many as it has bases along a side. Components of cells are the groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.lineage import cut

from .alignments import cigar_ops
from .graph import components
from .intervals import interval_join
from .reads import REVERSE, SECONDARY, SUPPLEMENTARY, UNMAPPED

KIND = ("chrom_a", "strand_a", "chrom_b", "strand_b")


def _sum_of(ops: Column, *kinds: str) -> Column:
    return F.aggregate(ops, F.lit(0).cast("bigint"), lambda a, x: a + F.when(x["op"].isin(*kinds), x["n"]).otherwise(F.lit(0)))


def segments(reads: DataFrame) -> DataFrame:
    """Pieces of reads with an SA tag: read_id, sample, chrom, strand, start0, end0, query_start, query_end, mapq, identity.

    reads: flag, chrom, pos, cigar, mapq, sa (the tag: name,position,strand,CIGAR,quality,edits;...) and nm (edits of the
    primary alignment, or null). Query places count along the read as it was sequenced. identity: 1 less the edits by
    aligned and inserted bases; null without edits. Only primary records count, so no piece comes twice.
    """
    first = reads.filter((F.col("flag").bitwiseAND(UNMAPPED | SECONDARY | SUPPLEMENTARY) == 0) & F.col("sa").isNotNull() & F.col("chrom").isNotNull())
    others = F.transform(F.filter(F.split("sa", ";"), lambda x: F.size(F.split(x, ",")) >= 6), lambda x: F.split(x, ","))
    piece = lambda chrom, strand, pos, cigar, mapq, nm: F.struct(chrom.alias("chrom"), strand.alias("strand"), pos.alias("start0"), cigar.alias("cigar"), mapq.alias("mapq"), nm.alias("nm"))
    strand = F.when(F.col("flag").bitwiseAND(REVERSE) != 0, "-").otherwise("+")
    own = F.array(piece(F.col("chrom"), strand, F.col("pos").cast("bigint"), F.col("cigar"), F.col("mapq").cast("int"), F.col("nm").cast("bigint")))
    rest = F.transform(others, lambda x: piece(x[0], x[2], x[1].try_cast("bigint") - 1, x[3], x[4].try_cast("int"), x[5].try_cast("bigint")))
    rows = first.select("read_id", "sample", F.explode(F.concat(own, rest)).alias("p")).select("read_id", "sample", "p.*").withColumn("ops", cigar_ops(F.col("cigar"))).filter(F.size("ops") > 0)
    clip = lambda k: F.when(F.element_at("ops", k)["op"].isin("S", "H"), F.element_at("ops", k)["n"]).otherwise(F.lit(0)).cast("bigint")
    lead = F.when(F.col("strand") == "-", clip(-1)).otherwise(clip(1))
    used = _sum_of(F.col("ops"), "M", "I", "=", "X")
    edits = F.when(used > 0, 1 - F.col("nm") / used)
    return rows.select("read_id", "sample", "chrom", "strand", "start0", (F.col("start0") + _sum_of(F.col("ops"), "M", "D", "N", "=", "X")).alias("end0"), lead.alias("query_start"), (lead + used).alias("query_end"), "mapq", edits.alias("identity"))


def breakpoints(pieces: DataFrame) -> DataFrame:
    """Breakpoints between neighbouring pieces of a read: KIND, pos_a (where the first piece ends, along the read), pos_b (where the next begins), read_id, sample, mapq, identity (the lower of both).

    Positions are those of the last base before, and the first after the break. Pieces go by where they begin in the read.
    """
    order = Window.partitionBy("sample", "read_id").orderBy("query_start", "query_end", "chrom", "start0", "strand")
    cols = ["chrom", "strand", "start0", "end0", "mapq", "identity"]
    rows = pieces.select("read_id", "sample", *cols, F.lead(F.struct(*cols)).over(order).alias("n")).filter("n is not null")
    leaves = F.when(F.col("strand") == "-", F.col("start0")).otherwise(F.col("end0") - 1)
    enters = F.when(F.col("n.strand") == "-", F.col("n.end0") - 1).otherwise(F.col("n.start0"))
    return rows.select(F.col("chrom").alias("chrom_a"), F.col("strand").alias("strand_a"), F.col("n.chrom").alias("chrom_b"), F.col("n.strand").alias("strand_b"), leaves.alias("pos_a"), enters.alias("pos_b"), "read_id", "sample", F.least("mapq", "n.mapq").alias("mapq"), F.least("identity", "n.identity").alias("identity"))


def _pair(a: DataFrame, b: DataFrame, dx: int, dy: int) -> DataFrame:
    """Rows of ``a`` beside those of ``b`` in the cell (x + dx, y + dy) of the same kind; columns of b with prefix b_."""
    right = b.select(*(F.col(c).alias(f"b_{c}") for c in b.columns))
    on = (F.col("x") + dx == F.col("b_x")) & (F.col("y") + dy == F.col("b_y"))
    for k in KIND:
        on &= F.col(k) == F.col(f"b_{k}")
    return a.join(right, on)


def _corner(places: DataFrame, up: int) -> DataFrame:
    """Places of a cell that none beats towards larger a and (up = 1) larger or (up = -1) smaller b."""
    ahead = Window.partitionBy(*KIND, "x", "y").orderBy(F.desc("pos_a"), F.desc(F.col("pos_b") * up)).rowsBetween(Window.unboundedPreceding, -1)
    return places.withColumn("__best", F.max(F.col("pos_b") * up).over(ahead)).filter(F.col("__best").isNull() | (F.col("pos_b") * up > F.col("__best"))).drop("__best")


def _opposite(places: DataFrame, up: int) -> DataFrame:
    """The same, towards smaller a."""
    ahead = Window.partitionBy(*KIND, "x", "y").orderBy("pos_a", F.col("pos_b") * up).rowsBetween(Window.unboundedPreceding, -1)
    return places.withColumn("__best", F.min(F.col("pos_b") * up).over(ahead)).filter(F.col("__best").isNull() | (F.col("pos_b") * up < F.col("__best"))).drop("__best")


def grouped(points: DataFrame, max_distance: int = 1000) -> DataFrame:
    """Distinct (KIND, pos_a, pos_b) of ``points`` with ``group``, a number shared by those that links connect.

    Rows with a null in any of the six are in no group and go. The group's number is that of its first cell; it is the
    same however the rows are dealt, but differs with ``max_distance``.
    """
    side = max_distance + 1
    cell = lambda c: F.floor(F.col(c) / side)
    places = points.select(*KIND, "pos_a", "pos_b").dropna().distinct().withColumns({"x": cell("pos_a"), "y": cell("pos_b")})
    places = cut(places.withColumn("cell", F.xxhash64(*KIND, "x", "y")), "places")
    cells = cut(places.groupBy(*KIND, "x", "y", "cell").agg(*(f(c).alias(f"{n}_{c}") for c in ("pos_a", "pos_b") for n, f in (("least", F.min), ("most", F.max)))), "cells")
    edge = (F.col("cell").alias("a"), F.col("b_cell").alias("b"))
    # Side by side, one direction is near in any case.
    edges = _pair(cells, cells, 1, 0).filter(F.col("b_least_pos_a") - F.col("most_pos_a") <= max_distance).select(*edge)
    edges = edges.unionByName(_pair(cells, cells, 0, 1).filter(F.col("b_least_pos_b") - F.col("most_pos_b") <= max_distance).select(*edge))
    for up in (1, -1):
        near = (F.col("b_pos_a") - F.col("pos_a") <= max_distance) & ((F.col("b_pos_b") - F.col("pos_b")) * up <= max_distance)
        edges = edges.unionByName(_pair(_corner(places, up), _opposite(places, up), 1, up).filter(near).select(*edge).distinct())
    found = components(edges)
    return places.join(found, F.col("cell") == F.col("node"), "left").select(*KIND, "pos_a", "pos_b", F.coalesce("component", "cell").alias("group"))


def groups(breaks: DataFrame, max_distance: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Groups of ``breakpoints`` and their members.

    Groups: group, KIND, n_reads, n_samples, pos_a and pos_b (the most frequent pair, ties to the smallest), variability
    (mean distance of both ends from them), mean_mapq, mean_identity. Members: the breakpoints with their group.
    """
    placed = cut(grouped(breaks, max_distance), "breakpoint-groups")
    same = F.lit(True)
    for c in (*KIND, "pos_a", "pos_b"):
        same &= F.col(c) == F.col(f"g_{c}")
    members = cut(breaks.join(placed.select(*(F.col(c).alias(f"g_{c}") for c in (*KIND, "pos_a", "pos_b")), "group"), same).select("group", *breaks.columns), "members")
    counts = members.groupBy("group", *KIND, "pos_a", "pos_b").agg(F.count("*").alias("n"))
    centre = counts.groupBy("group").agg(F.max_by(F.struct("pos_a", "pos_b"), F.struct("n", (-F.col("pos_a")).alias("a"), (-F.col("pos_b")).alias("b"))).alias("c")).select(F.col("group").alias("g"), F.col("c.pos_a").alias("centre_a"), F.col("c.pos_b").alias("centre_b"))
    centre = cut(centre, "centres")
    far = (F.abs(F.col("pos_a") - F.col("centre_a")) + F.abs(F.col("pos_b") - F.col("centre_b"))) / 2
    out = members.join(centre, F.col("group") == F.col("g")).groupBy("group", *KIND).agg(
        F.count_distinct("sample", "read_id").alias("n_reads"), F.count_distinct("sample").alias("n_samples"), F.first("centre_a").alias("pos_a"), F.first("centre_b").alias("pos_b"), F.avg(far).alias("variability"), F.avg("mapq").alias("mean_mapq"), F.avg("identity").alias("mean_identity"),
    )
    return out, members


def with_genes(members: DataFrame, genes: DataFrame, min_read_fraction: float = 0.25) -> DataFrame:
    """group, genes_a and genes_b: genes (gene, chrom, strand, start0, end0) that hold an end of at least that fraction of the group's reads, sorted."""
    ends = lambda e: members.select("group", "sample", "read_id", F.lit(e).alias("end"), F.col(f"chrom_{e}").alias("chrom"), F.col(f"strand_{e}").alias("strand"), F.col(f"pos_{e}").alias("start0"), (F.col(f"pos_{e}") + 1).alias("end0"))
    # Distinct places meet the genes; reads come back by place.
    rows = cut(ends("a").unionByName(ends("b")), "ends")
    held = interval_join(rows.select("chrom", "strand", "start0", "end0").distinct(), genes, keys=("chrom", "strand"), width=1 << 16).select(F.col("a_chrom").alias("c"), F.col("a_strand").alias("s"), F.col("a_start0").alias("p"), F.col("b_gene").alias("gene"))
    hits = rows.join(held, (F.col("chrom") == F.col("c")) & (F.col("strand") == F.col("s")) & (F.col("start0") == F.col("p")))
    n = hits.groupBy("group", "end", "gene").agg(F.count_distinct("sample", "read_id").alias("n"))
    total = members.groupBy(F.col("group").alias("g")).agg(F.count_distinct("sample", "read_id").alias("total"))
    kept = n.join(total, F.col("group") == F.col("g")).filter(F.col("n") >= min_read_fraction * F.col("total"))
    of = lambda e: F.array_sort(F.collect_set(F.when(F.col("end") == e, F.col("gene")))).alias(f"genes_{e}")
    return kept.groupBy("group").agg(of("a"), of("b"))


def judged(
    found: DataFrame,
    genes: DataFrame | None = None,
    gene_reads: DataFrame | None = None,
    min_coverage: int = 2,
    min_mean_identity: float = 0.93,
    min_mean_mapq: float = 10,
    max_variability: float = 1000,
    max_readthrough: int = 100_000,
    max_genes_in_event: int = 3,
    min_fusion_fraction: float = 0.01,
    prom_filter: int = 8,
) -> DataFrame:
    """``groups`` (with the columns of ``with_genes``, where given) with reasons (sorted names of the tests that fail) and quality: MEDIUM without any, else LOW.

    coverage, identity, mapq, variability; readthrough: both ends on one chromosome and strand in order, closer than
    ``max_readthrough``; genes: more than ``max_genes_in_event``; promiscuous: a gene with more than ``prom_filter``
    partners over all groups (0: not tested); fraction: fewer reads than that share of its genes' reads (gene, n).
    A mean that is null passes its test.
    """
    rows = found
    none = F.array().cast("array<string>")
    if genes is None:
        rows = rows.withColumns({"genes_a": none, "genes_b": none})
    else:
        rows = rows.join(genes.withColumnRenamed("group", "g"), F.col("group") == F.col("g"), "left").drop("g").withColumns({c: F.coalesce(c, none) for c in ("genes_a", "genes_b")})
        rows = rows.withColumns({c: F.transform(c, lambda x: x.cast("string")) for c in ("genes_a", "genes_b")})
    forward = F.when(F.col("strand_a") == "-", F.col("pos_a") - F.col("pos_b")).otherwise(F.col("pos_b") - F.col("pos_a"))
    tests = {
        "coverage": F.col("n_reads") < min_coverage, "identity": F.col("mean_identity") < min_mean_identity, "mapq": F.col("mean_mapq") < min_mean_mapq, "variability": F.col("variability") > max_variability,
        "readthrough": (F.col("chrom_a") == F.col("chrom_b")) & (F.col("strand_a") == F.col("strand_b")) & (forward > 0) & (forward < max_readthrough), "genes": F.size(F.array_union("genes_a", "genes_b")) > max_genes_in_event,
    }
    rows = cut(rows, "judged")
    each = rows.select("group", "n_reads", F.explode(F.array_union("genes_a", "genes_b")).alias("gene"))
    if prom_filter:
        pairs = rows.select(F.explode("genes_a").alias("a"), "genes_b").select("a", F.explode("genes_b").alias("b")).filter("a <> b")
        partners = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy(F.col("a").alias("h")).agg(F.count_distinct("b").alias("n")).filter(F.col("n") > prom_filter)
        busy = each.join(partners, F.col("gene") == F.col("h"), "left_semi").select(F.col("group").alias("busy")).distinct()
        rows = rows.join(busy, F.col("group") == F.col("busy"), "left")
        tests["promiscuous"] = F.col("busy").isNotNull()
    if gene_reads is not None:
        totals = gene_reads.groupBy(F.col("gene").cast("string").alias("h")).agg(F.sum("n").alias("n"))
        small = each.join(totals, F.col("gene") == F.col("h")).groupBy(F.col("group").alias("small"), "n_reads").agg(F.max("n").alias("n")).filter(F.col("n_reads") < min_fusion_fraction * F.col("n")).select("small")
        rows = rows.join(small, F.col("group") == F.col("small"), "left")
        tests["fraction"] = F.col("small").isNotNull()
    reasons = F.filter(F.array(*(F.when(t, F.lit(k)) for k, t in sorted(tests.items()))), lambda x: x.isNotNull())
    rows = rows.withColumn("reasons", reasons)
    return rows.withColumn("quality", F.when(F.size("reasons") == 0, "MEDIUM").otherwise("LOW")).drop("busy", "small")
