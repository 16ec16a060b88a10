"""Connected components, and the transcript clusters that shared junctions make."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from strandloom.functions.coords import safe_fraction
from strandloom.lineage import Observation, cut, forget

GROUP = ("gene", "chrom", "strand")
MODES = ("any_shared", "subset", "jaccard", "bridge_safe", "exact")


#: Up to so many edges, the minima of their ends are broadcast; beyond, they are written and joined by shuffle.
BROADCAST_EDGES = 100_000


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): (node, component), component = smallest id.

    Alternates the large-star and small-star steps until a round changes nothing, which the write of its edges tells (by
    their number and checksums). Each step is a grouped minimum, combined on the map side, and an equi-join with it. The
    edges' number is known from their write: few minima are broadcast, many are written first, so that the join has a
    shuffle of its own whose hot keys Spark splits. So a hub with very many neighbours never has to fit into one task. A
    round's tables go when the next one is written. Nodes are of any type with an order. Empty edges give no rows;
    self-loops, nulls and repeated edges are ignored.
    """
    sums = (F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.bit_xor(F.xxhash64("v", "u")).alias("y"))
    seen = Observation()
    e = cut(edges.filter("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges", (seen, *sums))
    before = seen.get
    for _ in range(max_rounds):
        if not before.get("n"):
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        few, used = before["n"] <= BROADCAST_EDGES, [e]

        def lowest(rows: DataFrame, few: bool = few, used: list = used) -> DataFrame:
            low = rows.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
            if few:
                return F.broadcast(low)
            used.append(cut(low, "lows"))
            return used[-1]

        # Large star: every neighbour above a node hangs on the smallest around it (the node itself included).
        low = lowest(e.unionByName(e.select(F.col("v").alias("u"), "v")))
        large = e.join(low, F.col("v") == F.col("w")).select("u", F.col("m").alias("v")).distinct()
        # Small star: a node and all that are below it hang on the smallest of them.
        if not few:
            large = cut(large, "edges")
            used.append(large)
        hung = large.join(lowest(large), F.col("u") == F.col("w")).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("p"))
        seen = Observation()
        e = cut(hung.select("p.u", "p.v").filter("u <> v").distinct(), "edges", (seen, *sums))
        forget(*used)
        if seen.get == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = seen.get
    raise RuntimeError(f"components: not settled after {max_rounds} rounds")


def junction_pairs(tx: DataFrame) -> DataFrame:
    """Pairs a < b of one gene and locus that share a junction: group, a, b, shared, size_a, size_b.

    An equi-join on the junction itself: only transcripts with something in common ever meet.
    """
    rows = tx.select(*GROUP, "tx", F.size(F.array_distinct("chain")).alias("size"), F.explode(F.array_distinct("chain")).alias("j"))
    a = rows.select(*GROUP, F.col("tx").alias("a"), F.col("size").alias("size_a"), "j")
    b = rows.select(*GROUP, F.col("tx").alias("b"), F.col("size").alias("size_b"), "j")
    return a.join(b, [*GROUP, "j"]).filter("a < b").groupBy(*GROUP, "a", "b", "size_a", "size_b").agg(F.count("*").alias("shared"))


def junction_stars(tx: DataFrame) -> DataFrame:
    """Edges (a, b): each transcript and the smallest of its group with the same junction. Their components are those of
    all pairs that share a junction, without the pairs."""
    rows = tx.select(*GROUP, "tx", F.explode(F.array_distinct("chain")).alias("j"))
    # Written: the join then has a shuffle of its own, in which Spark splits a common junction's rows.
    first = cut(rows.groupBy(*GROUP, "j").agg(F.min("tx").alias("b"), F.max("tx").alias("z")).filter("b <> z").drop("z"), "junctions")
    return rows.join(first, [*GROUP, "j"]).filter("tx <> b").select(F.col("tx").alias("a"), "b")


def needed(mode: str, size: Column, min_shared: int = 1, min_jaccard: float = 0.5, strong: int = 2, weak: float = 0.15) -> Column:
    """The fewest junctions that a set of ``size`` must share with another for ``mode`` to link them."""
    share = lambda t: F.greatest(F.ceil(size * t - 1e-9), F.lit(1))  # noqa: E731  of a set in their union, which is no smaller
    least = {"any_shared": F.lit(min_shared), "subset": F.lit(min_shared), "jaccard": F.greatest(share(min_jaccard), F.lit(min_shared)), "bridge_safe": F.least(F.lit(strong), share(weak))}[mode]
    return F.greatest(least, F.lit(1)).cast("int")


def candidate_pairs(sets: DataFrame, mode: str, **options) -> DataFrame:
    """Distinct pairs a, b of ``sets`` (group, tx, chain: distinct junctions; no two of a group equal) that ``mode`` may link.

    Junctions go in order of how few sets of the group have them. Two sets that share enough of them share one of their
    first ``size - needed + 1``, so only these are joined, and only sets of sizes that can be similar enough. For subsets
    the smaller set's rarest junction must be in the larger one: it is looked up among all junctions.
    """
    rows = sets.select(*GROUP, "tx", F.size("chain").alias("size"), F.explode("chain").alias("j"))
    counts = cut(rows.groupBy(*GROUP, "j").agg(F.count("*").alias("n")), "junction-counts")
    ranked = rows.join(counts, [*GROUP, "j"]).groupBy(*GROUP, "tx", "size").agg(F.array_sort(F.collect_list(F.struct("n", "j"))).alias("r"))
    ranked = cut(ranked.select(*GROUP, "tx", "size", F.transform("r", lambda x: x["j"]).alias("r")), "ranked-junctions")
    side = lambda x, tokens: ranked.select(*GROUP, F.col("tx").alias(x), F.col("size").alias(f"size_{x}"), F.explode(tokens).alias("j"))
    if mode == "subset":
        small = side("a", F.slice("r", 1, 1)).filter(F.col("size_a") >= needed(mode, F.col("size_a"), **options))
        met = small.join(side("b", F.col("r")), [*GROUP, "j"]).filter("a <> b and size_a <= size_b")
        return met.select(*GROUP, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    prefix = F.slice("r", F.lit(1), F.greatest(F.col("size") - needed(mode, F.col("size"), **options) + 1, F.lit(0)).cast("int"))
    met = side("a", prefix).join(side("b", prefix), [*GROUP, "j"]).filter("a < b")
    if mode == "jaccard":
        met = met.filter(F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * options.get("min_jaccard", 0.5) - 1e-9)
    return met.select(*GROUP, "a", "b").distinct()


def similar(base: DataFrame, mode: str, **options) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of ``base`` (tx, group, chain: sorted distinct junctions) that ``mode`` links.

    Equal sets of a group are one from the start: each hangs on the smallest, if the mode links equal sets of their size.
    """
    some = base.filter(F.size("chain") > 0)
    sets = cut(some.groupBy(*GROUP, "chain").agg(F.min("tx").alias("tx")), "junction-sets")
    same = F.size("chain") >= needed(mode, F.size("chain"), **options)
    equal = some.join(sets.select(*GROUP, "chain", F.col("tx").alias("b")), [*GROUP, "chain"]).filter((F.col("tx") != F.col("b")) & same).select(F.col("tx").alias("a"), "b")
    pairs = candidate_pairs(sets, mode, **options)
    chain = lambda x: sets.select(F.col("tx").alias(x), F.col("chain").alias(f"chain_{x}"))
    met = pairs.join(chain("a"), "a").join(chain("b"), "b")
    met = met.select("a", "b", F.size(F.array_intersect("chain_a", "chain_b")).alias("shared"), F.size("chain_a").alias("size_a"), F.size("chain_b").alias("size_b"))
    return equal.unionByName(linked(met, mode, **options).select("a", "b"))


def linked(pairs: DataFrame, mode: str = "any_shared", min_shared: int = 1, min_jaccard: float = 0.5, strong: int = 2, weak: float = 0.15) -> DataFrame:
    """Those of ``junction_pairs`` that ``mode`` links."""
    j = safe_fraction(F.col("shared").cast("double"), F.col("size_a") + F.col("size_b") - F.col("shared"))
    enough = F.col("shared") >= min_shared
    return pairs.filter({"any_shared": enough, "subset": (F.col("shared") == F.least("size_a", "size_b")) & enough, "jaccard": (j >= min_jaccard) & enough, "bridge_safe": (F.col("shared") >= strong) | (j >= weak)}[mode])


#: Junctions of all transcripts of a group that one task may link by itself; larger groups meet by shuffles.
MOST_JUNCTIONS = 2_048
#: Pairs that a task holds at a time.
_PAIRS = 1 << 21


def _smallest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each of ``n`` nodes the smallest that the edges (a, b) reach."""
    low = np.arange(n)
    while True:
        m, new = np.minimum(low[a], low[b]), low.copy()
        for at in (a, b, low[a], low[b]):
            np.minimum.at(new, at, m)
        new = new[new]
        if np.array_equal(new, low):
            return low
        low = new


def _links(group: np.ndarray, member: np.ndarray, run: np.ndarray, size: np.ndarray, mode: str, min_shared: int = 1, min_jaccard: float = 0.5, strong: int = 2, weak: float = 0.15) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) of members by ``mode``; rows are sorted by group and junction, ``run`` is where a junction's rows begin."""
    if mode == "any_shared" and min_shared == 1:
        return member, member[run]
    before = np.arange(len(run)) - run  # rows of the junction that a row is paired with
    ends = np.flatnonzero(np.diff(group, append=-1)) + 1
    upto, found, at = np.cumsum(before), [], 0
    while at < len(run):  # whole groups, as many as have few pairs
        done = upto[at - 1] if at else 0
        end = max(ends[np.searchsorted(ends, at, "right")], ends[max(np.searchsorted(upto[ends - 1], done + _PAIRS, "right") - 1, 0)])
        k = before[at:end]
        i = np.repeat(np.arange(at, end), k)
        j = run[i] + np.arange(len(i)) - np.repeat(np.cumsum(k) - k, k)
        pair, shared = np.unique(np.minimum(member[i], member[j]) * len(size) + np.maximum(member[i], member[j]), return_counts=True)
        a, b = pair // len(size), pair % len(size)
        share = shared / (size[a] + size[b] - shared)
        ok = {"any_shared": shared >= min_shared, "subset": (shared == np.minimum(size[a], size[b])) & (shared >= min_shared), "jaccard": (share >= min_jaccard) & (shared >= min_shared), "bridge_safe": (shared >= strong) | (share >= weak)}[mode]
        found.append((a[ok], b[ok]))
        at = end
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (member, member)


def link_members(chains: pa.Array, mode: str, **options) -> pa.Array:
    """For lists (groups) of lists (members) of donors and acceptors: of each member the number of the smallest that is linked with it, and how many are."""
    count = chains.value_lengths().to_numpy(zero_copy_only=False)
    each = chains.flatten()
    size = each.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) // 2
    places = each.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2)
    group, member = np.repeat(np.arange(len(count)), count), np.repeat(np.arange(len(size)), size)
    order = np.lexsort((member, places[:, 1], places[:, 0], group[member]))
    member, places = member[order], places[order]
    new = np.ones(len(member), bool)
    new[1:] = (places[1:] != places[:-1]).any(axis=1) | (group[member][1:] != group[member][:-1])
    run = np.maximum.accumulate(np.where(new, np.arange(len(member)), 0))
    low = _smallest(len(size), *_links(group[member], member, run, size, mode, **options))
    first = np.concatenate(([0], np.cumsum(count)))
    rows = pa.StructArray.from_arrays([pa.array(low - first[group], pa.int32()), pa.array(np.bincount(low, minlength=len(low))[low], pa.int64())], ["low", "n"])
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), rows)


def local_clusters(base: DataFrame, mode: str, **options) -> DataFrame:
    """tx, group, twice, cluster_id and cluster_size of ``base`` (the same, and chain), each group by itself: a row a group, linked in one task."""

    @F.arrow_udf(returnType=ArrayType(StructType([StructField("low", IntegerType()), StructField("n", LongType())])))
    def link(chains: pa.Array) -> pa.Array:
        return link_members(chains, mode, **options)

    # Donors and acceptors as plain numbers: half the bytes of structs.
    plain = F.flatten(F.transform("chain", lambda j: F.array(j["donor"], j["acceptor"])))
    groups = base.groupBy(*GROUP).agg(F.sort_array(F.collect_list(F.struct("tx", "twice", plain.alias("plain")))).alias("m"))
    rows = groups.select(*GROUP, F.col("m.tx").alias("t"), F.col("m.twice").alias("w"), link(F.col("m.plain")).alias("l"))
    rows = rows.select(*GROUP, "t", F.explode(F.arrays_zip("t", "w", "l")).alias("r"))
    return rows.select(F.col("r.t").alias("tx"), *GROUP, F.col("r.w").alias("twice"), F.get("t", F.col("r.l.low")).alias("cluster_id"), F.col("r.l.n").alias("cluster_size"))


def clusters(tx: DataFrame, mode: str = "any_shared", most: int = MOST_JUNCTIONS, **options) -> DataFrame:
    """tx, group, cluster_id (smallest member) and cluster_size of every transcript; those without links are alone.

    ``exact`` groups equal junction sets of a gene and locus; there all transcripts without junctions are one cluster.
    Groups of up to ``most`` junctions are linked in one task each. Larger ones, and what the same name in several groups
    joins, are connected by shuffles.
    """
    if mode not in MODES:
        raise ValueError(f"mode {mode!r}: one of {', '.join(MODES)}")
    if options.get("min_shared", 1) < 1:
        raise ValueError("min_shared: at least 1")
    # Written: the chains are read several times below, and whatever they come from only once.
    rows = tx.select("tx", *GROUP, F.array_sort(F.array_distinct("chain")).alias("chain"))
    if mode == "exact":
        base = cut(rows, "chains")
        groups = base.groupBy(*GROUP, "chain").agg(F.min("tx").alias("cluster_id"), F.count("*").alias("cluster_size"))
        return base.join(groups, [*GROUP, "chain"]).select("tx", *GROUP, "cluster_id", "cluster_size")
    twice, many = Observation(), Observation()
    rows = rows.filter("tx is not null").withColumn("twice", F.count("*").over(Window.partitionBy("tx")) > 1)
    base = cut(rows, "chains", (twice, F.count_if("twice").alias("n")))
    linkable = (F.size("chain") > 0) & F.col("gene").isNotNull() & F.col("chrom").isNotNull() & F.col("strand").isNotNull()
    near, key = base.filter(linkable), F.xxhash64(*GROUP)
    large = near.groupBy(key.alias("key")).agg(F.sum(F.size("chain")).alias("n")).filter(F.col("n") > most).select("key")
    large = cut(large, "large-groups", (many, F.count("*").alias("n")))
    far = None
    if many.get["n"]:
        near, far = near.join(large, key == F.col("key"), "left_anti"), near.join(large, key == F.col("key"), "left_semi")
    alone = base.filter(~linkable)
    single = lambda df: df.select("tx", *GROUP, "twice", F.col("tx").alias("cluster_id"), F.lit(1).cast("bigint").alias("cluster_size"))
    rows = local_clusters(near, mode, **options).unionByName(single(alone))
    if far is None and not twice.get["n"]:
        return rows.drop("twice")
    rows = cut(rows if far is None else rows.unionByName(single(far)), "local-clusters")
    edges = rows.filter("twice and tx <> cluster_id").select(F.col("tx").alias("a"), F.col("cluster_id").alias("b"))
    if far is not None:
        far = cut(far.select("tx", *GROUP, "chain"), "large-chains")
        edges = edges.unionByName(junction_stars(far) if mode == "any_shared" and options.get("min_shared", 1) == 1 else similar(far, mode, **options))
    found = components(edges)
    rows = rows.join(found, F.col("cluster_id") == F.col("node"), "left").select("tx", *GROUP, F.coalesce("component", "cluster_id").alias("cluster_id"))
    sizes = rows.groupBy("cluster_id").agg(F.count("*").alias("cluster_size"))
    return rows.join(sizes, "cluster_id").select("tx", *GROUP, "cluster_id", "cluster_size")
