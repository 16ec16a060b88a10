"""The trie of conversations' prefixes: rolling fingerprints, verified groups, sums over subtrees.

A conversation of turns t_1 ... t_n passes through a node at each depth d: its first d turns. The polynomial fingerprint
of a prefix, sum(hash(t_i) * B ** i) modulo 2 ** 64, is a running sum, which numpy makes for many conversations at once;
prefixes of one depth and fingerprint are a candidate group. In a group, every member's last turn (role and text, by the
SHA-256 of both) and its prefix before are held against the representative's. By induction on the depth a group in which
all agree, and under which all do, is one node; where some don't, every conversation that passes there is told apart from
that depth on by a chain of digests. Texts are read once, where they lie: only digests and lengths are shuffled.

Sums over subtrees need no step per depth. A node is owned by its smallest member, and whoever owns a node owns all below
it on its own path; so the sum over a node's subtree is the owner's running sum from the path's end, plus the other
members' sums over all that they own. One window over owned nodes and one grouped sum give it for all depths at once.

Long conversations are split into pieces of the path (``PIECE`` turns), each summed alone; what pieces before (or after)
it add is joined to it. Grouped sums are combined on the map side, so a node of very many members costs each task a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType
from pyspark.sql.window import Window

from strandloom.lineage import Observation
from strandloom.operators.numbering import number_by_range

from .common import batches, cut

#: Turns of a path that are summed in one stretch.
PIECE = 1 << 16
#: Ids of members that are joined into one string before they meet those of other ranges.
IDS = 1 << 16
_BASE = 0x9E3779B97F4A7C15
NODE = ["d", "fp", "chain"]


def turns(talks: DataFrame) -> DataFrame:
    """conv, pos (from 0), digest (SHA-256 of role and text, told apart by the role's length) and bytes of the text.

    Turns go by their number, null first, and equal numbers by digest. Rows without a conversation id have no place.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = talks.filter("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").cast("bigint").alias("turn"), digest.alias("digest"), F.octet_length(text).cast("bigint").alias("bytes"))
    piece = F.floor(F.col("turn") / PIECE)
    return number_by_range(cut(rows, "turns"), ["conv"], piece, [F.asc_nulls_first("turn"), F.col("digest")], "pos").drop("turn")


def rebuilt(rows: DataFrame) -> DataFrame:
    """c, d (from 1), digest, bytes and ``last`` of the rebuilt conversations, and one row of depth 0 for each."""
    rows = cut(rows, "numbered")
    lengths = cut(rows.groupBy("conv").agg(F.count("*").alias("len")), "lengths")
    base = F.col("conv") - F.col("conv") % 5
    plan = lengths.select("conv", F.col("len").alias("own"), base.alias("base"), (F.crc32(F.col("conv").cast("string").cast("binary")) % 9).alias("h"))
    plan = plan.join(lengths.select(F.col("conv").alias("b"), F.col("len").alias("there")), F.col("base") == F.col("b"), "left")
    head = F.least("h", F.coalesce("there", F.lit(0)))  # turns taken from the other conversation
    plan = cut(plan.select("conv", "base", "h", head.alias("head"), (head + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")), "plan")
    own = rows.join(plan.select(F.col("conv").alias("c"), "h", "head", "n"), F.col("conv") == F.col("c")).filter("pos >= h").select("c", (F.col("pos") - F.col("h") + F.col("head") + 1).alias("d"), "digest", "bytes", "n")
    taken = rows.filter("pos < 8").join(plan.select(F.col("conv").alias("c"), "base", "head", "n"), F.col("conv") == F.col("base")).filter("pos < head").select("c", (F.col("pos") + 1).alias("d"), "digest", "bytes", "n")
    roots = plan.select(F.col("conv").alias("c"), F.lit(0).cast("bigint").alias("d"), F.lit(b"").alias("digest"), F.lit(0).cast("bigint").alias("bytes"), "n")
    return own.unionByName(taken).unionByName(roots).select("c", "d", "digest", "bytes", (F.col("d") == F.col("n")).alias("last"))


def _wrapped(a: Column, b: Column) -> Column:
    """a + b modulo 2 ** 64."""
    half = F.lit((1 << 32) - 1)
    low = a.bitwiseAND(half) + b.bitwiseAND(half)
    high = F.shiftrightunsigned(a, 32) + F.shiftrightunsigned(b, 32) + F.shiftrightunsigned(low, 32)
    return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(half))


def _power(d: np.ndarray) -> np.ndarray:
    """_BASE ** d modulo 2 ** 64, by squares."""
    out, square, d = np.ones(len(d), np.uint64), np.full(1, _BASE, np.uint64), d.copy()
    while d.any():
        out = np.where(d & 1, out * square, out)
        square, d = square * square, d >> 1
    return out


def fingerprinted(paths: DataFrame, piece: int = PIECE, bits: int = 64) -> DataFrame:
    """Adds fp and before: the fingerprints of the path up to and without each row. Fewer ``bits`` make collisions (tests)."""

    def scan(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, part, total = None, None, np.uint64(0)
        for b in it:
            c, d = (b.column(k).to_numpy() for k in (0, 1))
            if not len(c):
                continue
            h = np.array([int.from_bytes(x[:8], "little") for x in b.column(2).to_pylist()], np.uint64)
            h = np.where(d == 0, np.uint64(0), (h | np.uint64(1)) * _power(d))
            key = np.flatnonzero((np.diff(c, prepend=c[0]) != 0) | (np.diff(d // piece, prepend=d[0] // piece) != 0))
            first = np.concatenate(([0], key)).astype(np.int64)
            sums = np.cumsum(h)
            carried = total if (c[0], d[0] // piece) == (conv, part) else np.uint64(0)
            start = np.where(first > 0, sums[first - 1], np.uint64(0))
            start[:1] -= carried  # wraps, as arrays do without a warning
            upto = sums - np.repeat(start, np.diff(np.append(first, len(c))))
            conv, part, total = c[-1], d[-1] // piece, upto[-1]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(upto.view(np.int64)), pa.array((upto - h).view(np.int64))], [*b.schema.names, "fp", "before"])

    cut_at = F.floor(F.col("d") / piece)
    dealt = paths.repartition("c", cut_at).sortWithinPartitions("c", "d")
    out = cut(batches(dealt, scan, StructType([*paths.schema.fields, StructField("fp", LongType()), StructField("before", LongType())])), "paths")
    ends = out.filter((F.col("d") % piece == piece - 1) & ~F.col("last")).select("c", cut_at.alias("part"), "fp")

    def carry(t: pa.Table) -> pa.Table:
        t = t.sort_by("part")
        return pa.table({"w": t["c"], "p": pa.array(t["part"].to_numpy() + 1), "carry": pa.array(np.cumsum(t["fp"].to_numpy().view(np.uint64)).view(np.int64))})

    if not ends.isEmpty():  # one row a piece of a path
        carried = cut(ends.groupBy("c").applyInArrow(carry, "w long, p long, carry long"), "carries")
        more = F.coalesce("carry", F.lit(0).cast("bigint"))
        joined = out.join(carried, (F.col("c") == F.col("w")) & (cut_at == F.col("p")), "left")
        out = joined.select(*paths.columns, _wrapped(F.col("fp"), more).alias("fp"), _wrapped(F.col("before"), more).alias("before"))
    if bits < 64:
        out = out.withColumns({c: F.col(c).bitwiseAND(F.lit((1 << bits) - 1)) for c in ("fp", "before")})
    return out


def _chained(paths: DataFrame) -> DataFrame:
    """Adds chain and chain_before: digests of the turns up to and without each row, one after another."""

    def scan(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, chain = None, b""
        for b in it:
            out, prior = [], []
            for c, x in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if c != conv:
                    conv, chain = c, b""
                prior.append(chain)
                chain = hashlib.sha256(chain + x).digest() if x else b""
                out.append(chain)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary()), pa.array(prior, pa.binary())], [*b.schema.names, "chain", "chain_before"])

    dealt = paths.repartition("c").sortWithinPartitions("c", "d")
    return batches(dealt, scan, StructType([*paths.schema.fields, StructField("chain", BinaryType()), StructField("chain_before", BinaryType())]))


def verified(paths: DataFrame) -> DataFrame:
    """Adds chain and chain_before: empty where the fingerprint alone names the node, else what tells its members apart.

    A group holds together if its members' last turns and prefixes before are the representative's, which smallest and
    largest ones tell without gathering the group.
    """
    none = F.lit(b"")
    groups = paths.groupBy("d", "fp").agg(*(f(c).alias(f"{n}_{c}") for c in ("digest", "before") for n, f in (("least", F.min), ("most", F.max))))
    bad = cut(groups.filter("least_digest <> most_digest or least_before <> most_before").select(F.col("d").alias("bd"), F.col("fp").alias("bfp")), "collisions")
    if bad.isEmpty():
        return paths.withColumns({"chain": none, "chain_before": none})
    # Conversations through such a group, from the first one on.
    through = cut(paths.join(bad, (F.col("d") == F.col("bd")) & (F.col("fp") == F.col("bfp"))).groupBy(F.col("c").alias("w")).agg(F.min("d").alias("since")), "colliding")
    touched = cut(_chained(paths.join(through, F.col("c") == F.col("w"), "left_semi")), "chains").join(through, F.col("c") == F.col("w"))
    touched = touched.withColumns({"chain": F.when(F.col("d") >= F.col("since"), F.col("chain")).otherwise(none), "chain_before": F.when(F.col("d") > F.col("since"), F.col("chain_before")).otherwise(none)}).drop("w", "since")
    return cut(paths.join(through, F.col("c") == F.col("w"), "left_anti").withColumns({"chain": none, "chain_before": none}).unionByName(touched), "verified")


def _hashes(ends: DataFrame) -> DataFrame:
    """Nodes with ends_sha256: ids are joined within ranges of the ids, by all tasks; then a node's strings stream through a hash."""

    def joined(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []
        out: list[tuple] = []
        flush = lambda: out.append((*node, ids[0], ",".join(map(str, ids))))
        for b in it:
            for *key, c in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if ids and (key != node or len(ids) >= IDS):
                    flush()
                    ids = []
                node = key
                ids.append(c)
            yield from _rows(out, ["d", "fp", "chain", "first", "ids"], kinds)
            out.clear()
        if ids:
            flush()
        yield from _rows(out, ["d", "fp", "chain", "first", "ids"], kinds)

    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
    ranged = ends.select(*NODE, "c").repartitionByRange("c").sortWithinPartitions(*NODE, "c")
    parts = batches(ranged, joined, "d long, fp long, chain binary, first long, ids string")

    def hashed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for b in it:
            out = []
            for *key, ids in zip(*(b.column(k).to_pylist() for k in (0, 1, 2, 4)), strict=True):
                if key != node:
                    if sha is not None:
                        out.append((*node, sha.hexdigest()))
                    node, sha = key, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield from _rows(out, ["d", "fp", "chain", "ends"], [pa.int64(), pa.int64(), pa.binary(), pa.string()])
        if sha is not None:
            yield from _rows([(*node, sha.hexdigest())], ["d", "fp", "chain", "ends"], [pa.int64(), pa.int64(), pa.binary(), pa.string()])

    return batches(parts.repartition(*NODE).sortWithinPartitions(*NODE, "first"), hashed, "d long, fp long, chain binary, ends string")


def _rows(out: list[tuple], names: list[str], kinds: list) -> Iterator[pa.RecordBatch]:
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)


def _same(prefix: str, node: list[Column] | None = None) -> Column:
    a, b, c = node or [F.col(k) for k in NODE]
    return (a == F.col(f"{prefix}d")) & (b == F.col(f"{prefix}fp")) & (c == F.col(f"{prefix}chain"))


def _renamed(df: DataFrame, prefix: str, *more: str | Column) -> DataFrame:
    return df.select(*(F.col(k).alias(f"{prefix}{k}") for k in NODE), *more)


def prefix_trie(paths: DataFrame, piece: int = PIECE, bits: int = 64) -> DataFrame:
    """One row a node of the trie of ``paths`` (c, d, digest, bytes, last; a row of depth 0 for each conversation).

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs (members), n_children, n_leaves (childless
    nodes of the subtree, itself included), saved_tokens (over the subtree, (members - 1) * bytes of the last text) and
    ends_sha256 (of the ids of the members that end there, ascending, comma-joined). No conversations give no nodes; equal
    conversations share all nodes; texts of any length count by their bytes.
    """
    paths = verified(fingerprinted(paths, piece, bits))
    seen = Observation()
    top = F.min(F.struct("c", "before", "chain_before", "bytes"))
    nodes = cut(paths.groupBy(*NODE).agg(F.count("*").alias("n_convs"), top.alias("top")).select(*NODE, "n_convs", "top.*"), "nodes", (seen, F.max("d").alias("deepest")))
    up = [F.col("d") - 1, F.col("before"), F.col("chain_before")]
    children = nodes.filter("d > 0").groupBy(*(c.alias(f"k{k}") for c, k in zip(up, NODE, strict=True))).agg(F.count("*").alias("n_children"))
    owned = nodes.join(children, _same("k"), "left").select(*NODE, "c", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "before", "chain_before", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    owned = owned.withColumns({"leaf": (F.col("n_children") == 0).cast("bigint"), "part": F.floor(F.col("d") / piece)})
    # From the end of the owner's path back to each node: within the piece, and the pieces after it.
    back = Window.partitionBy("c", "part").orderBy(F.desc("d"))
    owned = cut(owned.withColumns({"leaf": F.sum("leaf").over(back), "saved": F.sum("saved").over(back)}), "owned")
    if (seen.get["deepest"] or 0) >= piece:
        whole = owned.groupBy(F.col("c").alias("w"), F.col("part").alias("p")).agg(F.max("leaf").alias("l"), F.max("saved").alias("s"))
        later = Window.partitionBy("w").orderBy(F.desc("p"))
        after = whole.select("w", "p", (F.sum("l").over(later) - F.col("l")).alias("l"), (F.sum("s").over(later) - F.col("s")).alias("s"))
        owned = cut(owned.join(after, (F.col("c") == F.col("w")) & (F.col("part") == F.col("p"))).withColumns({"leaf": F.col("leaf") + F.col("l"), "saved": F.col("saved") + F.col("s")}).drop("w", "p", "l", "s"), "owned")
    # What a conversation owns in all, for the nodes above that others own.
    totals = cut(owned.groupBy(F.col("c").alias("w")).agg(F.max("leaf").alias("l"), F.max("saved").alias("s")), "totals")
    member = paths.select(*NODE, "c").join(totals, F.col("c") == F.col("w")).groupBy(*NODE).agg(F.sum("l").alias("l"), F.sum("s").alias("s"))
    rows = owned.join(_renamed(member, "m", F.col("l").alias("all_leaves"), F.col("s").alias("all_saved")), _same("m"), "left").join(totals, F.col("c") == F.col("w"))
    n_leaves = F.coalesce("all_leaves", F.lit(0)) - F.col("l") + F.col("leaf")
    saved = F.coalesce("all_saved", F.lit(0)) - F.col("s") + F.col("saved")
    rows = rows.select(*NODE, "c", "n_convs", "n_children", "before", "chain_before", n_leaves.alias("n_leaves"), saved.alias("saved_tokens"))
    rows = rows.join(_renamed(nodes, "u", F.col("c").alias("parent_conv_id")), _same("u", up), "left")
    ends = _renamed(_hashes(paths.filter("last")), "e", "ends")
    rows = rows.join(ends, _same("e"), "left")
    return rows.select(F.col("c").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", "n_convs", F.col("n_children").cast("bigint").alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def plain_paths(rows: DataFrame) -> DataFrame:
    """The conversations themselves as paths, not rebuilt: what ``prefix_trie`` takes, from ``turns``."""
    rows = cut(rows, "numbered")
    lengths = rows.groupBy(F.col("conv").alias("w")).agg(F.count("*").alias("n"))
    own = rows.join(lengths, F.col("conv") == F.col("w")).select(F.col("conv").alias("c"), (F.col("pos") + 1).alias("d"), "digest", "bytes", (F.col("pos") + 1 == F.col("n")).alias("last"))
    roots = rows.select(F.col("conv").alias("c")).distinct().select("c", F.lit(0).cast("bigint").alias("d"), F.lit(b"").alias("digest"), F.lit(0).cast("bigint").alias("bytes"), F.lit(False).alias("last"))
    return own.unionByName(roots)
