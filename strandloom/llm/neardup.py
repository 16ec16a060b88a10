"""Near-duplicate documents by HyperMinHash signatures, banding and exact verification.

Each document's shingle set gets 256 registers: its hashes fall into buckets by their first bits, and a register
holds the number of leading zeros of the bucket's smallest hash with ten mantissa bits after its leading one. An empty
bucket borrows the register of an occupied one, chosen by a fixed order of preference. Bands of registers, as many and
as long as the threshold asks for (36 of 7 at 0.85, 35 of 5 at 0.80), name buckets of candidates; estimated Jaccard
similarities, corrected for registers that agree by chance, sort the candidates out; the full sets confirm what is left.

Nothing is paired that need not be. Equal sets are one class from the start. Then three steps find what links join, each
with the full sets of those classes alone that it needs:

* anchors: in each bucket all registers meet the smallest member's; each class is verified against one such anchor, a
  class's text being sent once and an anchor's once a tile of its classes. That settles groups of copies of one text.
* crossings: buckets in which several verified groups meet compare registers in tiles, the largest group's among
  themselves left out; the likeliest pairs that connect a tile's groups, a spanning forest of them, are verified. That
  settles chains.
* the rest: of the classes that still have a likely partner in another group, the full sets meet in tiles, and only a
  spanning forest of the confirmed links leaves a task.

So a text is sent a few times, however large its group; only where many different texts lie just below the threshold do
their pairs of tiles grow with the square of their number. A pair at the threshold shares no band with a probability
below 1e-6; that is the method's only loss.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.lineage import forget_since, mark

from .common import batches, components, cut, give_back
from .shingles import digest, mix, sets_of

REGISTERS = 256
#: A pair at the threshold shares no band with a probability below this.
MISS = 1e-6
_VALUE_BITS = 56
MANTISSA = 10
#: An estimate's standard deviation at 0.85 is about 0.022; candidates this far below the threshold go.
MARGIN = 0.13
#: A tile of a group holds about so many shingles or sets.
TILE_SHINGLES, TILE_SETS = 500_000, 512
#: Members of one bucket whose registers are compared in one tile.
BUCKET_TILE = 512
#: Groups' members are broadcast to fetch their texts up to so many rows; beyond that they are joined by shuffle.
BROADCAST_ROWS = 100_000

_RNG = np.random.default_rng(85)
_PREFERENCE = np.argsort(np.argsort(_RNG.random((REGISTERS, REGISTERS)), axis=1), axis=1).astype(np.uint16)
_BAND = _RNG.integers(1, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_NO = _RNG.integers(1, 1 << 63, REGISTERS, dtype=np.uint64)


def signature(h: np.ndarray) -> np.ndarray:
    """Registers (uint16) of a sorted array of distinct hashes, not empty."""
    bucket = (h >> np.uint64(_VALUE_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    used = bucket[first]
    v = h[first] & np.uint64((1 << _VALUE_BITS) - 1)
    bits = np.frexp(v.astype(np.float64))[1].astype(np.int64)
    bits -= (v >> np.maximum(bits - 1, 0).astype(np.uint64) == 0) & (bits > 0)  # rounded up to a power of two
    mantissa = ((v << (_VALUE_BITS - bits).astype(np.uint64)) >> np.uint64(_VALUE_BITS - 1 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    out = np.zeros(REGISTERS, np.uint16)
    out[used] = ((_VALUE_BITS - bits) << MANTISSA).astype(np.uint16) | mantissa.astype(np.uint16)
    if len(used) < REGISTERS:
        empty = np.setdiff1d(np.arange(REGISTERS), used, assume_unique=True)
        out[empty] = out[used[np.argmin(_PREFERENCE[empty][:, used], axis=1)]]
    return out


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows for a threshold: the most rows with which few enough pairs are missed, as far as the registers go."""
    for rows in range(REGISTERS, 0, -1):
        share = (percent / 100) ** rows
        n = math.ceil(math.log(MISS) / math.log1p(-share)) if 1e-12 < share < 1 else 1 if share == 1 else REGISTERS + 1
        if n * rows <= REGISTERS:
            return n, rows
    return REGISTERS, 1


def band_keys(registers: np.ndarray, n: int, rows: int) -> np.ndarray:
    """(documents, n) keys of bands of ``rows`` registers from (documents, REGISTERS)."""
    r = registers[:, : n * rows].reshape(-1, n, rows).astype(np.uint64) + np.uint64(1)
    return mix((r * _BAND[: n * rows].reshape(n, rows)).sum(axis=2, dtype=np.uint64) + _BAND_NO[:n]).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers of sets of sizes n and m, less the share that agrees by chance."""
    agree = (a == b).mean(axis=1)
    chance = 0.1699 * 2.0**-MANTISSA * 4 * n * m / (n + m) ** 2
    return (agree - chance) / (1 - chance)


def signatures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """doc_id, n (distinct shingles), digest (of the set) and registers of every row; null registers for an empty set."""
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            ids, texts = b.column(0), b.column(1)
            step = max(1, min(b.num_rows, 512))
            for at in range(0, b.num_rows, step):
                sets = sets_of(texts.slice(at, step).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, step), pa.array([len(s) for s in sets], pa.int64()), pa.array([digest(s) for s in sets], pa.binary()), pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                    ["doc_id", "n", "digest", "registers"],
                )

    return batches(src, run, "doc_id long, n long, digest binary, registers binary")


def bands(classes: DataFrame, percent: int) -> DataFrame:
    """(key, rep, n): the band keys of each class for a threshold."""
    count, rows = banding(percent)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for at in range(0, b.num_rows, 2048):
                c = b.slice(at, 2048)
                regs = np.frombuffer(b"".join(c.column(2).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                repeat = lambda x: pa.array(np.repeat(x.to_numpy(zero_copy_only=False), count))
                yield pa.RecordBatch.from_arrays([pa.array(band_keys(regs, count, rows).ravel()), repeat(c.column(0)), repeat(c.column(1))], ["key", "rep", "n"])

    return batches(classes.select("rep", "n", "registers"), run, "key long, rep long, n long")


def likely(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Those of the distinct pairs (a, b) whose estimate is at least ``least``, with it."""
    side = lambda x: classes.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("registers").alias(f"r{x}"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in it:
            regs = [np.frombuffer(b"".join(t.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in ("ra", "rb")]
            n, m = (t.column(k).to_numpy() for k in ("na", "nb"))
            est = estimate(*regs, n, m)
            yield t.select(["a", "b"]).append_column("est", pa.array(est)).filter(pa.array(est >= least))

    return batches(pairs.join(side("a"), "a").join(side("b"), "b"), run, "a long, b long, est double")


def in_tiles(members: DataFrame) -> DataFrame:
    """Members (key, rep, n, label) of buckets in which several labels meet, once for each pair of tiles (i, j) that they go to; t: their own tile.

    A bucket's largest label needs no pairs of its own: its tiles meet those of the other labels alone. So the rows grow
    with the bucket's size, and with the square of only what lies outside its largest label. Small buckets are one tile.
    """
    counts = members.groupBy("key", "label").agg(F.count("*").alias("m"))
    largest = counts.groupBy("key").agg(F.max(F.struct("m", "label")).alias("x"), F.sum("m").alias("m"))
    tiles = lambda m: F.ceil(m / BUCKET_TILE).cast("int")
    one, most = F.col("m") <= BUCKET_TILE, F.col("x.m")
    largest = largest.select("key", F.col("x.label").alias("bulk"), F.when(one, 1).otherwise(tiles(F.col("m") - most)).alias("others"), F.when(one, 0).otherwise(tiles(most)).alias("bulks"))
    rows = members.join(cut(largest, "bucket-tiles"), "key")
    of_bulk, at = (F.col("label") == F.col("bulk")) & (F.col("bulks") > 0), F.xxhash64("rep")
    own = F.when(of_bulk, F.col("others") + F.pmod(at, F.greatest("bulks", F.lit(1)))).otherwise(F.pmod(at, F.col("others"))).cast("int")
    with_ = F.sequence(F.lit(0), F.when(of_bulk, F.col("others") - 1).otherwise(F.col("others") + F.col("bulks") - 1))
    rows = rows.withColumn("t", own).withColumn("o", F.explode(with_))
    return rows.select("key", F.least("t", "o").alias("i"), F.greatest("t", "o").alias("j"), "t", "rep", "n", "label")


def crossings(members: DataFrame, classes: DataFrame, least: float, percent: int, every: bool) -> DataFrame:
    """Likely pairs between different labels of the same key, (a, b, la, lb): in each pair of tiles, those of the likeliest
    spanning forest of its labels, fewer than it has labels.

    members: key, rep, n, label. Registers meet in pairs of tiles of one bucket. With ``every``, also a row (a, a, label,
    label) for each class that has a likely partner of another label; the labels that likely pairs connect are then those
    that the forests connect.
    """
    met = in_tiles(members).join(classes.select("rep", "registers"), "rep").select("key", "i", "j", "t", "rep", "n", "label", "registers")

    def tile_pair(key: tuple, table: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        t, rep, n, label = (table.column(c).to_numpy() for c in ("t", "rep", "n", "label"))
        names, lab = np.unique(label, return_inverse=True)
        regs = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        left, right = np.flatnonzero(t == i), np.flatnonzero(t == j)
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        involved = np.zeros(len(rep), bool)
        for r in left if len(right) else ():
            with_ = right[(lab[right] != lab[r]) & (100 * np.minimum(n[right], n[r]) >= percent * np.maximum(n[right], n[r]))]
            if not len(with_):
                continue
            est = estimate(regs[with_], regs[r], n[with_], n[r])
            hits, est = with_[est >= least], est[est >= least]
            involved[hits] = True
            involved[r] |= len(hits) > 0
            order = np.lexsort((rep[hits], -est))
            for other, at in zip(*np.unique(lab[hits][order], return_index=True), strict=True):
                k = order[at]
                pair = (min(lab[r], other), max(lab[r], other))
                best[pair] = min(best.get(pair, (0.0, 0, 0)), (-est[k], rep[r], rep[hits[k]]))
        flagged = np.flatnonzero(involved) if every else np.zeros(0, int)
        root, forest = list(range(len(names))), []
        for (p, q), (_, a, b) in sorted(best.items(), key=lambda x: x[1]):
            p, q = find(root, p), find(root, q)
            if p != q:
                root[max(p, q)] = min(p, q)
                forest.append((a, b))
        a, b = np.array(forest, np.int64).reshape(-1, 2).T
        label_of = dict(zip(rep.tolist(), label.tolist(), strict=True))
        own = lambda x: np.concatenate([x, rep[flagged]])
        side = lambda x: np.array([label_of[k] for k in x.tolist()], np.int64)
        a, b = own(a), own(b)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b), "la": side(np.minimum(a, b)), "lb": side(np.maximum(a, b))})

    return met.groupBy("key", "i", "j").applyInArrow(tile_pair, "a long, b long, la long, lb long").distinct()


def find(parent: np.ndarray | list[int], k: int) -> int:
    """The root of k in a union-find forest, which gets flatter."""
    while parent[k] != k:
        parent[k] = parent[parent[k]]
        k = parent[k]
    return k


def reaches(common: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of sizes n and m with ``common`` members in common are linked."""
    return (common > 0) & (100 * common.astype(np.int64) >= percent * (n + m - common))


def in_common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    return int((large[at] == small).sum()) if len(small) else 0


def confirmed(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """A spanning forest, as index pairs, of the pairs of left x right with 100 * intersection >= percent * union."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), size)
    _, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = df[column] > 1
    owner, column = owner[shared], column[shared]
    common = np.zeros((n, n), np.int32)
    often = df[column] > 32
    # Frequent shingles: blocks of a 0/1 matrix, multiplied. Rare ones: their few owners, pair by pair.
    wide, at = np.unique(column[often], return_inverse=True)
    for c in range(0, len(wide), 4096):
        lo, hi = np.searchsorted(at, [c, c + 4096])
        block = np.zeros((n, min(4096, len(wide) - c)), np.float32)
        block[owner[often][lo:hi], at[lo:hi] - c] = 1
        common += (block @ block.T).astype(np.int32)
    owner, column = owner[~often], column[~often]
    for gap in range(1, 33):
        same = column[gap:] == column[:-gap]
        if not same.any():
            break
        pair, times = np.unique(owner[:-gap][same] * n + owner[gap:][same], return_counts=True)
        common[pair // n, pair % n] += times.astype(np.int32)
        common[pair % n, pair // n] += times.astype(np.int32)
    union = size[left][:, None] + size[right][None] - common[np.ix_(left, right)]
    i, j = np.nonzero(100 * common[np.ix_(left, right)].astype(np.int64) >= percent * union)
    label = list(range(n))
    for a, b in zip(left[i].tolist(), right[j].tolist(), strict=True):
        p, q = find(label, a), find(label, b)
        if p != q:
            label[max(p, q)] = min(p, q)
            yield a, b


def verified_anchors(pairs: DataFrame, classes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (anchor a, class b) whose full sets are linked: (a, b). A class is sent once, an anchor once a tile of its classes."""
    size = classes.groupBy("rep").agg(F.max("n").alias("n"))
    rows = pairs.join(size.select(F.col("rep").alias("b"), "n"), "b")
    tiles = rows.groupBy("a").agg(F.greatest(F.ceil(F.sum("n") / TILE_SHINGLES), F.ceil(F.count("*") / TILE_SETS)).cast("int").alias("tiles"))
    tiles = cut(tiles, "anchor-tiles")
    own = rows.join(tiles, "a").select("a", F.col("b").alias("doc_id"), F.pmod(F.xxhash64("b"), F.col("tiles")).cast("int").alias("t"), F.lit(False).alias("anchor"))
    heads = tiles.select("a", F.col("a").alias("doc_id"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("t"), F.lit(True).alias("anchor"))
    met = texts.join(cut(own.unionByName(heads), "anchored"), "doc_id")

    def star(key: tuple, table: pa.Table) -> pa.Table:
        ids, anchor = table.column("doc_id").to_numpy(), np.array(table.column("anchor").to_pylist(), bool)
        sets = sets_of(table.column("text").to_pylist())
        heads, hit = [s for s, x in zip(sets, anchor, strict=True) if x and len(s)], set()
        for k in np.flatnonzero(~anchor):
            s = sets[k]
            if any(reaches(np.int64(in_common(s, h)), len(s), len(h), percent) for h in heads):
                hit.add(int(ids[k]))
        return pa.table({"a": pa.array([key[0].as_py()] * len(hit), pa.int64()), "b": pa.array(sorted(hit), pa.int64())})

    return met.groupBy("a", "t").applyInArrow(star, "a long, b long")


def verified_pairs(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct pairs (a, b) whose full sets are linked: (a, b)."""
    side = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t{x}"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for at in range(0, b.num_rows, 64):  # a few texts at a time
                c = b.slice(at, 64)
                left, right = (sets_of(c.column(k).to_pylist()) for k in (2, 3))
                yield c.select(["a", "b"]).filter(pa.array([bool(reaches(np.int64(in_common(x, y)), len(x), len(y), percent)) for x, y in zip(left, right, strict=True)], pa.bool_()))

    return batches(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb"), run, "a long, b long").distinct()


def tiled(groups: DataFrame, classes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """A spanning forest (a, b) of the links within each group of classes (doc_id, component): full sets meet in tiles."""
    size = classes.groupBy(F.col("rep").alias("doc_id")).agg(F.max("n").alias("n"))
    rows = groups.join(size, "doc_id")
    tiles = cut(rows.groupBy("component").agg(F.greatest(F.ceil(F.sum("n") / TILE_SHINGLES), F.ceil(F.count("*") / TILE_SETS)).cast("int").alias("tiles")), "tiles")
    placed = cut(groups.join(tiles, "component").select("doc_id", "component", "tiles", F.pmod(F.xxhash64("doc_id"), F.col("tiles")).cast("int").alias("t")), "placed")
    met = texts.join(placed, "doc_id").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select("component", F.least("t", "o").alias("i"), F.greatest("t", "o").alias("j"), "t", "doc_id", "text")

    def tile_pair(key: tuple, table: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        t, ids = table.column("t").to_numpy(), table.column("doc_id").to_numpy()
        sets = sets_of(table.column("text").to_pylist())
        some = np.array([len(s) > 0 for s in sets])
        left, right = np.flatnonzero((t == i) & some), np.flatnonzero((t == j) & some)
        edges = [(ids[a], ids[b]) for a, b in confirmed(sets, left, right, percent) if ids[a] != ids[b]] if len(left) and len(right) else []
        if sum(map(len, sets)) > TILE_SHINGLES // 4:  # large temporaries
            give_back()
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return met.groupBy("component", "i", "j").applyInArrow(tile_pair, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 85, text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row: documents with 100 * intersection >= percent * union of
    their distinct 5-word shingles are linked.

    Words are runs without ASCII white space, A-Z lower-cased; a text of fewer than five words is one shingle; null
    texts and texts without words have none and link with nothing. component_id is the smallest doc_id that links
    reach, kept whether it is the row's own. Repeated rows count as equal texts; rows of one id and different texts
    are one document, which links with what any of them links with. Null ids link with nothing. Texts are taken whole,
    however long. Other columns are left out, whatever their names. An empty table gives no rows.
    """
    least, point = percent / 100 - MARGIN, mark()
    rows = cut(signatures(docs, text_col), "signatures")
    full = rows.filter("n > 0 and doc_id is not null")
    classes = cut(full.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("registers").alias("registers")), "classes")
    keyed = bands(classes, percent)
    # Written: the join then has a shuffle of its own on both sides, and Spark splits the hot buckets' rows.
    several = cut(keyed.groupBy("key").agg(F.count("*").alias("m"), F.min(F.struct("rep", "n")).alias("hub")).filter("m > 1").select("key", F.col("hub.rep").alias("hub"), F.col("hub.n").alias("hub_n")), "hubs")
    members = cut(keyed.join(several, "key"), "buckets")
    wanted = cut(members.select(F.col("rep").alias("doc_id")).distinct(), "candidates")
    chosen = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).filter("text is not null")
    texts = cut(texts.join(chosen, "doc_id").dropDuplicates(["doc_id", "text"]), "candidate-texts")

    # Anchors: of the hubs that a class is likely linked with, the smallest that reaches the threshold, or else the smallest.
    fits = lambda n, m: 100 * F.least(n, m) >= percent * F.greatest(n, m)
    pairs = members.filter((F.col("rep") != F.col("hub")) & fits(F.col("n"), F.col("hub_n"))).select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    anchor = likely(pairs, classes, least).groupBy("b").agg(F.min(F.struct(F.col("est") < percent / 100, "a")).alias("x")).select(F.col("x.a").alias("a"), "b")
    edges = cut(verified_anchors(cut(anchor, "anchors"), classes, texts, percent), "links")

    def meeting(edges: DataFrame) -> DataFrame | None:
        """Members, with the labels of linked classes, of the buckets in which several labels meet; None if there is no such bucket."""
        labels = cut(components(edges), "labels")
        named = members.join(labels, F.col("rep") == F.col("node"), "left").select("key", "rep", "n", F.coalesce("component", "rep").alias("label"))
        mixed = named.groupBy("key").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).filter("l0 <> l1")
        mixed = cut(mixed.select("key"), "mixed-buckets")
        return None if mixed.isEmpty() else named.join(mixed, "key")

    # Crossings: the likeliest pairs that connect labels. Where none is likely, there is nothing to verify, here and below.
    met = meeting(edges)
    likeliest = None if met is None else cut(crossings(met, classes, least, percent, every=False).select("a", "b").distinct(), "crossings")
    if likeliest is not None and not likeliest.isEmpty():
        more = cut(verified_pairs(likeliest, texts, percent), "links")
        if not more.isEmpty():
            edges = edges.unionByName(more)
            met = meeting(edges)
        # The rest: classes that still have likely partners under another label, in groups of labels that may be joined.
        still = None if met is None else cut(crossings(met, classes, least, percent, every=True), "still-open")
        if still is not None and not still.isEmpty():
            groups = components(still.filter("la <> lb").select(F.col("la").alias("a"), F.col("lb").alias("b")))
            involved = still.filter("a = b").select(F.col("a").alias("doc_id"), "la").distinct().join(groups, F.col("la") == F.col("node")).select("doc_id", "component")
            edges = edges.unionByName(cut(tiled(cut(involved, "involved"), classes, texts, percent), "links"))

    # Ids with several texts join their classes.
    twice = full.groupBy("doc_id").agg(F.min("digest").alias("d0"), F.max("digest").alias("d1")).filter("d0 <> d1").select("doc_id")
    shared = full.join(twice, "doc_id", "left_semi").select("doc_id", "digest").distinct().join(classes.select("digest", "rep"), "digest")
    final = components(edges.unionByName(shared.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))))
    by_class = classes.select("digest", "rep").join(final, F.col("rep") == F.col("node"), "left").select(F.col("digest").alias("d"), F.coalesce("component", "rep").alias("c"))
    joined = rows.join(by_class, (F.col("digest") == F.col("d")) & F.col("doc_id").isNotNull(), "left")
    component = F.coalesce("c", "doc_id")
    out = cut(joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")), "near-duplicates")
    forget_since(point, keep=(out,))  # registers, buckets and candidates' texts
    return out
