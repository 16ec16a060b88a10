"""Nearest neighbours by randomly rotated one-bit codes with error bounds.

A vector is centred, scaled to unit length, padded with zeros to at least ``CODE_BITS`` dimensions and rotated at random;
its code is the signs of the result, one bit each, packed into 64-bit words. With f = |o|_1 / sqrt(D) (the code's own
inner product with the vector o) the estimate <code, q> / f of <o, q> is off by at most
sqrt(1 / f^2 - 1) * EPSILON / sqrt(D - 1) but for a vanishing share of rotations. The rotated query is held as integers of
``PLANES`` bits; an inner product with a code is then a weighted sum of the numbers of bits that a plane and the code
share. What the integers lose is part of the bound.

The index is a written table of codes and scalars, one row a different vector. A first scan of it gives each query its
best estimates, whose originals are fetched; their k-th exact distance is a limit. Where there are many blocks of codes,
a few of them give a first limit before, so that a block sends only what may lie within it. A second scan gives all vectors whose
least possible distance is within the limit, and only their originals are fetched too. The distances returned are
computed from original vectors in double precision, component by component in order. Queries go in blocks against blocks
of codes; equal vectors are one class on both sides. The centre is the mean of all vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import batches, cut, finite_vector

#: Standard deviations of the estimate that the bound allows for.
EPSILON = 3.0
#: Bits of a code at least, and of a component of a query.
CODE_BITS, PLANES = 512, 8
BLOCK_ROWS, QUERY_ROWS = 8_192, 4_096
#: The first scan fetches so many times k vectors a query and block, within a limit from so many blocks if there are many more.
FIRST, PILOT = 4, 4
SEED = 20


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """The first ``dim`` rows of a random orthogonal matrix over the code's bits, the same on every machine."""
    bits = max(CODE_BITS, -(-dim // 64) * 64)
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    return (q * np.sign(np.diag(r)))[:dim]


def directions(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rotated unit vectors of the rows of x less the centre, and their lengths; nan for a length beyond double's range."""
    with np.errstate(over="ignore", invalid="ignore"):
        o = x - centre
        norm = np.linalg.norm(o, axis=1)
        norm = np.where(np.isfinite(norm) & ((norm > 1e-140) | (norm == 0)) & (norm < 1e140), norm, np.nan)
        o = np.where(np.isnan(norm)[:, None], 0, o) / np.where((norm == 0) | np.isnan(norm), 1, norm)[:, None]
    return o @ turn, norm


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, distance to the centre and correction scalar f of the rows of x."""
    o, norm = directions(x, centre, turn)
    return np.packbits(o > 0, axis=1), norm, np.abs(o).sum(axis=1) / np.sqrt(turn.shape[1])


def bounds(codes: np.ndarray, norm: np.ndarray, f: np.ndarray, q: np.ndarray, centre: np.ndarray, epsilon: float = EPSILON) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query row: estimated and least possible squared distances to the vectors of the packed codes."""
    dim = q.shape[1]
    turn = rotation(dim)
    bits = turn.shape[1]
    words = np.ascontiguousarray(codes.view(np.uint64).T)  # one row a word: sums run along the vectors
    count = lambda w: np.bitwise_count(w).sum(axis=0, dtype=np.uint16).astype(np.int64)
    ones = count(words)
    o, q_norm = directions(q, centre, turn)
    f = np.where(f > 1e-9, f, 1.0)  # a vector at the centre has no direction and needs none
    off = np.sqrt(np.maximum(1 / f**2 - 1, 0)) * epsilon / np.sqrt(bits - 1) + 1e-6
    most = (1 << PLANES) - 1
    for r in range(len(q)):
        low = o[r].min()
        step = max((o[r].max() - low) / most, 1e-300)
        u = np.rint((o[r] - low) / step).astype(np.int64)
        held = low + step * u
        planes = np.stack([np.packbits((u >> k & 1).astype(np.uint8)) for k in range(PLANES)]).view(np.uint64)
        shared = np.zeros(len(norm), np.int64)
        for k in range(PLANES):
            shared += count(words & planes[k][:, None]) << k
        ip = (2 * (low * ones + step * shared) - held.sum()) / np.sqrt(bits) / f
        size = norm**2 + q_norm[r] ** 2
        near = size - 2 * norm * q_norm[r] * np.clip(ip, -1, 1)
        least = size - 2 * norm * q_norm[r] * np.minimum(ip + off + np.linalg.norm(o[r] - held) / f, 1.0) - 1e-9 * size
        # Lengths beyond the range say nothing: such vectors are always tried.
        yield np.where(np.isnan(near), -np.inf, near), np.where(np.isnan(least), -np.inf, least)


def exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distance of each row of x to the same row of q: double precision, components in order.

    Differences whose squares would leave double's range are scaled by a power of two first, others are not.
    """
    total = np.zeros(len(x))
    with np.errstate(over="ignore"):
        d = x - q
        most = np.abs(d).max(axis=1, initial=0)
        power = np.where(np.isfinite(most) & (most > 0) & ((most > 1e150) | (most < 1e-150)), np.frexp(most)[1], 0)
        half = power // 2
        d = np.ldexp(np.ldexp(d, -half[:, None]), (half - power)[:, None])
        for k in range(x.shape[1]):
            total += d[:, k] * d[:, k]
        return np.ldexp(np.ldexp(np.sqrt(total), half), power - half)


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def centres(src: DataFrame) -> dict[int, np.ndarray]:
    """Mean vector by length of vectors: one sum a task, added up by component."""

    def sums(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple[int, np.ndarray]] = {}
        for b in it:
            dims = b.column(0).to_numpy()
            for d in np.unique(dims).tolist():
                x = _matrix(b.filter(pa.array(dims == d)).column(1), int((dims == d).sum()))
                n, s = total.get(d, (0, np.zeros(d)))
                with np.errstate(over="ignore", invalid="ignore"):
                    total[d] = (n + len(x), s + x.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([n for n, _ in total.values()], pa.int64()), pa.array([s.tolist() for _, s in total.values()], pa.list_(pa.float64()))], ["dim", "n", "s"])

    each = batches(src.select(F.size("v").alias("dim"), "v"), sums, "dim int, n long, s array<double>").select("dim", "n", F.posexplode("s").alias("k", "s"))
    out: dict[int, np.ndarray] = {}
    for r in each.groupBy("dim", "k").agg((F.sum("s") / F.sum("n")).alias("m")).collect():  # one number a component
        out.setdefault(r["dim"], np.zeros(r["dim"]))[r["k"]] = r["m"] if r["m"] is not None and np.isfinite(r["m"]) else 0.0
    return out


def index(src: DataFrame, middle: dict[int, np.ndarray]) -> DataFrame:
    """(id, q, digest, dim, code, norm, f, v) of every vector; equal vectors (zero has one sign) have equal digests."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for b in it:
            dims = b.column(2).to_numpy()
            for d in np.unique(dims).tolist():
                part = b.filter(pa.array(dims == d))
                x = _matrix(part.column(3), part.num_rows) + 0.0
                bits, norm, f = encode(x, middle[d], turns.setdefault(d, rotation(d)))
                digest = [hashlib.blake2b(row.tobytes(), digest_size=16).digest() for row in x]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(digest, pa.binary()), part.column(2), pa.array([c.tobytes() for c in bits], pa.binary()), pa.array(norm), pa.array(f), pa.array(list(x), pa.list_(pa.float64()))],
                    ["id", "q", "digest", "dim", "code", "norm", "f", "v"],
                )

    return batches(src.select("id", "q", F.size("v").alias("dim"), "v"), run, "id long, q boolean, digest binary, dim int, code binary, norm double, f double, v array<double>")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", epsilon: float = EPSILON) -> DataFrame:
    """query_id, rank (from 1), the neighbour's id and score (Euclidean distance) of each query's k nearest other rows.

    Nearest first, ties to the smaller id; all candidates where there are fewer than k. Rows with the query's own id
    are no candidates. Vectors that are null, empty, all zeros, or hold null or non-finite components take no part, and
    vectors of different lengths are not compared. Repeated rows are one; an id with several vectors is one candidate at
    its nearest, and asks with one of them, chosen by a digest of the vector. Distances beyond double's range are infinite and
    last. Null ids take no part; other columns are left out; without queries or candidates (an empty table
    too) there are no rows.
    """
    spark = vectors.sparkSession
    src = vectors.filter(F.col(f"`{id_col}`").isNotNull() & finite_vector(F.col(f"`{vector_col}`")))
    src = src.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(is_query, F.lit(False)).alias("q"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    middle = centres(src)
    rows = cut(index(src, middle), "ann-index")
    own = rows.filter("q").groupBy(F.col("id").alias("query_id")).agg(F.min("digest").alias("asked"))
    asking = own.select("asked").distinct()
    fields = ("dim", "code", "norm", "f", "v")
    classes = cut(rows.groupBy("digest").agg(*(F.first(c).alias(c) for c in fields)), "ann-classes")
    asked = cut(classes.join(asking, F.col("digest") == F.col("asked")).select("asked", F.col("dim").alias("d"), F.col("v").alias("qv")), "ann-queries")
    total, queries = classes.count(), asked.count()
    if not queries:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    blocks, q_blocks = -(-total // BLOCK_ROWS), -(-queries // QUERY_ROWS)
    dealt = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # A block of codes goes to every block of queries, a query to every block of codes.
    codes = classes.select("dim", "digest", "code", "norm", "f").withColumn("i", dealt("digest", blocks)).withColumn("j", every(q_blocks))

    def scan(limits: DataFrame, choose, blocks: int = blocks) -> DataFrame:
        """(asked, digest, near) of what ``choose(estimates, least, limit)`` picks for each query in each of the first ``blocks`` blocks of codes."""
        sent = limits.withColumn("j", dealt("asked", q_blocks)).withColumn("i", every(blocks))

        def task(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            out_q, out_c, out_n = [], [], []
            if left.num_rows and right.num_rows:
                packed = np.frombuffer(b"".join(left.column("code").to_pylist()), np.uint8).reshape(left.num_rows, -1)
                norm, f = (left.column(c).to_numpy() for c in ("norm", "f"))
                names = left.column("digest").to_pylist()
                limit = right.column("most").to_numpy()
                q = _matrix(right.column("qv"), right.num_rows)
                for name, most, (near, least) in zip(right.column("asked").to_pylist(), limit, bounds(packed, norm, f, q, middle[key[0].as_py()], epsilon), strict=True):
                    got = choose(near, least, most)
                    out_q += [name] * len(got)
                    out_c += [names[c] for c in got]
                    out_n += near[got].tolist()
            return pa.table({"asked": pa.array(out_q, pa.binary()), "digest": pa.array(out_c, pa.binary()), "near": pa.array(out_n, pa.float64())})

        return codes.filter(F.col("i") < blocks).groupBy("dim", "i", "j").cogroup(sent.groupBy("d", "i", "j")).applyInArrow(task, "asked binary, digest binary, near double")

    def scored(pairs: DataFrame) -> DataFrame:
        """(asked, digest, score) of pairs, from original vectors."""

        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in it:
                dims = b.column(2).to_numpy()
                for d in np.unique(dims).tolist():
                    part = b.filter(pa.array(dims == d))
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(exact(_matrix(part.column(3), part.num_rows), _matrix(part.column(4), part.num_rows)))], ["asked", "digest", "score"])

        fetched = pairs.join(classes.select("digest", "v"), "digest").join(asked, "asked")
        return batches(fetched.select("asked", "digest", "d", "v", "qv"), run, "asked binary, digest binary, score double")

    few = FIRST * (k + 1)

    def limited(tried: DataFrame) -> DataFrame:
        """The queries with the square of the k-th distance that ``tried`` has for them, or none."""
        # Each different vector is a candidate of its own here; k + 1, since the query itself is one.
        kth = tried.withColumn("r", F.row_number().over(Window.partitionBy("asked").orderBy("score", "digest"))).filter(F.col("r") == k + 1).select(F.col("asked").alias("a"), F.col("score").alias("kth"))
        return asked.join(kth, F.col("asked") == F.col("a"), "left").select("asked", "d", "qv", F.coalesce(F.col("kth") * F.col("kth") * (1 + 1e-9), F.lit(float("inf"))).alias("most"))

    def first_best(limits: DataFrame, blocks: int, name: str) -> DataFrame:
        """Exact scores of the best estimates of each query over the blocks, of those that may lie within its limit."""

        def choose(near: np.ndarray, least: np.ndarray, most: float) -> np.ndarray:
            within = np.flatnonzero(least <= most)
            return within[np.argpartition(near[within], few)[:few]] if len(within) > few else within

        found = scan(limits, choose, blocks)
        found = found.withColumn("r", F.row_number().over(Window.partitionBy("asked").orderBy("near", "digest"))).filter(F.col("r") <= few)
        return cut(scored(found), name)

    limits = asked.withColumn("most", F.lit(float("inf")))
    if blocks > 2 * PILOT:
        limits = cut(limited(first_best(limits, PILOT, "ann-pilot")), "ann-limits")
    tried = first_best(limits, blocks, "ann-first")
    limits = limited(tried)
    rest = scan(limits, lambda near, least, most: np.flatnonzero(least <= most)).join(tried.select("asked", "digest"), ["asked", "digest"], "left_anti")
    found = tried.unionByName(scored(rest))
    # Of a class of equal vectors the k + 1 smallest ids are enough.
    members = rows.select("digest", "id").distinct().withColumn("r", F.row_number().over(Window.partitionBy("digest").orderBy("id"))).filter(F.col("r") <= k + 1).select("digest", "id")
    best = found.join(members, "digest").groupBy("asked", "id").agg(F.min("score").alias("score"))
    best = cut(best.withColumn("r", F.row_number().over(Window.partitionBy("asked").orderBy("score", "id"))).filter(F.col("r") <= k + 1).drop("r"), "ann-found")
    ranked = own.join(best, "asked").filter("id <> query_id").withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
