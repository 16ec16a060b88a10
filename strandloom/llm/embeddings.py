"""Embedding near-duplicates: int8 tile products with rigorous error bounds, uncertain pairs recomputed in double.

Equal vectors are one class. A unit vector u is held as s * q + e with int8 components q in [-127, 127]; its scale s,
|s * q| and |e| are computed, not estimated, and written beside q. So u.v lies within
|e_u| |s_v q_v| + |s_u q_u| |e_v| + |e_u| |e_v| of s_u s_v (q_u . q_v): pairs whose interval lies on one side of the
threshold are decided by the codes. Classes are dealt into tiles; each pair of tiles is one task, which gets codes alone.
It decides what it can, and names the vectors that have undecided pairs; in a second step these vectors' originals, and
no others, go to the task of the same pair of tiles, which computes the undecided pairs in full precision. No pair
leaves a task: only each vector's number of links and a spanning forest of them do.

The number of tile pairs grows with the square of the number of different vectors; that is the price of comparing all
with all whatever their labels. Each task stays at two tiles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, components, cut, finite_vector

TILE_ROWS = 4096
#: Rows of a tile that are multiplied at once; bounds the product in memory.
STRIP = 512
#: Covers the rounding of the bounds themselves.
SLACK = 1e-9


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows of x times powers of two that bring their largest components near 1: exact, and no square over- or underflows."""
    power = np.frexp(np.abs(x).max(axis=1))[1]
    half = -power // 2
    return np.ldexp(np.ldexp(x, half[:, None]), (-power - half)[:, None])


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors u of the rows of x: int8 q and scales s of u = s * q + e; bounds of |s * q| and |e|."""
    x = scaled(x)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    s = np.abs(u).max(axis=1) / 127
    q = np.rint(u / s[:, None])
    near = s[:, None] * q
    return q.astype(np.int8), s, np.linalg.norm(near, axis=1) + SLACK, np.linalg.norm(u - near, axis=1) + SLACK


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of x with the same row of y, in double precision."""
    x, y = scaled(x), scaled(y)
    dot = np.einsum("ij,ij->i", x, y)
    return dot / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))


Codes = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def compared(a: Codes, b: Codes, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of a and of b that may reach ``threshold``, and whether they surely do: a strip of a against all of b at a time."""
    (qa, sa, na, ea), (qb, sb, nb, eb) = a, b
    # Sums of products of int8 over the components are whole numbers, which float32 holds exactly below 2**24.
    kind = np.float32 if qa.shape[1] * 127 * 127 < 1 << 24 else np.float64
    right = qb.T.astype(kind)
    # No pair of a row can reach the threshold below this, whatever its own bound: one comparison sorts nearly all out.
    floor = ((threshold - ea * nb.max() - na * eb.max() - ea * eb.max() - 1e-5) / sa).astype(np.float32)
    scale = sb.astype(np.float32)
    for at in range(0, len(qa), STRIP):
        r = slice(at, at + STRIP)
        product = qa[r].astype(kind) @ right
        i, j = np.nonzero(product * scale >= floor[r, None])
        near = product[i, j].astype(np.float64) * sa[r][i] * sb[j]
        bound = ea[r][i] * nb[j] + na[r][i] * eb[j] + ea[r][i] * eb[j]
        may = near + bound >= threshold
        yield i[may] + at, j[may], (near - bound >= threshold)[may]


class Forest:
    """Smallest reachable row of each row under links given as arrays; no loop over links."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        n = len(self.label)
        while True:
            p, q = self.label[a], self.label[b]
            keys = np.unique(np.maximum(p, q)[p != q] * n + np.minimum(p, q)[p != q])
            if not len(keys):
                return
            a, b = keys // n, keys % n
            np.minimum.at(self.label, a, b)
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


def coded(src: DataFrame) -> DataFrame:
    """(id, digest, dim, code, scale, near, error) of every vector; equal vectors (zero has one sign) have equal digests."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            dims = b.column(1).to_numpy()
            for d in np.unique(dims).tolist():
                part = b.filter(pa.array(dims == d))
                x = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, d) + 0.0
                q, s, near, error = quantise(x)
                digest = [hashlib.blake2b(row.tobytes(), digest_size=16).digest() for row in x]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(digest, pa.binary()), part.column(1), pa.array([row.tobytes() for row in q], pa.binary()), pa.array(s), pa.array(near), pa.array(error)], CODED)

    return batches(src.select("id", F.size("v").alias("dim"), "v"), run, "id long, digest binary, dim int, code binary, scale double, near double, error double")


#: Columns of the written codes.
CODED = ["id", "digest", "dim", "code", "scale", "near", "error"]
_OUT = "a long, b long, n long, open boolean"


def _codes(table: pa.Table, rows: np.ndarray) -> Codes:
    code = np.frombuffer(b"".join(table.column("code").to_pylist()), np.int8).reshape(table.num_rows, -1)
    return code[rows], *(table.column(c).to_numpy()[rows] for c in ("scale", "near", "error"))


def _report(cls: np.ndarray, links: np.ndarray, forest: Forest, open_: np.ndarray) -> pa.Table:
    """Rows of a task's result: a vector's links (b null), an edge to its smallest reachable vector, a vector with open pairs."""
    some, hung, left = np.flatnonzero(links), np.flatnonzero(forest.label != np.arange(len(cls))), np.flatnonzero(open_)
    a = np.concatenate([cls[some], cls[hung], cls[left]])
    none = lambda k: [None] * k
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array([*none(len(some)), *cls[forest.label[hung]].tolist(), *none(len(left))], pa.int64()), "n": pa.array([*links[some].tolist(), *none(len(hung) + len(left))], pa.int64()), "open": pa.array([False] * (len(some) + len(hung)) + [True] * len(left), pa.bool_())})


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", tile_rows: int | None = None) -> DataFrame:
    """One row a vector: id, n_links (other vectors with a cosine of at least ``threshold``), component_id, kept.

    component_id is the smallest id that links reach, kept whether it is the row's own. Vectors that are null, empty,
    all zeros, or hold null or non-finite components link with nothing; so do vectors of different lengths with each
    other, and vectors without an id. Any finite magnitudes compare: components are scaled by powers of two first.
    Repeated ids are vectors of their own that count each other if they link. Other columns are left out. An
    empty table gives no rows.
    """
    tile_rows = tile_rows or TILE_ROWS
    src = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    good = src.filter(F.col("id").isNotNull() & finite_vector(F.col("v")))
    rows = cut(coded(good), "vector-codes")
    # Classes of equal vectors by their smallest id; a class is named by its own number, since ids may repeat.
    fields = CODED[2:]
    classes = rows.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), *(F.first(c).alias(c) for c in fields))
    classes = cut(classes.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    tiles = max(1, -(-classes.count() // tile_rows))
    numbered = classes.withColumn("t", F.pmod(F.xxhash64("digest"), F.lit(tiles)).cast("int"))

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))).withColumn("i", F.least("t", "o")).withColumn("j", F.greatest("t", "o")).drop("o")

    def sides(key: tuple, table: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
        t, i, j = table.column("t").to_numpy(), key[1].as_py(), key[2].as_py()
        return np.flatnonzero(t == i), np.flatnonzero(t == j), i == j

    def decide(key: tuple, table: pa.Table, x: np.ndarray | None) -> pa.Table:
        """Links of a pair of tiles: those that the codes decide, or, given original vectors, those that they leave open."""
        cls, copies = table.column("cls").to_numpy(), table.column("copies").to_numpy()
        left, right, same = sides(key, table)
        n = len(cls)
        links, open_, forest = np.zeros(n, np.int64), np.zeros(n, bool), Forest(n)
        for ii, jj, sure in compared(_codes(table, left), _codes(table, right), threshold) if len(left) and len(right) else ():
            r, c = left[ii], right[jj]
            if same:
                r, c, sure = r[r != c], c[r != c], sure[r != c]
            if x is None:
                open_[r[~sure]] = open_[c[~sure]] = True
                r, c = r[sure], c[sure]
            else:
                r, c = r[~sure], c[~sure]
                yes = np.zeros(len(r), bool)
                for k in range(0, len(r), 65536):
                    yes[k : k + 65536] = cosines(x[r[k : k + 65536]], x[c[k : k + 65536]]) >= threshold
                r, c = r[yes], c[yes]
            links += np.bincount(r, copies[c], n).astype(np.int64)
            if not same:
                links += np.bincount(c, copies[r], n).astype(np.int64)
            forest.link(r, c)
        return _report(cls, links, forest, open_)

    sent = placed(numbered.select("dim", "t", "cls", "copies", "code", "scale", "near", "error"))

    def coarse(key: tuple, table: pa.Table) -> pa.Table:
        out = decide(key, table, None)
        return out.append_column("i", pa.array([key[1].as_py()] * len(out), pa.int32())).append_column("j", pa.array([key[2].as_py()] * len(out), pa.int32()))

    first = cut(sent.groupBy("dim", "i", "j").applyInArrow(coarse, _OUT + ", i int, j int"), "vector-links")

    def fine(key: tuple, table: pa.Table) -> pa.Table:
        x = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        return decide(key, table, x)

    # Originals of the vectors with open pairs, once for each pair of tiles in which they have some.
    asked = first.filter("open").select(F.col("a").alias("cls"), "i", "j")
    vector_of = good.join(classes.select(F.col("rep").alias("id"), "cls", "digest").join(asked.select("cls").distinct(), "cls", "left_semi"), "id")
    exact = originals(vector_of).join(numbered.select("cls", "dim", "t", "copies", "code", "scale", "near", "error"), "cls").join(asked, "cls")
    second = cut(exact.groupBy("dim", "i", "j").applyInArrow(fine, _OUT), "vector-links")

    out = first.drop("i", "j").unionByName(second)
    links = out.filter("n is not null").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("n"))
    # Edges between classes; a class is known by its smallest id and its number, so the smallest class has the smallest id.
    name = classes.select("cls", F.struct("rep", "cls").alias("node"))
    edges = out.filter("b is not null").select("a", "b").join(name.select(F.col("cls").alias("a"), F.col("node").alias("na")), "a").join(name.select(F.col("cls").alias("b"), F.col("node").alias("nb")), "b")
    groups = components(edges.select(F.col("na").alias("a"), F.col("nb").alias("b"))).select(F.col("node.cls").alias("cls"), F.col("component.rep").alias("component"))
    by_class = classes.select("digest", "cls", "rep", "copies").join(links, "cls", "left").join(groups, "cls", "left")
    by_class = by_class.select("digest", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    linked = rows.select("id", "digest").join(by_class, "digest").select("id", "n_links", "component_id")
    alone = src.filter(F.col("id").isNull() | ~finite_vector(F.col("v"))).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    component = F.col("component_id")
    return linked.unionByName(alone).select(F.col("id").alias(id_col), F.col("n_links").cast("bigint").alias("n_links"), component, F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def originals(vectors: DataFrame) -> DataFrame:
    """(cls, v) of rows (id, v, cls, digest): the one vector of an id that has the digest, once."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            same = [hashlib.blake2b((np.array(v, np.float64) + 0.0).tobytes(), digest_size=16).digest() == d for v, d in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield b.select([1, 0]).filter(pa.array(same))

    return batches(vectors.select("v", "cls", "digest"), run, "cls long, v array<double>").dropDuplicates(["cls"])
