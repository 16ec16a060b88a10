"""Quality classifier: document evidence shrunk through host and path posteriors (hierarchical empirical Bayes).

Document evidence comes from hashed n-grams: each word, pair of words and run of three bytes of a text falls into one of
a fixed number of buckets. A bounded sample of labelled rows gives each bucket the logarithm of how much more often good
texts than bad ones hold it; from the means of these over a text, the shares of n-grams that no labelled text had, and
some plain counts, a logistic model makes P(good). Sums of that evidence by host and by (host, path) become posterior
means: a host's is pulled to the global mean, a path's to its host's, each by a strength estimated from the spread
between sites (method of moments), so sparse sites stay near their parents. A document's own odds are then multiplied by
how its site's odds differ from the global odds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import batches, cut
from .shingles import mix, word_hashes

#: Labelled rows that the document model is fitted on at most (the smallest hashes of their ids).
SAMPLE_ROWS = 20_000
#: Site tables up to this many rows are broadcast; larger ones are joined by shuffle, whose hot keys Spark splits.
BROADCAST_SITES = 20_000
#: Buckets of words, pairs of words and runs of three bytes.
BUCKETS = (1 << 14, 1 << 14, 1 << 12)
#: n-grams of no opinion that every text is taken to have beside its own.
FEW = 8
#: Ridge penalty of the logistic model.
RIDGE = 0.02
#: Weight of a text that every bucket is taken to have had in either class.
PRIOR = 0.05
COUNTS = ("upper", "symbols", "pipes", "echo", "digits", "word_length", "log_words")
FEATURES = ("words", "pairs", "bytes", "new_words", "new_pairs", "new_bytes", *COUNTS)
#: Texts are read in pieces of about so many bytes, which end at white space; pairs and runs don't cross them.
PIECE = 1 << 19

_KINDS = np.zeros((256, 4), np.float32)
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"!$%&#*@^~", b"|<>{}[]\\", b"0123456789")):
    _KINDS[list(_chars), _k] = 1
_BYTE_FACTORS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def pieces(texts: list[str | None]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Texts joined by line feeds, some at a time: the bytes, each part's start among them, and whose text it is."""
    held, owner, size = [], [], 0
    for k, t in enumerate(texts):
        raw, at = (t or "").encode(), 0
        while at < len(raw):
            end = min(len(raw), at + PIECE)
            while end < len(raw) and raw[end] not in b" \t\n\r\v\f":
                end += 1
            held.append(raw[at:end])
            owner.append(k)
            size, at = size + end - at, end
            if size >= PIECE:
                yield b"\n".join(held), np.cumsum([0, *(len(x) + 1 for x in held[:-1])]), np.array(owner)
                held, owner, size = [], [], 0
    if held:
        yield b"\n".join(held), np.cumsum([0, *(len(x) + 1 for x in held[:-1])]), np.array(owner)


def _total(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the stretches of ``values`` that begin at the sorted places ``at``; 0 for empty ones."""
    upto = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return upto[np.append(at[1:], len(values))] - upto[at]


def grams(raw: bytes, start: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
    """Of joined parts: each part's plain sums; for each family the buckets, where parts begin among them, which count; word hashes' sums."""
    data = np.frombuffer(raw, np.uint8)
    at, h = word_hashes(data)
    first = np.searchsorted(at, start)
    inside = np.ones(max(len(h) - 1, 0), bool)  # a pair within one part
    inside[first[(first > 0) & (first < len(h))] - 1] = False
    pair = mix(h[:-1] * _PAIR + h[1:]) if len(h) > 1 else np.zeros(0, np.uint64)
    b = data.astype(np.uint32)
    run = (b[:-2] * _BYTE_FACTORS[0]) ^ (b[1:-1] * _BYTE_FACTORS[1]) ^ (b[2:] * _BYTE_FACTORS[2]) if len(b) > 2 else np.zeros(0, np.uint32)
    run = (run ^ (run >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    whole = np.ones(len(run), bool)  # a run within one part
    for back in (1, 2, 3):
        edge = start[1:] - back
        whole[edge[(edge >= 0) & (edge < len(whole))]] = False
    families = [
        ((h >> np.uint64(64 - 14)).astype(np.int64), first, np.ones(len(h), bool)),
        ((pair >> np.uint64(64 - 14)).astype(np.int64), np.minimum(first, len(pair)), inside),
        ((run >> np.uint32(32 - 12)).astype(np.int64), np.minimum(start, len(run)), whole),
    ]
    echo = np.zeros(len(h))
    echo[: len(inside)] = inside & (h[:-1] == h[1:]) if len(h) > 1 else 0
    plain = np.column_stack([_total(_KINDS[data], start), _total(echo, first), np.diff(np.append(first, len(h))), np.diff(np.append(start, len(data) + 1)) - 1])
    return plain, families, h


def bucket_weights(texts: list[str | None], good: np.ndarray) -> np.ndarray:
    """(class, bucket) sums of each text's shares of its n-grams in the buckets; families lie one after another."""
    out = np.zeros((2, sum(BUCKETS)))
    for raw, start, owner in pieces(texts):
        _, families, _ = grams(raw, start)
        base = 0
        for (bucket, first, ok), width in zip(families, BUCKETS, strict=True):
            n = np.diff(np.append(first, len(bucket)))
            part = np.repeat(np.arange(len(start)), n)
            share = ok / np.maximum(_total(ok.astype(float), first), 1)[part]
            for y in (0, 1):
                mine = good[owner[part]] == y
                out[y, base : base + width] += np.bincount(bucket[mine], share[mine], width)
            base += width
    return out


def features(texts: list[str | None], tables: np.ndarray) -> np.ndarray:
    """(texts, FEATURES); ``tables``: each bucket's log ratio, and whether it is new (no labelled text had it). Null texts count as empty, which have zeros."""
    sums, counted, plain = np.zeros((len(texts), 6)), np.zeros((len(texts), 3)), np.zeros((len(texts), 7))
    for raw, start, owner in pieces(texts):
        own, families, _ = grams(raw, start)
        np.add.at(plain, owner, own)
        base = 0
        for k, ((bucket, first, ok), width) in enumerate(zip(families, BUCKETS, strict=True)):
            ratio, new = tables[:, base : base + width]
            np.add.at(sums[:, k], owner, _total(np.where(ok, ratio[bucket], 0), first))
            np.add.at(sums[:, 3 + k], owner, _total(np.where(ok, new[bucket], 0), first))
            np.add.at(counted[:, k], owner, _total(ok.astype(float), first))
            base += width
    upper, symbols, pipes, digits, echo, words, size = plain.T
    n, w = np.maximum(size, 1), np.maximum(words, 1)
    means = sums / (np.tile(counted, 2) + FEW)  # a few n-grams say little
    return np.column_stack([means, upper / n, symbols / w, pipes / w, echo / w, digits / n, np.minimum(n / w / 20, 1), np.log1p(words) / 12])


@dataclass(frozen=True)
class DocumentModel:
    """Logistic weights over FEATURES, intercept first, and the tables of ``features`` (float32); without labels it says 0.5 of every text."""

    weights: tuple[float, ...] = (0.0,) * (1 + len(FEATURES))
    tables: bytes = b""

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        """P(good) of each text, between 0.0001 and 0.9999; 0.0001 for null texts and texts of white space alone."""
        w = np.array(self.weights)
        tables = np.frombuffer(self.tables, np.float32).reshape(2, -1) if self.tables else np.zeros((2, sum(BUCKETS)), np.float32)
        score = w[0] + features(texts, tables) @ w[1:]
        p = 1 / (1 + np.exp(-np.clip(score, -9.2, 9.2)))
        blank = np.array([not t or t.isspace() for t in texts], bool)
        return np.where(blank, 0.0001, p)

    def score(self, df: DataFrame, text_col: str) -> DataFrame:
        """Adds p to the rows: texts alone go to Python workers, a batch at a time."""

        @F.arrow_udf(returnType=DoubleType())
        def p(text: pa.Array) -> pa.Array:
            return pa.array(self.probabilities(text.to_pylist()), pa.float64())

        return df.withColumn("p", p(F.col(f"`{text_col}`").cast("string")))


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (intercept first) of a ridge logistic model by damped Newton steps, on standardised columns."""
    mean, std = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.column_stack([np.ones(len(x)), (x - mean) / std])
    w, ridge = np.zeros(z.shape[1]), np.full(z.shape[1], RIDGE)
    ridge[0] = 1e-3
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + np.diag(ridge), z.T @ (p - y) + ridge * w)
        w -= step * min(1.0, 3.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    slopes = w[1:] / std
    return np.array([w[0] - slopes @ mean, *slopes])


def log_ratios(weights: np.ndarray) -> np.ndarray:
    """(log ratio of each bucket's share among good and bad texts, whether it is new: neither had it); 0 for new ones."""
    out, base = np.zeros((2, weights.shape[1]), np.float32), 0
    for width in BUCKETS:
        own = weights[:, base : base + width]
        share = (own + PRIOR) / (own.sum(axis=1, keepdims=True) + PRIOR * width)
        neutral = np.log(PRIOR / (own[1].sum() + PRIOR * width)) - np.log(PRIOR / (own[0].sum() + PRIOR * width))
        new = own.sum(axis=0) == 0
        out[0, base : base + width] = np.where(new, 0, np.log(share[1]) - np.log(share[0]) - neutral)
        out[1, base : base + width] = new
        base += width
    return out


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DocumentModel:
    """Fits the document model on the ``sample_rows`` labelled documents whose hashed ids are smallest.

    An id with several labels has the largest, an id with several texts all of them. The sample's texts are written once;
    the logistic weights are fitted on each half's features by the bucket ratios of the other half, and used with the means
    of both tables. Without labels of both kinds in both halves the model says 0.5. To the driver come bucket sums of a few tasks
    and FEATURES of the sample's rows.
    """
    chosen = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    half = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(2)).cast("int").alias("half")
    seen = cut(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select((F.col("y") > 0).cast("int").alias("y"), half, F.col("text").cast("string").alias("text")).repartition(8), "quality-sample")  # a shuffle of the few rows: the scan keeps its tasks

    def sums(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 2, sum(BUCKETS)))  # half, class, bucket
        for b in it:
            half = b.column(0).to_numpy()
            for k in (0, 1):
                own = b.filter(pa.array(half == k))
                total[k] += bucket_weights(own.column(2).to_pylist(), own.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["w"])

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            half = b.column(0).to_numpy()
            for k in (0, 1):  # by the ratios of the other half
                own = b.filter(pa.array(half == k))
                yield pa.RecordBatch.from_arrays([own.column(1), pa.array(list(features(own.column(2).to_pylist(), tables[1 - k])), pa.list_(pa.float64()))], ["y", "x"])

    columns = seen.select("half", "y", "text")
    weights = np.zeros((2, 2, sum(BUCKETS)))
    for r in batches(columns, sums, "w binary").collect():  # one row a task of the bounded sample
        weights += np.frombuffer(r["w"]).reshape(weights.shape)
    tables = [log_ratios(w) for w in weights]
    got = sorted((r["y"], *r["x"]) for r in batches(columns, rows, "y int, x array<double>").collect())  # at most sample_rows rows
    data = np.array(got, dtype=np.float64).reshape(len(got), 1 + len(FEATURES))
    if not weights.sum(axis=2).all():
        return DocumentModel()
    return DocumentModel(tuple(map(float, logistic(data[:, 1:], data[:, 0]))), ((tables[0] + tables[1]) / 2).tobytes())


@dataclass(frozen=True)
class Sites:
    """Posterior means by (host, path) and the global mean."""

    table: DataFrame  # host, path, host_posterior, path_posterior
    rows: int
    mean: float


def _strength(groups: DataFrame, mean: Column) -> Column:
    """Strength of a Beta prior (in documents) from the spread of group means around ``mean``, between 1 and 1e6."""
    within = F.col("m") * (1 - F.col("m")) / F.col("n")
    tau = F.greatest(F.avg((F.col("m") - mean) * (F.col("m") - mean) - within), F.lit(1e-6))
    return F.least(F.greatest(F.avg(mean * (1 - mean)) / tau - 1, F.lit(1.0)), F.lit(1e6))


def posteriors(scored: DataFrame) -> Sites:
    """Site posteriors of (host, path, p); only grouped sums are shuffled, and two numbers reach the driver."""
    cells = cut(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")), "quality-cells")
    hosts = cells.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).withColumn("m", F.col("s") / F.col("n"))
    total = cells.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.count("*").alias("c")).first()
    if not total["n"]:
        return Sites(cells.select("host", "path", F.col("s").alias("host_posterior"), F.col("s").alias("path_posterior")), 0, 0.5)
    mean = total["s"] / total["n"]
    kappa = hosts.agg(_strength(hosts, F.lit(mean)).alias("k")).first()["k"]
    hosts = hosts.select(F.col("host").alias("h"), ((F.col("s") + kappa * mean) / (F.col("n") + kappa)).alias("host_posterior"))
    joined = cells.withColumn("m", F.col("s") / F.col("n")).join(hosts, F.col("host").eqNullSafe(F.col("h")))
    inner = joined.agg(_strength(joined, F.col("host_posterior")).alias("k")).first()["k"]
    out = joined.select("host", "path", "host_posterior", ((F.col("s") + inner * F.col("host_posterior")) / (F.col("n") + inner)).alias("path_posterior"))
    return Sites(cut(out, "quality-sites"), total["c"], float(mean))


def judge(scored: DataFrame, sites: Sites, threshold: float = 0.5) -> DataFrame:
    """Adds host_posterior, path_posterior, p_quality and kept to rows of (host, path, p, ...)."""
    table = sites.table.select(F.col("host").alias("__h"), F.col("path").alias("__p"), "host_posterior", "path_posterior")
    table = F.broadcast(table) if sites.rows <= BROADCAST_SITES else table
    logit = lambda c: F.log(F.least(F.greatest(c, F.lit(1e-4)), F.lit(1 - 1e-4)) / (1 - F.least(F.greatest(c, F.lit(1e-4)), F.lit(1 - 1e-4))))
    joined = scored.join(table, F.col("host").eqNullSafe(F.col("__h")) & F.col("path").eqNullSafe(F.col("__p")), "left").drop("__h", "__p")
    p = 1 / (1 + F.exp(-(logit(F.col("p")) + logit(F.col("path_posterior")) - logit(F.lit(sites.mean)))))
    return joined.withColumn("p_quality", p).withColumn("kept", F.col("p_quality") >= threshold)


def classify(docs: DataFrame, model: DocumentModel, host: Column | None = None, path: Column | None = None, threshold: float = 0.5) -> DataFrame:
    """doc_id, host, path, p_document, host_posterior, path_posterior, p_quality and kept of every row of ``docs``.

    host and path: columns of ``docs``, by default its source and language; null is a site of its own. Null and blank
    texts have the least evidence (0.0001) and are rejected. Texts are read whole and once, however long: the evidence is
    written, without texts. Repeated rows are judged alike and repeated; an empty table gives no rows; other columns are
    ignored, whatever their names.
    """
    host, path = F.col("source") if host is None else host, F.col("lang") if path is None else path
    scored = cut(model.score(docs.select("doc_id", host.alias("host"), path.alias("path"), "text"), "text").drop("text"), "quality-evidence")
    return judge(scored, posteriors(scored), threshold).withColumnRenamed("p", "p_document")


def keep_good(docs: DataFrame, model: DocumentModel, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, whole and with the same columns, whatever their names.

    The rows are written with their evidence, so that texts are scored once; they are never shuffled. Nulls, long texts,
    equal rows and empty tables as in ``classify``.
    """
    row = F.struct(*(F.col(f"`{c}`").alias(c) for c in docs.columns)).alias("row")
    scored = cut(model.score(docs.select(row, F.col("source").alias("host"), F.col("lang").alias("path"), F.col("text").alias("t")), "t").drop("t"), "quality-evidence")
    sites = posteriors(scored.select("host", "path", "p"))
    return judge(scored, sites, threshold).filter("kept").select(*(F.col("row")[c].alias(c) for c in docs.columns))
