"""Ranked lexical search over a tiered index: postings of high impact first, lower tiers only for items without a proof.

One pass over the documents' bytes counts their words and those of the items' terms. A posting's *impact* is its share of
the score without the term's weight, so it can be known before any query. Counts of impacts by term and level cut each
term's postings into tiers: the highest levels, as many postings as a 32nd of the documents (and 256), then as many as a
quarter of them, then the rest. So rare terms are whole in the first tier, and only of frequent ones, which weigh little,
is anything left below. The index is a table of documents with the terms and impacts of each tier in columns of their own,
so that a tier is read without those below.

Tier by tier, the documents' partial scores give lower bounds; the largest impact that a term has below the tier, its
residual, bounds what may be missing. An item is proven when a document that no tier so far has shown can't reach the
k-th best lower bound, and few documents have an upper bound that does; these few are scored with all their postings.
Items without that proof go on to the next tier by themselves; the last has no residuals, so its partial scores are exact.

Items are dealt by a hash into blocks of bounded size; all documents meet every block. Only a block's terms, their weights
and bounds, and its items' thresholds pass through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.window import Window

from strandloom.lineage import forget

from . import terms
from .common import batches, cut

#: (item, term) pairs in a block: some tens of megabytes on the driver and in a worker.
BLOCK_PAIRS = 200_000
#: Parts of the number of documents that a term's postings fill the tiers with, and the least number of them.
SHARES, LEAST = (32, 4), 256
TIERS = len(SHARES) + 1
#: Levels into which impacts (below 1,000,000) are counted.
LEVELS = 64
#: Documents of a task that one item may keep as candidates before the last tier; with more it goes on to the next.
CANDIDATES = 256
#: Cells (document, item) and contributions that are summed at once.
CELLS = 2_000_000


def impact(tf, m):
    """A posting's impact, of numpy arrays."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class _Terms:
    """A block's terms (by sorted hash), the items that hold each, and, once they are known, weights, tiers and residuals."""

    def __init__(self, pairs: list[tuple[int, str]], n_items: int):
        words = sorted({t for _, t in pairs})
        h = np.zeros(len(words), np.uint64)
        for which, _, _, x in terms.pieces([w.encode() for w in words]):
            h[which] = x
        order = np.argsort(h)
        place = {words[k]: i for i, k in enumerate(order.tolist())}
        self.hashes, self.n_items = h[order], n_items
        term, item = np.array([place[t] for _, t in pairs], np.int64), np.array([i for i, _ in pairs], np.int64)
        by = np.lexsort((item, term))
        self.term, self.item = term[by], item[by]

    def finish(self, n_docs: int, n_words: int, rows: list) -> _Terms:
        v = len(self.hashes)
        self.n_docs, self.n_words = n_docs, n_words
        self.weight, self.floor, self.residual = np.zeros(v), np.zeros((TIERS, v), np.int64), np.zeros((TIERS, v))
        for r in rows:
            self.weight[r["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
            for t in range(TIERS - 1):
                self.floor[t, r["term"]], self.residual[t, r["term"]] = r[f"floor{t}"], r[f"residual{t}"]
        return self

    def m(self, n: np.ndarray) -> np.ndarray:
        return 10 + (90 * n * self.n_docs) // max(1, self.n_words)

    def missing(self, tier: int) -> np.ndarray:
        """By item, the most that a document can have which shows in no tier so far."""
        return np.bincount(self.item, (self.weight * self.residual[tier])[self.term], self.n_items)


def _term_column(col: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(col, F.lit(terms.WORD_ANY_CASE), F.lit(0)), lambda w: F.translate(w, terms.UPPER, terms.LOWER)))


def _forward(docs: DataFrame, block) -> DataFrame:
    """key, doc_id, n (words) and the block's terms with their counts, of each document (key, doc_id, text)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = block.value.hashes
        v = max(1, len(vocabulary))
        for b in it:
            texts = [(t or "").encode() for t in b.column(2).to_pylist()]
            n, cells, counts = np.zeros(len(texts), np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for which, _, _, h in terms.pieces(texts):
                n += np.bincount(which, minlength=len(texts))
                at = terms.lookup(vocabulary, h)
                cell, count = np.unique((which * v + at)[at >= 0], return_counts=True)
                cells.append(cell)
                counts.append(count)
            cell, back = np.unique(np.concatenate(cells), return_inverse=True)  # a long text's pieces meet
            tf = np.bincount(back, np.concatenate(counts), len(cell))
            offsets = pa.array(np.searchsorted(cell, np.arange(len(texts) + 1) * v), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (cell % v, tf)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n), *lists], ["key", "doc_id", "n", "terms", "tfs"])

    return batches(docs, run, "key long, doc_id long, n long, terms array<int>, tfs array<int>")


def _bounds(forward: DataFrame, n_docs: int, n_words: int) -> DataFrame:
    """term, df, and for each tier but the last the least impact in it and the largest below it. One shuffle of counts."""
    m = 10 + F.expr(f"(90 * n * {n_docs}L) div {max(1, n_words)}L")
    rows = forward.select(m.alias("m"), F.explode(F.arrays_zip("terms", "tfs")).alias("p"))
    rows = rows.select(F.col("p.terms").alias("term"), F.expr("(1000000000L * p.tfs) div (1000L * p.tfs + 8 * m)").alias("impact"))
    levels = rows.groupBy("term", F.expr(f"impact * {LEVELS} div 1000000").alias("level")).agg(F.count("*").alias("n"), F.max("impact").alias("most"), F.min("impact").alias("least"))
    by = Window.partitionBy("term")  # at most LEVELS rows each
    levels = levels.withColumns({"df": F.sum("n").over(by), "before": F.sum("n").over(by.orderBy(F.desc("level"))) - F.col("n")})
    out = [F.first("df").alias("df")]
    for t, share in enumerate(SHARES):
        inside = F.col("before") < max(LEAST, n_docs // share)
        out += [F.min(F.when(inside, F.col("least"))).alias(f"floor{t}"), F.coalesce(F.max(F.when(~inside, F.col("most"))), F.lit(0)).alias(f"residual{t}")]
    return levels.groupBy("term").agg(*out)


def _index(forward: DataFrame, block) -> DataFrame:
    """key, doc_id, and terms and impacts of each tier."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = block.value
        for b in it:
            term, tf = (b.column(k).flatten().to_numpy() for k in (3, 4))
            size = np.diff(b.column(3).offsets.to_numpy())
            doc = np.repeat(np.arange(b.num_rows), size)
            value = impact(tf.astype(np.int64), x.m(b.column(2).to_numpy())[doc])
            tier = np.full(len(term), TIERS - 1)
            for t in range(TIERS - 2, -1, -1):
                tier[value >= x.floor[t][term]] = t
            columns = []
            for t in range(TIERS):
                here = tier == t
                offsets = pa.array(np.searchsorted(doc[here], np.arange(b.num_rows + 1)), pa.int32())
                columns += [pa.ListArray.from_arrays(offsets, pa.array(c[here].astype(np.int32))) for c in (term, value)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *columns], ["key", "doc_id", *(f"{c}{t}" for t in range(TIERS) for c in ("terms", "impacts"))])

    return batches(forward, run, "key long, doc_id long, " + ", ".join(f"terms{t} array<int>, impacts{t} array<int>" for t in range(TIERS)))


class _Best:
    """Candidates of each item: all whose upper bound reaches the k-th best lower bound so far; at the last tier the k best."""

    def __init__(self, limit: np.ndarray, k: int, last: bool):
        self.k, self.last = k, last
        self.limit, self.open = limit.copy(), np.zeros(len(limit), bool)
        self.rows, self.size = [], 0

    def add(self, *columns: np.ndarray) -> None:
        """Rows of (item, lower, upper, no id, doc_id, key)."""
        self.rows.append(columns)
        self.size += len(columns[0])
        if self.size > CELLS // 4:
            self.prune()

    def prune(self) -> tuple[np.ndarray, ...]:
        item, low, up, none, doc, key = (np.concatenate(c) for c in zip(*self.rows, strict=True)) if self.rows else (np.zeros(0, np.int64),) * 6
        order = np.lexsort((key, doc, none, -low, item))
        item, low, up, none, doc, key = (c[order] for c in (item, low, up, none, doc, key))
        first = np.flatnonzero(np.diff(item, prepend=-1))
        rank = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
        at = rank == self.k - 1
        self.limit[item[at]] = np.maximum(self.limit[item[at]], low[at])
        keep = rank < self.k if self.last else up >= self.limit[item]
        if not self.last:
            self.open |= np.bincount(item[keep], minlength=len(self.open)) > CANDIDATES
            keep &= ~self.open[item]
        out = tuple(c[keep] for c in (item, low, up, none, doc, key))
        self.rows, self.size = [out], int(keep.sum())
        return out


def _scored(index: DataFrame, block, asked: np.ndarray, known: np.ndarray, tier: int, k: int) -> DataFrame:
    """Candidates (item, key, doc_id, low, up) of the ``asked`` items by the tiers up to ``tier``, and (item) alone of those with too many.

    known: a lower bound of each item's k-th score, from the tiers before.
    """
    last = tier == TIERS - 1
    columns = [c for t in range(tier + 1) for c in (f"terms{t}", f"impacts{t}")]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = block.value
        narrow = np.full(x.n_items, -1)
        narrow[asked] = np.arange(len(asked))
        mine = narrow[x.item] >= 0
        item, begin = narrow[x.item[mine]], np.searchsorted(x.term[mine], np.arange(len(x.hashes) + 1))
        missing, residual = x.missing(tier)[asked], x.residual[tier]
        best = _Best(known, k, last)
        docs_at_once = max(1, CELLS // max(1, len(asked)))
        for b in it:
            keys, ids = b.column(0).to_numpy(), b.column(1)
            none = np.asarray(ids.is_null())
            ids = ids.fill_null(0).to_numpy()
            parts = []
            for t in range(tier + 1):
                size = np.diff(b.column(2 + 2 * t).offsets.to_numpy())
                parts.append((np.repeat(np.arange(b.num_rows), size), b.column(2 + 2 * t).flatten().to_numpy(), b.column(3 + 2 * t).flatten().to_numpy()))
            doc, term, value = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.argsort(doc, kind="stable")
            doc, term, value = doc[order], term[order], value[order]
            made = np.concatenate(([0], np.cumsum((begin[1:] - begin[:-1])[term])))  # contributions before each posting
            at = 0
            while at < b.num_rows:
                lo = int(np.searchsorted(doc, at))
                more = int(np.searchsorted(made, made[lo] + CELLS, side="right")) - 1  # postings that fit
                end = b.num_rows if more >= len(doc) else max(at + 1, int(doc[more]))
                end = min(end, at + docs_at_once)
                hi = int(np.searchsorted(doc, end))
                d, t, v = doc[lo:hi] - at, term[lo:hi], value[lo:hi].astype(float)
                n = (begin[1:] - begin[:-1])[t]
                which = np.repeat(np.arange(hi - lo), n)
                to = item[np.repeat(begin[:-1][t] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(int(n.sum()))]
                cell = d[which] * len(asked) + to
                # Sums of whole numbers below 2 ** 53: exact in doubles.
                low = np.bincount(cell, (v * x.weight[t])[which], (end - at) * len(asked))
                up = low if last else np.bincount(cell, ((v - residual[t]) * x.weight[t])[which], (end - at) * len(asked)) + np.tile(missing, end - at)
                reach = np.tile(np.where(best.open, np.inf, best.limit), end - at)
                found = np.flatnonzero((low > 0) & (up >= reach))
                row = found // len(asked) + at
                best.add(found % len(asked), low[found], up[found], none[row], ids[row], keys[row])
                at = end
        item, low, up, none, doc, key = best.prune()
        open_ = np.flatnonzero(best.open)
        blank = np.zeros(len(open_), np.int64)
        gone = np.concatenate((np.zeros(len(item), bool), np.ones(len(open_), bool)))
        whole = lambda c: pa.array(np.concatenate((c.astype(np.int64), blank)), mask=gone)
        yield pa.RecordBatch.from_arrays([pa.array(asked[np.concatenate((item, open_)).astype(np.int64)], pa.int32()), whole(key), pa.array(np.concatenate((doc.astype(np.int64), blank)), mask=gone | np.concatenate((none.astype(bool), blank.astype(bool)))), whole(low), whole(up)], ["item", "key", "doc_id", "low", "up"])

    return batches(index.select("key", "doc_id", *columns), run, "item int, key long, doc_id long, low long, up long")


def _best(rows: DataFrame, k: int) -> DataFrame:
    """The k best of each item, ranked; Spark keeps k of each task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "key"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k)


def _whole_scores(rows: DataFrame, block) -> DataFrame:
    """Scores of (item, key, doc_id, all tiers' columns) from all postings."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = block.value
        order = np.argsort(x.item, kind="stable")
        own, begin = x.term[order], np.searchsorted(x.item[order], np.arange(x.n_items + 1))
        for b in it:
            scores = []
            for r in range(b.num_rows):
                i = b.column(0)[r].as_py()
                mine, total = own[begin[i] : begin[i + 1]], 0
                for t in range(TIERS):
                    term, value = (np.asarray(b.column(3 + 2 * t + c)[r].values) for c in (0, 1))
                    here = np.isin(term, mine)
                    total += int((value[here].astype(np.int64) * x.weight[term[here]].astype(np.int64)).sum())
                scores.append(total)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(scores, pa.int64())], ["item", "key", "doc_id", "score"])

    return batches(rows, run, "item int, key long, doc_id long, score long")


def _search_block(docs: DataFrame, pairs: list[tuple[int, str]], n_items: int, k: int, told: list[int] | None) -> DataFrame | None:
    """item, doc_id, score, rank over all documents (key, doc_id, text); None where nothing can score."""
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    found = _Terms(pairs, n_items)
    forward = cut(_forward(docs, sc.broadcast(found)), "forward")
    sums = forward.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    if not sums["docs"]:
        return None
    rows = _bounds(forward, sums["docs"], sums["words"]).collect()  # one row a term of the block
    block = sc.broadcast(found.finish(sums["docs"], sums["words"], rows))
    index = cut(_index(forward, block), "tiers")
    forget(forward)
    asked, out, known = np.unique(found.item), [], np.zeros(n_items)
    for tier in range(TIERS):
        if not len(asked):
            break
        if told is not None:
            told.append(len(asked))
        rows = cut(_scored(index, block, asked, known[asked], tier, k), "candidates")
        if tier == TIERS - 1:
            out.append(rows.select("item", "key", "doc_id", F.col("low").alias("score")))
            break
        # Thresholds: one row an item. An item with a task that had too many candidates has no proof.
        open_ = {r["item"] for r in rows.filter("key is null").select("item").distinct().collect()}
        best = _best(rows.filter("key is not null").withColumn("score", F.col("low")), k).groupBy("item").agg(F.min("score").alias("limit"), F.count("*").alias("n"))
        limit = {r["item"]: r["limit"] for r in best.collect() if r["n"] == k}
        for i, x in limit.items():
            known[i] = max(known[i], x)
        missing = found.missing(tier)
        proven = [(i, x) for i, x in limit.items() if i not in open_ and missing[i] < x]
        if proven:
            few = rows.join(F.broadcast(spark.createDataFrame(proven, "i int, least long")), F.col("item") == F.col("i")).filter("up >= least")
            few = cut(few.select("item", F.col("key").alias("k")), "proven")
            tiers = [f"{c}{t}" for t in range(TIERS) for c in ("terms", "impacts")]
            out.append(_whole_scores(few.join(index, F.col("k") == F.col("key")).select("item", "key", "doc_id", *tiers), block))
            asked = np.setdiff1d(asked, [i for i, _ in proven])
    return _best(reduce(DataFrame.unionByName, out).filter("score > 0"), k) if out else None


def search(docs: DataFrame, items: DataFrame, k: int = 10, text_col: str = "text", doc_col: str = "doc_id", item_col: str = "item_id", item_text_col: str = "text", block_pairs: int = BLOCK_PAIRS, told: list[int] | None = None) -> DataFrame:
    """The k documents of highest score above 0 for each item: item, rank (from 1), document id, score.

    Terms, weights and scores are whole numbers as op12's contract states them. Equal scores go by ascending document id,
    null ids last; rows with one id are documents of their own, in any order. Null and empty texts have no terms; an item
    without terms has no rows. Rows of one item id (null ids too) are one item, with the terms of all of them. Texts of any
    length are read whole, in pieces; no other columns are read. Terms meet by 64-bit hashes: one of a billion different
    words is taken for one of a thousand terms with a probability of 5e-8. told: gets the number of items that each tier
    was asked for.
    """
    spark = docs.sparkSession
    src = docs.select(F.monotonically_increasing_id().alias("key"), F.col(f"`{doc_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = items.schema[item_col].dataType
    pairs = items.select(F.struct(F.col(f"`{item_col}`").alias("id")).alias("item"), F.explode(_term_column(F.col(f"`{item_text_col}`"))).alias("term")).distinct()
    pairs = cut(pairs, "item-terms")
    n = max(1, -(-pairs.count() // block_pairs))
    out = []
    for b in range(n):
        rows = pairs.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == b).select("item.id", "term").collect()
        ids = list(dict.fromkeys(r["id"] for r in rows))
        place = {x: i for i, x in enumerate(ids)}
        found = _search_block(src, [(place[r["id"]], r["term"]) for r in rows], len(ids), k, told) if ids else None
        if found is not None:
            names = F.broadcast(spark.createDataFrame([(i, x) for i, x in enumerate(ids)], StructType([StructField("i", IntegerType()), StructField("__id", kind)])))
            out.append(found.join(names, F.col("item") == F.col("i")).select(F.col("__id").alias(item_col), "rank", F.col("doc_id").alias(doc_col), "score"))
    if not out:
        return pairs.limit(0).select(F.col("item.id").alias(item_col), F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias(doc_col), F.lit(0).cast("bigint").alias("score"))
    return reduce(DataFrame.unionByName, out)
