"""Substring dedup by hashing lines, short runs of sentences and chosen runs of words.

A text is cut at line breaks and after sentence ends. A unit is the shortest run of whole pieces, from one piece's
start on, that has at least ``min_words`` words; so every piece begins one unit, and a passage that begins in the
middle of someone's sentence still has its own whole sentences in units. Each line with a word in it is a unit of its own
too, however short, so that a repeated line is found whatever follows it; the lines of a repeated paragraph cover it. Passages that begin and end inside sentences are met by runs of exactly ``min_words`` words wherever
they lie: a run is chosen if its hash is the smallest of some ``SPREAD`` neighbours, which depends on the words alone, so
texts that share ``min_words + SPREAD - 1`` words share a chosen run. Units are normalised (words only, lower-cased, one space between), hashed to 128 bits and grouped
over all documents; the occurrence with the smallest (doc_id, start) is kept and the others go, with their offsets in
the original text. Units overlap, so a kept occurrence may itself be cut by the removal of another unit; then the others
of its kind stay where they are. So of every unit that is removed anywhere, the kept occurrence stays whole.
"""

from __future__ import annotations

import functools
import hashlib
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import batches, cut, whole

MIN_WORDS = 14
#: A line of so many words is a unit.
LINE_WORDS = 1
#: Of so many neighbouring runs of words at least one is a unit.
SPREAD = 12
#: Documents whose units tell which are common, at least, about (and one in STEP); so many of them hold a common unit; at
#: most so many units are salted, into so many parts at least, of about so many rows.
SAMPLE_DOCS, STEP, COMMON, COMMON_UNITS, SALTS, PART_ROWS = 2_000, 20_000, 8, 200_000, 32, 100_000
_PIECE = re.compile(r"[^.!?\n]*(?:[.!?]+|\n|\Z)")
_WORD = re.compile(r"\w+")
#: Two hashes a run; a hash is a sum of mixed values by powers of an odd factor, so that differences of running sums give
#: any word's and any run's.
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * _ODD
    return x ^ (x >> np.uint64(32))


@functools.cache
def _letters() -> tuple[np.ndarray, list[np.ndarray]]:
    """For each code point: whether it is part of a word, and a value of its small letter for each hash."""
    chars = [chr(c) for c in range(sys.maxunicode + 1)]
    small = np.array([ord(x) if len(x := c.lower()) == 1 else ord(c) for c in chars], np.uint64)
    return np.array([c == "_" or c.isalnum() for c in chars]), [_mix((small + np.uint64(1)) * np.uint64(f)) for f in _FACTORS]


@functools.cache
def _powers(factor: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of a factor and of its inverse, modulo 2**64."""
    return tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full((1 << bits) - 1, f, np.uint64))]) for f in (factor, pow(factor, -1, 1 << 64)))


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, factor: int) -> np.ndarray:
    """A hash of each stretch of ``values``, wherever it lies."""
    up, down = _powers(factor, max(12, len(values).bit_length()))
    upto = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=upto[1:])
    return (upto[ends] - upto[starts]) * down[starts]


def _extremes(x: np.ndarray, width: int, of: np.ufunc) -> np.ndarray:
    """The extreme of each window of ``width`` values (at most as many as there are)."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = of(x[:-step], x[step:])
        done += step
    return x


def runs(text: str, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and digests (two longs each) of the chosen runs of ``size`` words of a text."""
    in_word, letters = _letters()
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.flatnonzero(np.diff(in_word[c].view(np.int8), prepend=0, append=0))
    starts, ends = bounds[::2], bounds[1::2]
    n = len(starts) - size + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2), np.uint64)
    at = np.arange(n)
    hashes = [_mix(_sums(_mix(_sums(v[c], starts, ends, f)), at, at + size, f)) for v, f in zip(letters, _FACTORS, strict=True)]
    width = min(SPREAD, n)
    edge = np.zeros(width - 1, np.uint64)
    least = np.concatenate([edge, _extremes(hashes[0], width, np.minimum), edge])
    chosen = np.flatnonzero(_extremes(least, width, np.maximum) == hashes[0])
    return starts[chosen], ends[chosen + size - 1], np.stack([h[chosen] for h in hashes], axis=1)


def pieced(text: str, min_words: int) -> list[tuple[int, int, int, bytes]]:
    """(start, end, words, digest) of a text's runs of sentences and of its lines."""
    pieces, lines, line = [], [], 0  # start, end, words; first piece of each line and that after it
    for m in _PIECE.finditer(text):
        said = m[0]
        words = _WORD.findall(said.lower())
        if words:
            start = m.start() + len(said) - len(said.lstrip())
            pieces.append((start, m.start() + len(said.rstrip()), words))
        if said.endswith("\n") or m.end() == len(text):
            if line < len(pieces):
                lines.append((line, len(pieces)))
            line = len(pieces)
    said = [" ".join(p[2]) for p in pieces]
    out: dict[tuple[int, bytes], tuple[int, int]] = {}  # (start, digest): end, words

    def add(first: int, end: int, n: int) -> None:
        digest = hashlib.blake2b(" ".join(said[first:end]).encode(), digest_size=16).digest()
        out[pieces[first][0], digest] = (pieces[end - 1][1], n)

    end, held = 0, 0
    for k, (_, _, own) in enumerate(pieces):
        end = max(end, k)
        while held < min_words and end < len(pieces):
            held += len(pieces[end][2])
            end += 1
        if held < min_words:
            break
        add(k, end, held)
        held -= len(own)
    for first, end in lines:
        n = sum(len(p[2]) for p in pieces[first:end])
        if n >= LINE_WORDS:
            add(first, end, n)
    return [(start, end, n, digest) for (start, digest), (end, n) in out.items()]


def units(text: str | None, min_words: int = MIN_WORDS) -> Iterator[tuple[int, int, int, bytes]]:
    """(start, end, words, digest) of each unit of a text: code points, end exclusive, without white space at its ends."""
    starts, ends, digests = runs(text or "", min_words)
    chosen = [(start, end, min_words, d.tobytes()) for start, end, d in zip(starts.tolist(), ends.tolist(), digests, strict=True)]
    yield from sorted(pieced(text or "", min_words) + chosen)


def unit_rows(docs: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, start, size, d0, d1): every unit of every row; size in characters, the digest as two longs."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "size", "d0", "d1"]

        def batch() -> pa.RecordBatch:
            d = np.concatenate([np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2), *(x[2].view(np.int64) for _, x in chosen)])
            of = [len(x[0]) for _, x in chosen]
            columns = [
                np.concatenate([np.array(ids, np.int64), np.repeat(np.array([doc for doc, _ in chosen], np.int64), of)]),
                np.concatenate([np.array(starts, np.int32), *(x[0].astype(np.int32) for _, x in chosen)]),
                np.concatenate([np.array(sizes, np.int32), *((x[1] - x[0]).astype(np.int32) for _, x in chosen)]),
                np.ascontiguousarray(d[:, 0]),
                np.ascontiguousarray(d[:, 1]),
            ]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

        for b in it:
            ids, starts, sizes, digests, chosen, held = [], [], [], [], [], 0
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                text = text.as_py() or ""
                for start, end, _, digest in pieced(text, min_words):
                    ids.append(doc)
                    starts.append(start)
                    sizes.append(end - start)
                    digests.append(digest)
                chosen.append((doc, runs(text, min_words)))
                held += len(chosen[-1][1][0])
                if len(ids) + held >= 20_000:
                    yield batch()
                    ids, starts, sizes, digests, chosen, held = [], [], [], [], [], 0
            if len(ids) + held:
                yield batch()

    src = docs.filter("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return batches(src, run, "doc_id long, start int, size int, d0 long, d1 long")


def common_units(docs: DataFrame, text_col: str, min_words: int) -> DataFrame:
    """(d0, d1, parts) of the commonest units of a hashed sample, at most COMMON_UNITS: only for even tasks.

    The sample grows with the table, so that a unit of more than some COMMON * STEP rows is found at any size; parts grow
    with the unit's rows.
    """
    step = max(1, min(docs.count() // SAMPLE_DOCS, STEP))
    sample = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(step)) == 0)
    counts = unit_rows(sample, text_col, min_words).groupBy("d0", "d1").agg(F.count("*").alias("n")).filter(F.col("n") >= max(3, COMMON * SAMPLE_DOCS // 2_000))
    parts = F.greatest(F.ceil(F.col("n") * step / PART_ROWS), F.lit(SALTS)).cast("int").alias("parts")
    return cut(counts.orderBy(F.desc("n"), "d0", "d1").limit(COMMON_UNITS).select("d0", "d1", parts), "common-units")


def repeated_units(docs: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The units to remove: doc_id, start, end, kept_doc_id, kept_start, kept_end.

    A unit goes if an equal one occurs at a smaller (doc_id, start), the two don't overlap in one text, and no unit that
    could go overlaps that first occurrence. Spans of one document may overlap; when all of them are cut out, the kept
    occurrence of each is still there whole. Texts are searched whole, however long. Null and empty texts and texts
    without words have no units; null ids are passed over; repeated rows of one id and text are one document (its later
    copies have the same offsets, and stay with the row). Other columns are left out, whatever their names; an empty
    table gives no rows.

    Units meet in one shuffle by digest, sorted by place. Units that a sample shows to be common are dealt into parts
    by their number; their parts' first places, a bounded table, give the first of all.
    """
    common = F.broadcast(common_units(docs, text_col, min_words))
    # A place (start, size) as one number, in order of start: rows of plain numbers are small.
    place = F.shiftleft(F.col("start").cast("bigint"), 32).bitwiseOR(F.col("size").cast("bigint")).alias("place")
    rows = unit_rows(docs, text_col, min_words).select("d0", "d1", "doc_id", place).join(common, ["d0", "d1"], "left")
    rows = rows.withColumn("part", F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.col("parts"))).otherwise(F.lit(0)).cast("int")).withColumn("common", F.col("parts").isNotNull()).drop("parts")
    by = Window.partitionBy("d0", "d1", "part").orderBy("doc_id", "place")
    firsts = {"kept_doc_id": F.first("doc_id").over(by), "kept": F.first("place").over(by), "next": F.lead("doc_id").over(by), "n": F.row_number().over(by)}
    met = rows.withColumns(firsts).filter("n > 1 or next is not null or common")
    met = cut(met.select("d0", "d1", "doc_id", "place", "kept_doc_id", "kept", (F.col("n") == 1).alias("head"), "common"), "repeats")

    # Of common units, the first of their parts' firsts.
    one = met.filter("common and head").groupBy(F.col("d0").alias("c0"), F.col("d1").alias("c1")).agg(F.min(F.struct("doc_id", "place")).alias("x"))
    met = met.join(F.broadcast(one), F.col("common") & (F.col("d0") == F.col("c0")) & (F.col("d1") == F.col("c1")), "left")
    kept = {"kept_doc_id": F.coalesce("x.doc_id", "kept_doc_id"), "kept": F.coalesce("x.place", "kept")}
    met = met.withColumns(kept).drop("c0", "c1", "x", "common", "head")
    start, end = lambda c: F.shiftright(c, 32).cast("int"), lambda c: (F.shiftright(c, 32) + F.col(c).bitwiseAND(0xFFFFFFFF)).cast("int")
    is_kept = (F.col("doc_id") == F.col("kept_doc_id")) & (F.col("place") == F.col("kept"))
    may_go = (F.col("doc_id") != F.col("kept_doc_id")) | (start("place") >= end("kept"))

    # Kept occurrences that a span touches which may go: one before them that ends inside, or one that begins inside.
    spans = met.filter(is_kept | may_go).select("doc_id", start("place").alias("s"), end("place").alias("e"), F.when(is_kept, F.col("d0")).alias("d0"), F.when(is_kept, F.col("d1")).alias("d1"))
    text, gone = Window.partitionBy("doc_id"), F.col("d0").isNull()
    upto = text.orderBy("s").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    on = text.orderBy(F.desc("s")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    spans = spans.withColumns({"before": F.max(F.when(gone, F.col("e"))).over(upto), "after": F.min(F.when(gone, F.col("s"))).over(on)})
    touched = cut(spans.filter(~gone & (F.coalesce(F.col("before") > F.col("s"), F.lit(False)) | F.coalesce(F.col("after") < F.col("e"), F.lit(False)))).select("d0", "d1").distinct(), "touched-units")
    found = met.filter(may_go & ~is_kept).join(touched, ["d0", "d1"], "left_anti")
    return found.select("doc_id", start("place").alias("start"), end("place").alias("end"), "kept_doc_id", start("kept").alias("kept_start"), end("kept").alias("kept_end"))


def without(docs: DataFrame, spans: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the (doc_id, start, end) of ``spans`` cut out of their texts; rows without spans stay as they are.

    All rows and columns stay, whatever their names; null texts and null ids have no spans; rows of one id lose the same
    offsets; texts of any length are cut whole; an empty table gives no rows.
    """
    cuts = spans.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("__cuts")).withColumnRenamed("doc_id", "__id")
    docs_, text = docs.select(whole(docs), F.col("doc_id").alias("__doc"), F.col(f"`{text_col}`").alias("__text")), F.col("__text")
    step = lambda acc, s: F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.array(text.substr(acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))))).alias("out"))
    left = F.aggregate("__cuts", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.lit(2**31 - 1))))
    joined = docs_.join(cuts, F.col("__doc") == F.col("__id"), "left")
    return joined.select(*((F.when(F.col("__cuts").isNull(), text).otherwise(left) if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns))
