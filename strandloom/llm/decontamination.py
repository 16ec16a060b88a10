"""Benchmark decontamination: a generalised suffix automaton of the test items, along which documents' words stream.

The normalised items (words of ``terms.WORD``, A-Z lower-cased) go into one automaton over words. A document's words walk
it, and at each word the longest run of words that ends there and occurs in an item is known. A word is *hit* if it lies
in an occurrence of a window: ``window`` consecutive words of an item, or a whole item of fewer words.

Almost no word of a document needs a step of that walk: numpy looks up a batch's words and the pairs of neighbours among
the items' pairs, and only runs of known pairs, as long as the shortest window, are walked, word by word and by the words
themselves, not their hashes. So documents are read once, in place, without a shuffle.

Items are dealt by a hash into blocks of bounded size, one automaton each, and every document meets every block. The
driver builds one automaton at a time from at most ``BLOCK_WORDS`` words (or one item that is longer by itself) and
broadcasts it.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import terms
from .common import batches, cut, whole

WINDOW = 10
#: Words of the items in one automaton: some tens of megabytes on the driver and in a worker.
BLOCK_WORDS = 100_000
SPAN = "struct<start:bigint,end:bigint,first:bigint,n_words:bigint,longest:bigint>"
FOUND = f"n_words long, n_hit long, items array<string>, spans array<{SPAN}>"


class Automaton:
    """The generalised suffix automaton of items (id, words), with the windows that occur at its states."""

    def __init__(self, items: list[tuple[str, list[str]]], window: int = WINDOW):
        self.window = window
        self.ids: list[str] = []
        self.code: dict[str, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        texts = []
        number: dict[str, int] = {}
        for item, words in items:
            if words:
                if item not in number:
                    number[item] = len(self.ids)
                    self.ids.append(item)
                texts.append((number[item], [self.code.setdefault(w, len(self.code)) for w in words]))
        for _, text in texts:
            at = 0
            for w in text:
                at = self._extend(at, w)
        self.shortest = min((min(len(t), window) for _, t in texts), default=window)
        #: Items whose windows of full length end at a state, and (words, item) of short items that do.
        self.windows: dict[int, list[int]] = {}
        self.shorts: dict[int, list[tuple[int, int]]] = {}
        for n, text in texts:
            self._mark(n, text)

    def _state(self, size: int, link: int, step: dict[int, int]) -> int:
        self.size.append(size)
        self.link.append(link)
        self.step.append(step)
        return len(self.size) - 1

    def _split(self, before: int, w: int, to: int) -> int:
        """The state of the words of ``before`` and w where w leads to ``to``: that one, or a copy for the shorter words."""
        if self.size[to] == self.size[before] + 1:
            return to
        twin = self._state(self.size[before] + 1, self.link[to], dict(self.step[to]))
        self.link[to] = twin
        while before >= 0 and self.step[before].get(w) == to:
            self.step[before][w] = twin
            before = self.link[before]
        return twin

    def _extend(self, at: int, w: int) -> int:
        if w in self.step[at]:  # an earlier item has it
            return self._split(at, w, self.step[at][w])
        new = self._state(self.size[at] + 1, 0, {})
        while at >= 0 and w not in self.step[at]:
            self.step[at][w] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, w, self.step[at][w])
        return new

    def _mark(self, n: int, text: list[int]) -> None:
        at = 0
        for i, w in enumerate(text):
            at = self.step[at][w]
            at = self.anchor(at) if i + 1 >= self.window else at
            if i + 1 >= self.window:
                had = self.windows.setdefault(at, [])
                if not had or had[-1] != n:
                    had.append(n)
        if len(text) < self.window:
            self.shorts.setdefault(at, []).append((len(text), n))

    def anchor(self, at: int) -> int:
        """The state of the last ``window`` words of a state that has as many."""
        while self.size[self.link[at]] >= self.window:
            at = self.link[at]
        return at

    @cached_property
    def vocabulary(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes of the words, and their codes."""
        words = list(self.code)
        h = np.zeros(len(words), np.uint64)
        for which, _, _, x in terms.pieces([w.encode() for w in words]):
            h[which] = x
        order = np.argsort(h)
        return h[order], np.array([self.code[w] for w in words], np.int64)[order]

    @cached_property
    def pairs(self) -> np.ndarray:
        """Neighbours in items, as sorted numbers."""
        v = len(self.code)
        return np.unique(np.array([a * v + b for a, s in self.step[0].items() for b in self.step[s]], np.int64))

    def prepared(self) -> Automaton:
        """With what is derived from it, and every state's anchor and nearest state with short items."""
        _ = self.vocabulary, self.pairs
        self.anchors, self.nearest = [0] * len(self.size), [-1] * len(self.size)
        for s in sorted(range(1, len(self.size)), key=self.size.__getitem__):
            up = self.link[s]
            self.nearest[s] = s if s in self.shorts else self.nearest[up]
            if self.size[s] >= self.window:
                self.anchors[s] = self.anchors[up] if self.size[up] >= self.window else s
        return self


class _Walk:
    """One text's way along the automaton, over runs of its words."""

    def __init__(self, auto: Automaton):
        self.auto, self.spans, self.items = auto, [], set()
        self.state = self.size = 0
        self.next, self.begun = 0, deque(maxlen=auto.window)  # the word that would go on; starts of the last words

    def word(self, number: int, w: int, start: int, end: int) -> None:
        a = self.auto
        if number != self.next:
            self.state = self.size = 0
            self.begun.clear()
        self.next = number + 1
        self.begun.append(start)
        state = self.state
        while state and w not in a.step[state]:
            state = a.link[state]
            self.size = a.size[state]
        to = a.step[state].get(w)
        if to is None:
            self.state = self.size = 0
            return
        self.state, self.size = to, self.size + 1
        reach = 0
        if self.size >= a.window:
            reach = a.window
            self.items.update(a.windows[a.anchors[to]])
        near = a.nearest[to]
        while near > 0:
            for n, item in a.shorts[near]:
                if n <= self.size:
                    reach = max(reach, n)
                    self.items.add(item)
            near = a.nearest[a.link[near]] if a.link[near] > 0 else -1
        if reach:
            first = number - reach + 1
            if self.spans and self.spans[-1][2] + self.spans[-1][3] >= first:
                # The window may begin before the last span does: short items end inside longer windows.
                last = self.spans[-1]
                while len(self.spans) > 1 and self.spans[-2][2] + self.spans[-2][3] >= first:
                    gone = self.spans.pop()
                    last = self.spans[-1]
                    last[4] = max(last[4], gone[4])
                if first < last[2]:
                    last[0], last[2] = self.begun[-reach], first
                last[1], last[3], last[4] = end, number + 1 - last[2], max(last[4], self.size)
            else:
                self.spans.append([self.begun[-reach], end, first, reach, self.size])


def _scan(texts: list[bytes], auto: Automaton) -> tuple[list[int], dict[int, _Walk]]:
    """Words of each text, and the walk of each that has any hit."""
    n_words, walks = [0] * len(texts), {}
    vocabulary, codes = auto.vocabulary
    v, least = len(auto.code), auto.shortest
    for which, start, end, h in terms.pieces(texts):
        if not len(h):
            continue
        edge = np.flatnonzero(np.diff(which, prepend=-1))
        doc, counts = which[edge], np.diff(np.append(edge, len(which)))
        base = {int(d): n_words[d] for d in doc}
        at = terms.lookup(vocabulary, h)
        known = at >= 0
        code = np.where(known, codes[at], -1) if v else np.full(len(h), -1)
        linked = np.zeros(len(h), bool)  # to the next word
        same = known[:-1] & known[1:] & (which[:-1] == which[1:])
        pair = code[:-1] * v + code[1:]
        linked[:-1] = same & (auto.pairs[np.minimum(np.searchsorted(auto.pairs, pair), max(len(auto.pairs) - 1, 0))] == pair if len(auto.pairs) else False)
        # Runs of linked known words; one at either end of a long text's piece may go on beyond it.
        first = np.flatnonzero(known & ~np.concatenate(([False], linked[:-1])))
        last = np.flatnonzero(known & ~linked)
        long = last - first + 1 >= least
        if len(texts[int(which[0])]) > terms.PIECE:
            long |= (first == 0) | (last == len(h) - 1)
        for a, b in zip(first[long].tolist(), last[long].tolist(), strict=True):
            d = int(which[a])
            text, walk = texts[d], walks.get(d) or walks.setdefault(d, _Walk(auto))
            offset = base[d] - int(edge[np.searchsorted(doc, d)])
            for i in range(a, b + 1):
                s, e = int(start[i]), int(end[i])
                w = auto.code.get(text[s:e].decode().translate(_FOLD))
                if w is not None:
                    walk.word(offset + i, w, s, e)
        for d, c in zip(doc.tolist(), counts.tolist(), strict=True):
            n_words[d] += c
    return n_words, {d: w for d, w in walks.items() if w.spans}


_FOLD = str.maketrans(terms.UPPER, terms.LOWER)


def _chars(text: bytes, spans: list[list[int]]) -> list[list[int]]:
    """Spans counted in code points."""
    lead = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    out, at, chars = [], 0, 0
    for s in spans:
        places = []
        for p in s[:2]:
            chars, at = chars + int(np.count_nonzero(lead[at:p])), p
            places.append(chars)
        out.append([*places, *s[2:]])
    return out


def blocks(items: DataFrame, text_col: str, id_col: str, block_words: int) -> list[DataFrame]:
    """The items (id as text, words), dealt by a hash into blocks of at most ``block_words`` words, or one item that is longer."""
    words = F.regexp_extract_all(F.translate(F.col(f"`{text_col}`"), terms.UPPER, terms.LOWER), F.lit(terms.WORD), F.lit(0))
    rows = items.select(F.col(f"`{id_col}`").cast("string").alias("item"), words.alias("words")).filter("item is not null and size(words) > 0")
    rows = cut(rows, "items")
    sizes = rows.agg(F.sum(F.size("words")).alias("n"), F.max(F.size("words")).alias("longest")).first()
    n = -(-(sizes["n"] or 0) // block_words)
    while n > 1:
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(n)))
        most = dealt.groupBy("block").agg(F.sum(F.size("words")).alias("n")).agg(F.max("n").alias("n")).first()["n"]
        if most <= max(2 * block_words, sizes["longest"] + block_words) or n > 64 * sizes["n"] // block_words:
            return [dealt.filter(F.col("block") == b).select("item", "words") for b in range(n)]
        n *= 2
    return [rows] if n else []


def _matched(docs: DataFrame, auto: Automaton) -> DataFrame:
    """docs (row, text) with what one automaton finds: row and the columns of FOUND."""
    shared = docs.sparkSession.sparkContext.broadcast(auto.prepared())
    kinds = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "end", "first", "n_words", "longest")]))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = shared.value
        for b in it:
            texts = [(t or "").encode() for t in b.column(1).to_pylist()]
            n_words, walks = _scan(texts, auto)
            spans = [_chars(texts[k], walks[k].spans) if k in walks else [] for k in range(len(texts))]
            rows = [[dict(zip(("start", "end", "first", "n_words", "longest"), s, strict=True)) for s in x] for x in spans]
            found = [pa.array(n_words, pa.int64()), pa.array([sum(s[3] for s in x) for x in spans], pa.int64()), pa.array([sorted(auto.ids[i] for i in walks[k].items) if k in walks else [] for k in range(len(texts))], pa.list_(pa.string())), pa.array(rows, kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), *found], ["row", "n_words", "n_hit", "items", "spans"])

    return batches(docs, run, f"row {docs.schema['row'].dataType.simpleString()}, {FOUND}")


def _merged(pieces: DataFrame) -> DataFrame:
    """Spans of several automata by document, as runs of hit words."""
    ordered = F.array_sort(F.flatten(F.collect_list("spans")), lambda a, b: F.when(a["first"] < b["first"], -1).when(a["first"] > b["first"], 1).otherwise(0))
    kind = f"array<{SPAN}>"

    def add(acc, s):
        last = F.element_at(acc, -1)
        one = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["first"].alias("first"), (F.greatest(last["first"] + last["n_words"], s["first"] + s["n_words"]) - last["first"]).alias("n_words"), F.greatest(last["longest"], s["longest"]).alias("longest"))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["first"] + F.try_element_at(acc, F.lit(-1))["n_words"] >= s["first"]), F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(one))).otherwise(F.concat(acc, F.array(s)))

    out = pieces.groupBy("__n").agg(F.flatten(F.collect_list("items")).alias("items"), ordered.alias("all"))
    return out.select("__n", F.array_sort(F.array_distinct("items")).alias("items"), F.aggregate("all", F.array().cast(kind), add).alias("spans"))


def matches(docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS, only: tuple[str, ...] | None = None) -> DataFrame:
    """Every row of ``docs`` as struct ``row`` (all its columns, or those in ``only``), with n_words, n_hit, items (ids as text, sorted) and spans.

    A span is a run of hit words: start and end in code points (end exclusive), number of its first word, words, and the
    length in words of the longest match of an item in it. Null and empty texts have no words; rows and their number stay,
    repeated ones too. Items with a null id or without words find nothing; rows of one item id are one item. Texts of any
    length are read whole, in pieces. Columns of any name pass in ``row``.
    """
    src = docs.select(whole(docs if only is None else docs.select(*(F.col(f"`{c}`") for c in only))), F.col(f"`{text_col}`").alias("text"))
    dealt = blocks(items, item_text_col, id_col, block_words)
    if len(dealt) <= 1:
        rows = [(r["item"], list(r["words"])) for d in dealt for r in d.collect()]
        return _matched(src, Automaton(rows, window))
    # Numbered as they are written, so that what each block finds comes back to its row; only documents with hits do.
    src = cut(src.withColumn("__n", F.monotonically_increasing_id()), "texts")
    keyed = src.select(F.struct("__n").alias("row"), "text")
    counted, found = None, []
    for d in dealt:
        out = cut(_matched(keyed, Automaton([(r["item"], list(r["words"])) for r in d.collect()], window)).select("row.__n", "n_words", "items", "spans"), "matches")
        counted = out.select("__n", "n_words") if counted is None else counted
        found.append(out.filter(F.size("spans") > 0).select("__n", "items", "spans"))
    hits = _merged(reduce(DataFrame.unionByName, found))
    rows = src.select("row", "__n").join(counted, "__n").join(hits, "__n", "left")
    spans = F.coalesce("spans", F.array().cast(f"array<{SPAN}>"))
    return rows.select("row", "n_words", F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, s: a + s["n_words"]).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), spans.alias("spans"))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, min_words: int = WINDOW, max_coverage: float = 0.5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``row``, what ``matches`` finds, ``clean_text`` without the spans of at least ``min_words`` words, and ``dropped``.

    dropped: hit words are more than ``max_coverage`` of the document's. A document without hits keeps its text as it is;
    a null text stays null.
    """
    found = matches(docs, items, text_col, id_col, item_text_col, window, block_words)
    text = F.col("row")[text_col]
    going = F.filter("spans", lambda s: s["n_words"] >= min_words)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))
    kept = F.aggregate(going, start, lambda acc, s: F.struct(s["end"].alias("at"), F.concat(acc["parts"], F.array(F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")))).alias("parts")), lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return found.withColumns({"clean_text": F.when(F.size(going) > 0, kept).otherwise(text), "dropped": F.col("n_hit") > max_coverage * F.col("n_words")})
