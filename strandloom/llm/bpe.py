"""BPE encoding and decoding with word ends: contiguous rank arrays over the parts of each word.

A word is held as an array of part boundaries and, beside it, an array of the ranks of adjacent parts. The encoder
scans the ranks for the minimum, deletes the boundary between the two parts, and refreshes the ranks of the merged
part with its neighbours, until no adjacent parts have a rank. Words are short, so the scan beats a heap, and each
distinct word is encoded once while it is remembered (a bounded memory, emptied when full).

The vocabulary file is a parameter; nothing is trained.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches

NO_RANK = 1 << 60
#: Ranks that one scan runs over: longer words are held in blocks of so many.
BLOCK = 256
# Lower-case mappings of code points newer than Python's own Unicode tables.
NEWER_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B} | {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
# Letters and numbers of Unicode 16, newer than Python's own tables.
NEWER = {
    "L": [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)],
    "N": [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)],
}
#: Words and ids remembered by one Python worker.
MEMORY_WORDS = 200_000
#: Longer pieces aren't remembered.
MEMORY_CHARS = 64


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: printable Latin-1 stands for itself, the rest for code points from 256 up."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


def category_class(first: str) -> str:
    """Character ranges of the categories that begin with ``first``, as in Unicode 16 (regex knows later letters too)."""
    runs: list[list[int]] = [list(r) for r in NEWER[first]]
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] == first:
            if runs[-1][1] == c - 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


def check(spec: dict) -> None:
    """Raises ValueError for a file whose parts aren't those that this encoder and decoder follow: no silent wrong ids."""
    steps = lambda part, key: [part] if part and key not in part else list((part or {}).get(key, []))
    normal = [(n["type"], json.dumps(n.get("pattern")), n.get("content")) for n in steps(spec.get("normalizer"), "normalizers")]
    before = [(p["type"], p.get("behavior"), p.get("invert")) for p in steps(spec.get("pre_tokenizer"), "pretokenizers")]
    model = spec["model"]
    wrong = [
        name
        for name, bad in (
            ("normalizer", normal != [("NFC", "null", None), ("Replace", '{"Regex": "\\\\s+"}', " "), ("Lowercase", "null", None)]),
            ("pre_tokenizer", [x[0] for x in before] != ["Split", "ByteLevel"] or before[0][1:] != ("Removed", True)),
            ("decoder", spec.get("decoder") is not None),
            ("model", model.get("type") != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("fuse_unk") or model.get("byte_fallback") or model.get("ignore_merges")),
            ("added_tokens", any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized") for t in spec["added_tokens"])),
        )
        if bad
    ]
    if wrong:
        raise ValueError(f"this vocabulary file's {', '.join(wrong)} are not of the supported kind")


class WordBpe:
    """Encoder and decoder of one vocabulary file of the kind ``BPE with word ends``."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: (left part, right part) -> rank
        self.rank = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text_of = {i: t for t, i in (self.ids | self.special).items()}
        check(spec)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"]
        self.word = regex.compile(pattern)
        # The first code point of which the libraries' Unicode tables differ is U+0558; texts beyond go by explicit classes.
        self.far = regex.compile("[\u0558-\U0010ffff]")
        self.far_word = regex.compile(pattern.replace(r"\p{L}", category_class("L")).replace(r"\p{N}", category_class("N")))
        self.special_re = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.alphabet = byte_alphabet()
        self.space = regex.compile(r"\p{White_Space}+")
        self.newer = regex.compile("[" + "".join(map(chr, NEWER_LOWER)) + "]")
        self.memory: dict[str, bytes] = {}

    def normalize(self, text: str) -> str:
        """NFC, runs of white space to one space, lower case (each code point on its own, as its full mapping)."""
        text = self.space.sub(" ", text)
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()  # no special form at the end of a word
        return text.translate(NEWER_LOWER) if self.newer.search(text) else text

    def merge(self, symbols: list[str]) -> list[str]:
        """The parts that are left of ``symbols`` once every ranked pair is merged, lowest rank first, leftmost first."""
        if len(symbols) > BLOCK:
            return self.merge_blocks(symbols)
        rank = self.rank
        parts = list(symbols)  # between two boundaries each
        ranks = [rank.get(pair, NO_RANK) for pair in zip(parts, parts[1:], strict=False)]
        while ranks:
            low = min(ranks)
            if low == NO_RANK:
                break
            k = ranks.index(low)
            parts[k] += parts[k + 1]
            del parts[k + 1], ranks[k]
            if k < len(ranks):
                ranks[k] = rank.get((parts[k], parts[k + 1]), NO_RANK)
            if k:
                ranks[k - 1] = rank.get((parts[k - 1], parts[k]), NO_RANK)
        return parts

    def merge_blocks(self, symbols: list[str]) -> list[str]:
        """As ``merge``, the same scan over the same arrays held in blocks, each with its minimum, for pieces of any length.

        A merge looks for the lowest block minimum and scans that block alone; ``ranks[b][i]`` is the rank of part i of
        block b with the part after it, which may be the next block's first. Blocks that run empty are taken out.
        """
        rank = self.rank
        parts = [symbols[k : k + BLOCK] for k in range(0, len(symbols), BLOCK)]
        after = [*symbols[1:], None]
        ranks = [[rank.get(pair, NO_RANK) for pair in zip(symbols[k : k + BLOCK], after[k : k + BLOCK], strict=True)] for k in range(0, len(symbols), BLOCK)]
        lows = [min(r) for r in ranks]
        while (low := min(lows)) != NO_RANK:
            b = lows.index(low)
            k = ranks[b].index(low)
            # The part to the right, in this block or the next.
            c, j = (b, k + 1) if k + 1 < len(parts[b]) else (b + 1, 0)
            parts[b][k] += parts[c][j]
            del parts[c][j], ranks[c][j]
            if not parts[c]:
                del parts[c], ranks[c], lows[c]
            elif c != b:
                lows[c] = min(ranks[c])
            right = parts[b][k + 1] if k + 1 < len(parts[b]) else parts[b + 1][0] if b + 1 < len(parts) else None
            ranks[b][k] = rank.get((parts[b][k], right), NO_RANK)
            if k:
                ranks[b][k - 1] = rank.get((parts[b][k - 1], parts[b][k]), NO_RANK)
            elif b:
                ranks[b - 1][-1] = rank.get((parts[b - 1][-1], parts[b][k]), NO_RANK)
                lows[b - 1] = min(ranks[b - 1])
            lows[b] = min(ranks[b])
        return [p for block in parts for p in block]

    def word_ids(self, word: str) -> bytes:
        """Little-endian unsigned 32-bit ids of one word; symbols without an id are left out."""
        symbols = [self.alphabet[b] for b in word.encode()]
        if self.end:
            symbols[-1] += self.end
        ids = self.ids
        return array("I", [ids[p] for p in self.merge(symbols) if p in ids]).tobytes()

    def plain_ids(self, text: str, out: list[bytes]) -> None:
        """Appends the ids of a text without special tokens."""
        memory = self.memory
        text = self.normalize(text)
        for w in (self.far_word if self.far.search(text) else self.word).findall(text):
            got = memory.get(w)
            if got is None:
                got = self.word_ids(w)
                if len(w) <= MEMORY_CHARS:
                    if len(memory) >= MEMORY_WORDS:
                        memory.clear()
                    memory[w] = got
            out.append(got)

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers; strings of special tokens become their ids."""
        out: list[bytes] = []
        text = text or ""
        at = 0
        if self.special_re is not None:
            for m in self.special_re.finditer(text):
                self.plain_ids(text[at : m.start()], out)
                out.append(array("I", [self.special[m[0]]]).tobytes())
                at = m.end()
        self.plain_ids(text[at:] if at else text, out)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The tokens' own strings, joined by single spaces: what the library's decode gives where no decoder is set."""
        text_of = self.text_of
        return " ".join([text_of[i] for i in array("I", ids) if i in text_of])


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBpe:
    """One tokenizer a worker and file."""
    return WordBpe(path)


def encode_decode(df: DataFrame, vocabulary: str, text_col: str = "text", decode: bool = True, batch_bytes: int = 4 << 20) -> DataFrame:
    """Adds ``ids`` (binary: little-endian unsigned 32-bit ids) and, if ``decode``, ``decoded`` (string) to ``df``.

    ``vocabulary`` is the path of the vocabulary file on every worker. Null text counts as empty: no ids, an empty
    decoded text. Columns ``ids`` and ``decoded`` of the input are replaced; all other columns but the text stay. Rows
    are independent: no shuffle, and a lost task is simply run again. An empty table gives no rows.
    """
    own = ["ids", "decoded"][: 1 + decode]
    keep = [c for c in df.columns if c not in own and c != text_col]
    src = df.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)), F.col(f"`{text_col}`").alias("text"))
    out = df.select(*(F.col(f"`{c}`") for c in keep), F.lit(b"").alias("ids"), *([F.lit("").alias("decoded")] if decode else []))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(vocabulary)
        for batch in it:
            at, n = 0, batch.num_rows
            texts = batch.column(len(keep))
            while at < n:  # a few texts at a time: batches are bounded in bytes too
                ids, size, end = [], 0, at
                while end < n and (end == at or size < batch_bytes):
                    ids.append(bpe.encode(texts[end].as_py()))
                    size, end = size + len(ids[-1]), end + 1
                cols = [*batch.slice(at, end - at).columns[: len(keep)], pa.array(ids, pa.binary())]
                if decode:
                    cols.append(pa.array([bpe.decode(x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, [*keep, *own])
                at = end

    return batches(src, run, out.schema)
