"""Binary alignments as a Spark data source: one file is read by many tasks, and written by as many as there are partitions.

A file is a row of compressed blocks; records run across their borders. A task reads what begins in its range of bytes: it
finds the first block there, and in it the first place at which a whole record and those after it can begin (lengths,
reference numbers, name, operations all fit). It stops where the next range begins, found in the same way, and its chain
of records must end exactly there; since the first range begins at the header's end, a wrong guess anywhere breaks some
chain and raises an error. So no index is needed, no byte is left out and no record is read twice.

Only the columns that are asked for are decoded. Positions are 0-based.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from .files import SPLIT, Bytes, Split, dealt, listed, opened

SCHEMA = "read_id string, flag int, chrom string, pos long, mapq int, cigar string, mate_chrom string, mate_pos long, tlen long, seq string, qual string, tags map<string,string>"

# Fixed values of the format.
MAGIC, BLOCK_HEAD = b"BAM\1", b"\x1f\x8b\x08\x04"
END_OF_FILE = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
CIGAR_OPS, BASES = "MIDNSHP=X", "=ACMGRSVTWYHKDBN"
FIXED = np.dtype([("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("l_name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("n_cigar", "<u2"), ("flag", "<u2"), ("l_seq", "<i4"), ("mate_ref", "<i4"), ("mate_pos", "<i4"), ("tlen", "<i4")])
NUMBERS = {"c": "b", "C": "B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}

#: Most uncompressed bytes of a block, and records that must follow one another for a place to be a record's.
BLOCK, CHAIN = 1 << 16, 8
#: Uncompressed bytes that are decoded at once.
BATCH = 1 << 21
_PAIRS = np.array([ord(BASES[b >> 4]) | ord(BASES[b & 15]) << 8 for b in range(256)], "<u2")


class Blocks:
    """The blocks of a file, decompressed on demand."""

    def __init__(self, file: Bytes):
        self.file, self.head, self.ahead = file, 0, b""

    def _bytes(self, offset: int, n: int) -> bytes:
        if not (self.head <= offset and offset + n <= self.head + len(self.ahead)):
            self.head, self.ahead = offset, self.file.at(offset, max(n, 1 << 20))
        return self.ahead[offset - self.head : offset - self.head + n]

    def length(self, offset: int) -> int:
        """Bytes of the block at ``offset``; 0 if none begins there."""
        head = self._bytes(offset, 18)
        if len(head) < 18 or head[:4] != BLOCK_HEAD:
            return 0
        extra = self._bytes(offset + 12, struct.unpack_from("<H", head, 10)[0])
        at = 0
        while at + 4 <= len(extra):
            n = struct.unpack_from("<H", extra, at + 2)[0]
            if extra[at : at + 2] == b"BC" and n == 2:
                return struct.unpack_from("<H", extra, at + 4)[0] + 1
            at += 4 + n
        return 0

    def data(self, offset: int) -> tuple[bytes, int]:
        """Uncompressed bytes of the block at ``offset`` and where the next begins."""
        n = self.length(offset)
        raw = self._bytes(offset, n)
        if not n or len(raw) < n:
            raise ValueError(f"no whole block at byte {offset}")
        extra = struct.unpack_from("<H", raw, 10)[0]
        out = zlib.decompress(raw[12 + extra : -8], -15)
        if zlib.crc32(out) != struct.unpack_from("<I", raw, n - 8)[0]:
            raise ValueError(f"damaged block at byte {offset}")
        return out, offset + n

    def first(self, offset: int) -> int:
        """Where the first block at or after ``offset`` begins; the file's size if there is none."""
        while offset < self.file.size:
            window = self.file.at(offset, 2 * BLOCK + 18)
            at = window.find(BLOCK_HEAD)
            while at >= 0:
                n = self.length(offset + at)
                if n and (offset + at + n == self.file.size or self.length(offset + at + n)):
                    return offset + at
                at = window.find(BLOCK_HEAD, at + 1)
            offset += len(window) - 3 if len(window) > 3 else len(window)
        return self.file.size


class Stream:
    """Uncompressed bytes from a block on; ``place`` tells the block and the byte in it of any of them."""

    def __init__(self, blocks: Blocks, offset: int):
        self.blocks, self.next = blocks, offset
        self.data, self.starts, self.offsets = bytearray(), [], []
        self.gone = 0  # bytes dropped from the front

    def more(self) -> bool:
        if self.next >= self.blocks.file.size:
            return False
        data, after = self.blocks.data(self.next)
        self.starts.append(self.gone + len(self.data))
        self.offsets.append(self.next)
        self.data += data
        self.next = after
        return True

    def need(self, upto: int) -> bool:
        """Whether ``data`` reaches ``upto`` bytes, reading on."""
        while len(self.data) < upto:
            if not self.more():
                return False
        return True

    def drop(self, n: int) -> None:
        del self.data[:n]
        self.gone += n
        while len(self.starts) > 1 and self.starts[1] <= self.gone:
            del self.starts[0], self.offsets[0]

    def place(self, at: int) -> tuple[int, int]:
        """(block, byte in it) of ``data[at]``; at a block's end that is the next one's begin."""
        at += self.gone
        if not self.starts or at == self.gone + len(self.data):
            return self.next, 0
        k = int(np.searchsorted(self.starts, at, side="right")) - 1
        return self.offsets[k], at - self.starts[k]

    def places(self, at: list[int]) -> list[int]:
        """``place`` (block << 16 | byte) of many."""
        here = np.array(at, np.int64) + self.gone
        k = np.maximum(np.searchsorted(self.starts, here, side="right") - 1, 0)
        found = np.array(self.offsets, np.int64)[k] << 16 | here - np.array(self.starts, np.int64)[k]
        return np.where(here == self.gone + len(self.data), self.next << 16, found).tolist()

    def index(self, place: tuple[int, int]) -> int | None:
        """Where ``place`` is in ``data``; None if it isn't read yet."""
        if place == (self.next, 0):
            return len(self.data)
        if place[0] >= self.next:
            return None
        return self.starts[self.offsets.index(place[0])] + place[1] - self.gone if place[0] in self.offsets else -1


class Header:
    """Text, references and where the records begin."""

    def __init__(self, blocks: Blocks):
        s = Stream(blocks, 0)
        if not s.need(8) or bytes(s.data[:4]) != MAGIC:
            raise ValueError("not a file of binary alignments")
        n = struct.unpack_from("<i", s.data, 4)[0]
        s.need(12 + n)
        self.text = bytes(s.data[8 : 8 + n]).rstrip(b"\0").decode()
        count, at = struct.unpack_from("<i", s.data, 8 + n)[0], 12 + n
        self.names, self.lengths = [], []
        for _ in range(count):
            s.need(at + 4)
            n = struct.unpack_from("<i", s.data, at)[0]
            s.need(at + 8 + n)
            self.names.append(bytes(s.data[at + 4 : at + 3 + n]).decode())
            self.lengths.append(struct.unpack_from("<i", s.data, at + 4 + n)[0])
            at += 8 + n
        self.begin = s.place(at)


def _fits(s: Stream, at: int, header: Header) -> bool:
    """Whether CHAIN records, or all that are left, can begin at ``data[at]``."""
    n_ref, lengths = len(header.names), header.lengths
    for _ in range(CHAIN):
        if not s.need(at + 36):
            return at == len(s.data)
        size, ref, pos, l_name, _, _, n_cigar, _, l_seq, mate, mate_pos, _ = struct.unpack_from("<iiiBBHHHiiii", s.data, at)
        if not (-1 <= ref < n_ref and -1 <= mate < n_ref and l_name >= 2 and l_seq >= 0 and pos >= -1 and mate_pos >= -1):
            return False
        if size < 32 + l_name + 4 * n_cigar + (l_seq + 1) // 2 + l_seq or (ref >= 0 and pos > lengths[ref]) or (mate >= 0 and mate_pos > lengths[mate]):
            return False
        if not s.need(at + 36 + l_name + 4 * n_cigar):
            return False
        name = s.data[at + 36 : at + 36 + l_name]
        if name[-1] or any(not 33 <= c <= 126 for c in name[:-1]):
            return False
        ops = np.frombuffer(bytes(s.data[at + 36 + l_name : at + 36 + l_name + 4 * n_cigar]), "<u4")
        if (ops & 15 > 8).any():
            return False
        if n_cigar and l_seq and int((ops >> 4)[np.isin(ops & 15, (0, 1, 4, 7, 8))].sum()) != l_seq:
            return False
        if not s.need(at + 4 + size):
            return False
        at += 4 + size
    return True


def first_record(blocks: Blocks, offset: int, header: Header) -> tuple[int, int]:
    """(block, byte) of the first record that begins in a block at or after ``offset``; (size, 0) if there is none."""
    if offset <= header.begin[0]:
        return header.begin
    block = blocks.first(offset)
    s = Stream(blocks, block)
    at = 0
    while s.need(at + 36):
        # Places whose length, references and name length can be a record's, by numpy; few are left to try.
        here = np.frombuffer(bytes(s.data[at:]), np.uint8)
        n = len(here) - 35
        number = lambda k: np.lib.stride_tricks.sliding_window_view(here[k:], 4)[:n].copy().view("<i4").ravel()  # noqa: B023, E731
        ref, mate, l_seq, size = number(4), number(24), number(20), number(0)
        may = (ref >= -1) & (ref < len(header.names)) & (mate >= -1) & (mate < len(header.names)) & (l_seq >= 0) & (size >= 34) & (here[12 : 12 + n] >= 2)
        for k in np.flatnonzero(may).tolist():
            if _fits(s, at + k, header):
                return s.place(at + k)
        at += n
        if not s.more():
            break
    return blocks.file.size, 0


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all stretches, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def _texts(flat: np.ndarray, lengths: np.ndarray, none: np.ndarray | None = None) -> pa.Array:
    """Texts of ``lengths`` bytes each, ``*`` where ``none``."""
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    out = pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(ends.tobytes()), pa.py_buffer(flat.astype(np.uint8, copy=False).tobytes()))
    return out if none is None or not none.any() else pc.if_else(pa.array(none), pa.scalar("*", pa.large_string()), out)


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of stretches of ``lengths`` values each."""
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return upto[ends] - upto[ends - lengths]


def _cigars(ops: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Texts of operations, ``lengths`` of them each."""
    n, digits = (ops >> 4).astype(np.int64), np.ones(len(ops), np.int64)
    for power in range(1, 9):
        digits += n >= 10**power
    after = np.cumsum(digits + 1)  # where an operation's text ends
    out = np.empty(after[-1] if len(after) else 0, np.uint8)
    out[after - 1] = np.frombuffer((CIGAR_OPS + "?" * 7).encode(), np.uint8)[ops & 15]
    for k in range(int(digits.max(initial=0))):
        some = digits > k
        out[after[some] - 2 - k] = 48 + n[some] // 10**k % 10
    return _texts(out, _sums(digits + 1, lengths), lengths == 0)


def _number(x: float) -> str:
    return f"{x:g}"


def _tags(raw: bytes) -> dict[str, str]:
    out, at = {}, 0
    while at + 3 <= len(raw):
        key, kind = raw[at : at + 2].decode(), chr(raw[at + 2])
        at += 3
        if kind in "ZH":
            end = raw.index(0, at)
            out[key], at = raw[at:end].decode(), end + 1
        elif kind == "A":
            out[key], at = chr(raw[at]), at + 1
        elif kind == "B":
            of, n = chr(raw[at]), struct.unpack_from("<i", raw, at + 1)[0]
            values = np.frombuffer(raw, np.dtype(NUMBERS[of]), n, at + 5)
            out[key] = ",".join([of, *(_number(x) if of == "f" else str(x) for x in values.tolist())])
            at += 5 + values.nbytes
        else:
            x = struct.unpack_from(NUMBERS[kind], raw, at)[0]
            out[key], at = _number(x) if kind == "f" else str(x), at + struct.calcsize(NUMBERS[kind])
    return out


#: Columns beside SCHEMA: the file's name, where a record begins and where the next does (block << 16 | byte), and the end of its span on the reference.
PLACES = "file string, begin long, next long, end0 long"


def _decoded(data: bytes, offs: np.ndarray, header: Header, names: list[str], places: list[int], file: str) -> list[list]:
    """Values of the columns ``names`` of the records at ``offs``; ``places``: where they begin, and where the last one ends."""
    fixed = np.frombuffer(data, np.uint8)[offs[:, None] + np.arange(36)].reshape(-1).view(FIXED)
    name_at = offs + 36
    cigar_at = name_at + fixed["l_name"]
    seq_at = cigar_at + 4 * fixed["n_cigar"].astype(np.int64)
    qual_at = seq_at + (fixed["l_seq"].astype(np.int64) + 1) // 2
    tags_at, end = qual_at + fixed["l_seq"], offs + 4 + fixed["size"]
    spans = lambda a, b: [data[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    chroms = pa.array([*header.names, None], pa.string())  # the last one is number -1's too
    raw = np.frombuffer(data, np.uint8)
    n_ops, n_bases = fixed["n_cigar"].astype(np.int64), fixed["l_seq"].astype(np.int64)
    words = lambda: raw[_spread(cigar_at, 4 * n_ops)].view("<u4")
    # More operations than the field counts are in a tag, beside one clip over the whole read.
    long = [k for k in np.flatnonzero(fixed["n_cigar"] == 2).tolist() if data[cigar_at[k] : cigar_at[k] + 4] == struct.pack("<I", int(fixed["l_seq"][k]) << 4 | 4)] if "cigar" in names or "tags" in names else []
    made = {k: _tags(data[tags_at[k] : end[k]]) for k in long}
    long = [k for k in long if "CG" in made[k]]
    out = []
    for name in names:
        if name == "read_id":
            n = cigar_at - 1 - name_at
            out.append(_texts(raw[_spread(name_at, n)], n))
        elif name in ("flag", "mapq"):
            out.append(fixed[name].astype(np.int32))
        elif name in ("pos", "mate_pos", "tlen"):
            out.append(fixed[name].astype(np.int64))
        elif name in ("chrom", "mate_chrom"):
            out.append(chroms.take(pa.array(fixed["ref" if name == "chrom" else "mate_ref"] % (len(header.names) + 1))))
        elif name in ("begin", "next"):
            out.append(places[:-1] if name == "begin" else places[1:])
        elif name == "file":
            out.append([file] * len(offs))
        elif name == "end0":
            ops = words()
            out.append(fixed["pos"] + _sums(np.where(np.isin(ops & 15, (0, 2, 3, 7, 8)), (ops >> 4).astype(np.int64), 0), n_ops))
        elif name == "cigar":
            values = _cigars(words(), n_ops)
            if long:
                values = values.to_pylist()
            for k in long:
                values[k] = "".join(f"{int(x) >> 4}{CIGAR_OPS[int(x) & 15]}" for x in made[k]["CG"].split(",")[1:])
            out.append(values)
        elif name == "seq":
            pairs = _PAIRS[raw[_spread(seq_at, (n_bases + 1) // 2)]].view(np.uint8)
            odd = n_bases % 2 == 1
            out.append(_texts(np.delete(pairs, np.cumsum(n_bases + n_bases % 2)[odd] - 1), n_bases, n_bases == 0))
        elif name == "qual":
            first = raw[np.minimum(qual_at, len(raw) - 1)]
            none = (n_bases == 0) | (first == 255)
            n = np.where(none, 0, n_bases)
            scores = raw[_spread(qual_at, n)] + np.uint8(33)
            if (scores > 127).any():
                raise ValueError(f"qualities above 94 in {file}")
            out.append(_texts(scores, n, none))
        elif name == "tags":
            values = [_tags(x) for x in spans(tags_at, end)]
            for k in long:
                values[k].pop("CG")
            at = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
            out.append(pa.MapArray.from_arrays(pa.array(at), pa.array([k for v in values for k in v], pa.string()), pa.array([x for v in values for x in v.values()], pa.string())))
        else:
            raise ValueError(f"no column {name!r} in binary alignments")
    return out


@dataclass
class Range(InputPartition):
    """The records of a file from one place (block << 16 | byte) to another."""

    path: str
    begin: int
    stop: int


def records(split: Split | Range, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The records that begin in the blocks of a split, or those of a range."""
    with Bytes(split.path) as file:
        blocks = Blocks(file)
        header = Header(blocks)
        if isinstance(split, Range):
            begin, stop = ((x >> 16, x & 0xFFFF) for x in (split.begin, split.stop))
        else:
            # The header is the first split's, however long it is.
            begin = header.begin if split.start == 0 else first_record(blocks, split.start, header)
            stop = (file.size, 0) if split.end >= file.size else first_record(blocks, split.end, header)
        if begin < stop:
            yield from _between(blocks, header, begin, stop, schema, split.path.rsplit("/", 1)[-1])


def _between(blocks: Blocks, header: Header, begin: tuple[int, int], stop: tuple[int, int], schema: pa.Schema, file: str) -> Iterator[pa.RecordBatch]:
    s, size_of_file = Stream(blocks, begin[0]), blocks.file.size
    s.need(begin[1] + 1)
    s.drop(begin[1])
    wanted = {"begin", "next"} & set(schema.names)
    done = False
    while not done:
        while len(s.data) < BATCH and s.next <= stop[0] and s.more():
            pass
        offs, at, limit = [], 0, s.index(stop)
        while at < BATCH:
            if limit is None:
                limit = s.index(stop)
            if limit is not None and at >= limit or not s.need(at + 4):
                done = True
                if at != limit and not (stop[0] == size_of_file and s.next >= size_of_file and at == len(s.data)):
                    raise ValueError(f"records from {begin} don't end at {stop} but at {s.place(at)}")
                break
            size = struct.unpack_from("<i", s.data, at)[0]
            if size < 32 or not s.need(at + 4 + size):
                raise ValueError(f"a broken record at {s.place(at)}")
            offs.append(at)
            at += 4 + size
        if offs:
            places = s.places([*offs, at]) if wanted else []
            columns = _decoded(bytes(s.data[:at]), np.array(offs, np.int64), header, schema.names, places, file)
            yield pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        s.drop(at)


class _Reader(DataSourceReader):
    def __init__(self, schema: pa.Schema, paths: list[str], size: int, ranges: list[Range] | None):
        self.schema, self.paths, self.size, self.ranges = schema, paths, size, ranges

    def partitions(self) -> list[Split] | list[Range]:
        if self.ranges is not None:
            return self.ranges or [Split("", 0, 0, 0)]
        return dealt(listed(self.paths, (".bam",)), self.size) or [Split("", 0, 0, 0)]

    def read(self, partition: Split | Range) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield from records(partition, self.schema)


# Writing


def block(data: bytes) -> bytes:
    """One compressed block."""
    squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    if len(body) + 26 > BLOCK:
        squeeze = zlib.compressobj(0, zlib.DEFLATED, -15)
        body = squeeze.compress(data) + squeeze.flush()
    return BLOCK_HEAD + struct.pack("<IBBH2sHH", 0, 0, 255, 6, b"BC", 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def bin_of(start: int, end: int) -> int:
    """The number of the smallest bin that holds [start, end), in six levels of eight to one."""
    end -= 1
    for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        if start >> shift == end >> shift:
            return (first + (start >> shift)) & 0xFFFF
    return 0


def _encoded_tags(tags: dict[str, str] | None) -> bytes:
    out = b""
    for key, value in (tags or {}).items():
        if value is None:
            continue
        whole = value.removeprefix("-")
        if whole.isascii() and whole.isdigit() and -(1 << 31) <= int(value) < 1 << 31 and str(int(value)) == value:
            out += key.encode() + b"i" + struct.pack("<i", int(value))
        else:
            out += key.encode() + b"Z" + value.encode() + b"\0"
    return out


_CODE = np.full(256, 15, np.uint8)
_CODE[[ord(c) for c in BASES]] = range(16)
_OPS = {c: i for i, c in enumerate(CIGAR_OPS)}
# The same for bytes of any case; digits are 10, all else 255.
_CODE_ANY = _CODE.copy()
_CODE_ANY[[ord(c.lower()) for c in BASES]] = _CODE[[ord(c) for c in BASES]]
_OP_CODE = np.full(256, 255, np.uint8)
_OP_CODE[48:58] = 10
_OP_CODE[[ord(c) for c in CIGAR_OPS]] = range(len(CIGAR_OPS))


def encoded(row: dict, place: dict[str, int]) -> bytes:
    """A record of a row with the columns of SCHEMA; missing ones are unknown."""
    cigar, number = [], 0
    for c in (row.get("cigar") or "*").replace("*", ""):
        if c.isdigit():
            number = number * 10 + int(c)
        else:
            cigar.append(number << 4 | _OPS[c])
            number = 0
    seq = (row.get("seq") or "*").replace("*", "")
    qual = row.get("qual") or "*"
    codes = np.zeros(len(seq) + len(seq) % 2, np.uint8)
    codes[: len(seq)] = _CODE[np.frombuffer(seq.upper().encode(), np.uint8)]
    tags = _encoded_tags(dict(row.get("tags") or {}))
    pos, span = -1 if row.get("pos") is None else row["pos"], sum(x >> 4 for x in cigar if x & 15 in (0, 2, 3, 7, 8))
    if len(cigar) > 65535:
        tags += b"CGBI" + struct.pack("<i", len(cigar)) + struct.pack(f"<{len(cigar)}I", *cigar)
        cigar = [len(seq) << 4 | 4, span << 4 | 3]
    name = (row.get("read_id") or "*").encode() + b"\0"
    if len(name) > 255:
        raise ValueError(f"a read name of more than 254 bytes: {name[:40]!r}")
    of = lambda c: -1 if row.get(c) is None else place[row[c]]
    fixed = struct.pack("<iiBBHHHiiii", of("chrom"), pos, len(name), row.get("mapq") or 0, bin_of(max(pos, 0), max(pos, 0) + max(span, 1)), len(cigar), row.get("flag") or 0, len(seq), of("mate_chrom"), -1 if row.get("mate_pos") is None else row["mate_pos"], row.get("tlen") or 0)
    scores = b"\xff" * len(seq) if qual == "*" else (np.frombuffer(qual.encode(), np.uint8) - np.uint8(33)).tobytes()
    if len(scores) != len(seq):
        raise ValueError(f"{name[:-1].decode()}: {len(seq)} bases and {len(scores)} qualities")
    body = fixed + name + struct.pack(f"<{len(cigar)}I", *cigar) + (codes[::2] << 4 | codes[1::2]).tobytes() + scores + tags
    return struct.pack("<i", len(body)) + body


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of texts, and how many each has."""
    texts = texts.cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)), np.diff(at)


def _bins(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``bin_of`` of many."""
    out, last = np.zeros(len(start), np.int64), end - 1
    for shift, first in ((26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)):
        out = np.where(start >> shift == last >> shift, (first + (start >> shift)) & 0xFFFF, out)
    return out


def encoded_batch(b: pa.RecordBatch, place: dict[str, int]) -> bytes:
    """``encoded`` of all rows, by columns; row by row where a value is one that the columns' way doesn't know."""
    rows = lambda: b"".join(encoded(r, place) for r in b.to_pylist())
    names, n = set(b.schema.names), b.num_rows
    text = lambda c: pc.fill_null(b.column(c), "") if c in names else pa.array([""] * n, pa.string())
    number = lambda c, missing: (pc.fill_null(b.column(c), missing).to_numpy(zero_copy_only=False) if c in names else np.full(n, missing)).astype(np.int64)

    cigar, cigar_size = _flat(pc.replace_substring(text("cigar"), "*", ""))
    seq, n_bases = _flat(pc.replace_substring(text("seq"), "*", ""))
    code = _OP_CODE[cigar]
    is_op = code < 10
    ends = np.cumsum(cigar_size)[cigar_size > 0]
    ordinal = np.cumsum(is_op) - is_op  # of the operation that a digit belongs to
    where = np.flatnonzero(is_op)
    if not is_op[ends - 1].all() or (code == 255).any() or (seq > 127).any():
        return rows()
    power = where[ordinal] - 1 - np.arange(len(cigar)) if len(where) else np.zeros(len(cigar), np.int64)
    if power.max(initial=0) > 8:
        return rows()
    upto = np.cumsum(np.where(is_op, 0, (cigar.astype(np.int64) - 48) * 10 ** np.maximum(power, 0)))
    counts, ops = np.diff(upto[where], prepend=0), code[where].astype(np.int64)
    n_ops = _sums(is_op.astype(np.int64), cigar_size)
    span = _sums(np.where(np.isin(ops, (0, 2, 3, 7, 8)), counts, 0), n_ops)
    pos, flag, mapq, mate_pos, tlen = number("pos", -1), number("flag", 0), number("mapq", 0), number("mate_pos", -1), number("tlen", 0)
    within = lambda x, low, high: ((x >= low) & (x <= high)).all()
    if not (within(n_ops, 0, 65535) and within(counts, 0, (1 << 28) - 1) and within(flag, 0, 65535) and within(mapq, 0, 255) and all(within(x, -(1 << 31), (1 << 31) - 1) for x in (pos, mate_pos, tlen))):
        return rows()
    ids = {}
    for c in ("chrom", "mate_chrom"):
        found = pc.index_in(b.column(c), pa.array(place, b.column(c).type)) if c in names else pa.nulls(n, pa.int32())
        if c in names and found.null_count != b.column(c).null_count:
            return rows()
        ids[c] = pc.fill_null(found, -1).to_numpy(zero_copy_only=False)

    name = text("read_id")
    name, name_size = _flat(pc.if_else(pc.equal(name, ""), "*", name))
    if (name_size > 254).any():
        return rows()
    qual = text("qual")
    none = pc.or_(pc.equal(qual, ""), pc.equal(qual, "*"))
    scores, n_scores = _flat(pc.if_else(none, "", qual))
    none = none.to_numpy(zero_copy_only=False)
    if (n_scores[~none] != n_bases[~none]).any():
        return rows()
    tags = [b""] * n
    if "tags" in names:
        m = b.column("tags")
        at, keys, values = m.offsets.to_pylist(), m.keys.to_pylist(), m.items.to_pylist()
        tags = [_encoded_tags(dict(zip(keys[x:y], values[x:y], strict=True))) for x, y in zip(at, at[1:], strict=False)]
    tag_size = np.array([len(x) for x in tags], np.int64)
    packed_size = (n_bases + 1) // 2
    packed = np.zeros(2 * int(packed_size.sum()), np.uint8)
    packed[_spread(np.cumsum(2 * packed_size) - 2 * packed_size, n_bases)] = _CODE_ANY[seq]

    sizes = (np.full(n, 36, np.int64), name_size + 1, 4 * n_ops, packed_size, n_bases, tag_size)
    total = sum(sizes)
    starts = np.cumsum(total) - total
    fixed = np.zeros(n, FIXED)
    columns = {"size": total - 4, "ref": ids["chrom"], "pos": pos, "l_name": name_size + 1, "mapq": mapq, "bin": _bins(np.maximum(pos, 0), np.maximum(pos, 0) + np.maximum(span, 1)), "n_cigar": n_ops, "flag": flag, "l_seq": n_bases, "mate_ref": ids["mate_chrom"], "mate_pos": mate_pos, "tlen": tlen}
    for c, values in columns.items():
        fixed[c] = values
    out = np.zeros(int(total.sum()), np.uint8)
    at = starts
    name_at, cigar_at, packed_at, scores_at, tags_at = (at := at + size for size in sizes[:-1])
    out[_spread(starts, sizes[0])] = fixed.view(np.uint8)
    out[_spread(name_at, name_size)] = name  # and a zero byte
    out[_spread(cigar_at, sizes[2])] = (counts << 4 | ops).astype("<u4").view(np.uint8)
    out[_spread(packed_at, packed_size)] = packed[::2] << 4 | packed[1::2]
    out[_spread(scores_at, np.where(none, n_bases, 0))] = 255
    out[_spread(scores_at, np.where(none, 0, n_bases))] = scores - np.uint8(33)
    out[_spread(tags_at, tag_size)] = np.frombuffer(b"".join(tags), np.uint8)
    return out.tobytes()


def header_bytes(refs: list[tuple[str, int]], order: str = "unsorted") -> bytes:
    text = "".join([f"@HD\tVN:1.6\tSO:{order}\n", *(f"@SQ\tSN:{n}\tLN:{k}\n" for n, k in refs)]).encode()
    return MAGIC + struct.pack("<i", len(text)) + text + struct.pack("<i", len(refs)) + b"".join(struct.pack("<i", len(n.encode()) + 1) + n.encode() + b"\0" + struct.pack("<i", k) for n, k in refs)


class _Writer(DataSourceArrowWriter):
    """Each task's part is a whole file of its own; it gets its name when all are written."""

    def __init__(self, path: str, refs: list[tuple[str, int]], order: str, block_bytes: int):
        self.path, self.refs, self.order, self.block_bytes, self.stage = path.rstrip("/"), refs, order, block_bytes, f"_writing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        fs, inner = opened(self.path)
        fs.create_dir(f"{inner}/{self.stage}")
        context = TaskContext.get()
        name = f"part-{context.partitionId() if context else 0:05d}-{uuid.uuid4().hex[:8]}.bam"
        place = {n: i for i, (n, _) in enumerate(self.refs)}
        with fs.open_output_stream(f"{inner}/{self.stage}/{name}") as out:
            waiting = bytearray(header_bytes(self.refs, self.order))
            for b in iterator:
                waiting += encoded_batch(b, place)
                whole = len(waiting) - len(waiting) % self.block_bytes
                for at in range(0, whole, self.block_bytes):
                    out.write(block(bytes(waiting[at : at + self.block_bytes])))
                del waiting[:whole]
            if waiting:
                out.write(block(bytes(waiting)))
            out.write(END_OF_FILE)
        message = WriterCommitMessage()
        message.name = name
        return message

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, inner = opened(self.path)
        for m in messages:
            if m is not None:
                fs.move(f"{inner}/{self.stage}/{m.name}", f"{inner}/{m.name}")
        self._clear(fs, inner)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear(*opened(self.path))

    def _clear(self, fs: pafs.FileSystem, inner: str) -> None:
        if fs.get_file_info(f"{inner}/{self.stage}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{inner}/{self.stage}")


class BamSource(DataSource):
    """Options: path (several joined by line breaks), split_bytes, or ranges (path, begin, stop by line); for writing references (name, tab, length by line), sort_order, block_bytes."""

    @classmethod
    def name(cls) -> str:
        return "strandloom_bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        ranges = None
        if "ranges" in self.options:
            ranges = [Range(p, int(a), int(b)) for p, a, b in (line.split("\t") for line in self.options["ranges"].splitlines())]
        return _Reader(to_arrow_schema(schema), self.options.get("path", "").split("\n"), int(self.options.get("split_bytes", SPLIT)), ranges)

    def writer(self, schema, overwrite: bool) -> _Writer:
        refs = [(n, int(k)) for n, k in (line.split("\t") for line in self.options.get("references", "").splitlines())]
        fs, inner = opened(self.options["path"])
        if fs.get_file_info(inner).type == pafs.FileType.Directory and fs.get_file_info(pafs.FileSelector(inner)):
            raise ValueError(f"{self.options['path']} is not empty")
        return _Writer(self.options["path"], refs, self.options.get("sort_order", "unsorted"), int(self.options.get("block_bytes", 65280)))


def read_bam(spark: SparkSession, path: str | list[str], sample: str | None = None, columns: list[str] | None = None, split_bytes: int = SPLIT) -> DataFrame:
    """Records of files, or of folders of ``.bam`` files: sample and SCHEMA's columns, or those in ``columns`` alone.

    A ``*`` in the text form stays one in cigar, seq and qual; a missing reference is null. Tags are a map from the key to
    the value as text. A file without records gives none; one that is cut off or damaged raises an error.
    """
    spark.dataSource.register(BamSource)
    every = [x.split(" ")[0] for x in SCHEMA.split(", ")]
    if unknown := set(columns or ()) - set(every):
        raise ValueError(f"no columns {', '.join(sorted(unknown))} in binary alignments")
    wanted = ", ".join(x for x in SCHEMA.split(", ") if columns is None or x.split(" ")[0] in columns)
    rows = spark.read.format(BamSource.name()).schema(wanted).option("split_bytes", split_bytes).load("\n".join([path] if isinstance(path, str) else path))
    order = columns or every
    return rows.select(F.lit(sample).alias("sample"), *order)


def references(reads: DataFrame, lengths: DataFrame | None = None) -> list[tuple[str, int]]:
    """(name, length) for a header: of ``lengths`` (chrom, length), or as far as the reads' positions reach. One row a contig."""
    if lengths is None:
        reach = F.col("pos") + F.coalesce(F.length("seq"), F.lit(0)) + cigar_span(F.col("cigar"))
        mates = reads.select(F.col("mate_chrom").alias("chrom"), (F.col("mate_pos") + 1).alias("n")) if {"mate_chrom", "mate_pos"} <= set(reads.columns) else None
        rows = reads.select("chrom", reach.alias("n"))
        lengths = (rows if mates is None else rows.unionByName(mates)).filter("chrom is not null").groupBy("chrom").agg(F.max("n").alias("length"))
    return sorted((r["chrom"], int(r["length"])) for r in lengths.select("chrom", "length").collect())


def cigar_span(cigar: Column) -> Column:
    """Bases of the reference that an alignment covers, gaps included."""
    n = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    return F.aggregate(F.coalesce(n, F.array().cast("array<string>")), F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint"))


def write_bam(reads: DataFrame, path: str, lengths: DataFrame | None = None, coordinate_sorted: bool = False, block_bytes: int = 65280) -> None:
    """Reads (SCHEMA's columns; those that are missing are unknown) as a folder of files, one a partition, each whole by itself.

    coordinate_sorted: dealt by ranges of (chrom, pos) and sorted, unmapped reads last, so that the parts in order of
    their names are one sorted file. Null tag values go; whole numbers are stored as such, all else as text.
    """
    reads.sparkSession.dataSource.register(BamSource)
    refs = references(reads, lengths)
    wanted = [F.col(c).cast(k).alias(c) for c, k in (x.split(" ") for x in SCHEMA.split(", ")) if c in reads.columns]
    if coordinate_sorted:
        order = [F.asc_nulls_last("chrom"), F.asc_nulls_last("pos"), "read_id"]
        reads = reads.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = reads.select(*wanted)
    rows.write.format(BamSource.name()).mode("append").option("references", "\n".join(f"{n}\t{k}" for n, k in refs)).option("sort_order", "coordinate" if coordinate_sorted else "unsorted").option("block_bytes", block_bytes).save(path)


# Index, regions and reads as text

#: Bases of a row of the index, and its folder beside the files.
INDEX_WINDOW, INDEX = 1 << 14, "_index"


def index_bam(spark: SparkSession, path: str, window: int = INDEX_WINDOW, split_bytes: int = SPLIT) -> None:
    """Writes the index of a folder of files: for each file, chromosome and window of positions, where its records begin and end in the file, and how far they reach.

    Made for files sorted by place, right for any: a window's records lie between the two places, among others.
    """
    spark.dataSource.register(BamSource)
    rows = spark.read.format(BamSource.name()).schema(f"chrom string, pos long, {PLACES}").option("split_bytes", split_bytes).load(path)
    rows = rows.filter("chrom is not null and pos >= 0")
    index = rows.groupBy("file", "chrom", F.floor(F.col("pos") / window).alias("w")).agg(F.min("pos").alias("first"), F.max(F.greatest("end0", F.col("pos") + 1)).alias("reach"), F.min("begin").alias("begin"), F.max("next").alias("stop"), F.count("*").alias("n"))
    index.repartition("file").sortWithinPartitions("file", "chrom", "w").write.parquet(f"{path}/{INDEX}")


def read_bam_region(spark: SparkSession, path: str, chrom: str, start: int, end: int, columns: list[str] | None = None) -> DataFrame:
    """Records of an indexed folder that share a base of the reference with [start, end): only the stretches of files that the index names are read."""
    spark.dataSource.register(BamSource)
    index = spark.read.parquet(f"{path}/{INDEX}").filter((F.col("chrom") == chrom) & (F.col("first") < end) & (F.col("reach") > start))
    found = sorted((r["file"], r["begin"], r["stop"]) for r in index.select("file", "begin", "stop").collect())
    ranges: list[list] = []
    for file, begin, stop in found:  # stretches that meet are one
        if ranges and ranges[-1][0] == file and begin <= ranges[-1][2]:
            ranges[-1][2] = max(ranges[-1][2], stop)
        else:
            ranges.append([file, begin, stop])
    every = [x.split(" ")[0] for x in SCHEMA.split(", ")]
    order = columns or every
    wanted = ", ".join(x for x in SCHEMA.split(", ") if x.split(" ")[0] in {*order, "chrom", "pos"})
    lines = "\n".join(f"{path}/{f}\t{a}\t{b}" for f, a, b in ranges)
    rows = spark.read.format(BamSource.name()).schema(f"{wanted}, end0 long").option("ranges", lines).load()
    return rows.filter((F.col("chrom") == chrom) & (F.col("pos") < end) & (F.greatest("end0", F.col("pos") + 1) > start)).select(*order)


def to_fastq(reads: DataFrame) -> DataFrame:
    """read_id, seq and qual of each read once, as it was sequenced: without secondary and supplementary records, reversed ones turned back.

    Names of paired reads end in /1 or /2. Unknown bases are none; unknown qualities are 1 each.
    """
    flag = F.col("flag")
    rows = reads.filter(flag.bitwiseAND(0x900) == 0)
    seq = F.when(F.col("seq") == "*", "").otherwise(F.coalesce("seq", F.lit("")))
    qual = F.when((F.col("qual") == "*") | F.col("qual").isNull(), F.repeat(F.lit('"'), F.length(seq))).otherwise(F.col("qual"))
    turned = flag.bitwiseAND(16) != 0
    # The codes of bases and their complements.
    back = F.reverse(F.translate(seq, "ACGTRYKMBVDHacgtrykmbvdh", "TGCAYRMKVBHDtgcayrmkvbhd"))
    mate = F.when(flag.bitwiseAND(0xC1) == 0x41, "/1").when(flag.bitwiseAND(0xC1) == 0x81, "/2").otherwise("")
    return rows.select(F.concat("read_id", mate).alias("read_id"), F.when(turned, back).otherwise(seq).alias("seq"), F.when(turned, F.reverse(qual)).otherwise(qual).alias("qual"))


def write_fastq(reads: DataFrame, path: str, compression: str = "gzip") -> None:
    """Reads (read_id, seq, qual) as four-line records, a file a partition."""
    reads.select(F.concat(F.lit("@"), "read_id", F.lit("\n"), "seq", F.lit("\n+\n"), "qual").alias("value")).write.option("compression", compression).text(path)
