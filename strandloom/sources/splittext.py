"""Readers that frame records within splits of plain text files: reads (FASTQ) and sequences (FASTA), without a shuffle.

A split of reads begins at the first line from which four lines can be a record: ``@``, bases, ``+``, as many qualities.
Only one of any four lines can (qualities may begin with ``@``, but then a name, no ``+``, stands two lines below), so
every split's begin is a record's, and a split ends where the next begins, which each task checks.

A split of sequences may begin in the midst of a contig. A first pass counts each split's bases and names, two rows a
split for the driver, which tells every split the contig and the place that it goes on with. The second pass emits
chunks of a contig: the task in whose split a chunk begins reads on over the split's end for the rest of it. So a contig
of any length is many rows from many tasks.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from .files import SPLIT, Bytes, Split, dealt, listed, opened

READS = "read_id string, seq string, qual string"
LAYOUT = "path string, start long, k int, contig string, bases long, last boolean"
CHUNKS = "contig string, chunk int, start0 long, seq string"
WINDOW = 1 << 22
#: What is read first of a place from which little may be needed.
FIRST = 1 << 13
#: Rows, and about as many bytes of text, of a batch.
ROWS, TEXT = 1 << 14, 8 << 20
#: A name's line is at most so long.
NAME = 1 << 20
BLANK = b"\n\r\t "


def _paths(options) -> list[str]:
    return options["path"].split("\n")


# Reads


class Lines:
    """Lines of a file from a place on, with where each begins."""

    def __init__(self, file: Bytes, offset: int):
        self.file, self.base, self.data, self.pos = file, offset, b"", 0
        self.next, self.window = offset, FIRST

    @property
    def at(self) -> int:
        """Where the next line begins."""
        return self.base + self.pos

    def line(self) -> tuple[int, bytes] | None:
        """(begin, line without its end), or None at the file's end."""
        end = self.data.find(b"\n", self.pos)
        while end < 0:
            more = self.file.at(self.next, min(self.window, WINDOW))
            self.window = min(2 * self.window, WINDOW)
            if not more:
                if self.pos == len(self.data):
                    return None
                end = len(self.data)
                break
            had = len(self.data) - self.pos
            self.base, self.data, self.pos = self.at, self.data[self.pos :] + more, 0
            self.next += len(more)
            end = self.data.find(b"\n", had)
        begin, out = self.at, self.data[self.pos : end]
        self.pos = min(end + 1, len(self.data))
        return begin, out.rstrip(b"\r")


def first_read(file: Bytes, offset: int) -> int:
    """Where the first record that begins at or after ``offset`` begins; the file's size if there is none."""
    if offset <= 0:
        return 0
    lines, held = Lines(file, offset - 1), []
    if lines.line() is None:  # the rest of a line, or the end of the one before
        return file.size
    while (got := lines.line()) is not None:
        held.append(got)
        if len(held) == 4:
            (begin, name), (_, seq), (_, plus), (_, qual) = held
            if name[:1] == b"@" and plus[:1] == b"+" and len(seq) == len(qual):
                return begin
            del held[0]
    return file.size


def _framed(lines: Iterator[tuple[int, bytes]], path: str) -> Iterator[tuple[int, str, str, str]]:
    """(begin, id, bases, qualities) of the records of lines that begin with one."""
    for begin, name in lines:
        if not name.strip():
            continue  # blank lines between records, or at the end
        rest = [next(lines, (0, None))[1] for _ in range(3)]
        if name[:1] != b"@" or None in rest or rest[1][:1] != b"+" or len(rest[0]) != len(rest[2]):
            raise ValueError(f"{path}: no whole record at byte {begin}")
        words = name[1:].split(None, 1)
        yield begin, words[0].decode() if words else "", rest[0].decode(), rest[2].decode()


def _all_lines(path: str) -> Iterator[tuple[int, bytes]]:
    """Lines of a compressed file."""
    fs, inner = opened(path)
    with fs.open_input_file(inner) as raw, gzip.GzipFile(fileobj=io.BufferedReader(raw)) as text:
        at = 0
        for line in text:
            yield at, line.rstrip(b"\r\n")
            at += len(line)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[-1] or "") if isinstance(r[-1], str) else 8
        if len(held) >= ROWS or size >= TEXT:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def reads_of(split: Split) -> Iterator[tuple[str, str, str]]:
    """(id, bases, qualities) of the records that begin in a split; a compressed file is one split."""
    if split.path.endswith(".gz"):
        if split.start == 0:
            yield from (r[1:] for r in _framed(_all_lines(split.path), split.path))
        return
    with Bytes(split.path) as file:
        begin = first_read(file, split.start)
        if begin >= split.end:
            return
        stop = first_read(file, split.end) if split.end < file.size else file.size
        lines = Lines(file, begin)
        upto = begin
        for at, *record in _framed(iter(lines.line, None), split.path):
            if at >= split.end:
                if at != stop:
                    raise ValueError(f"{split.path}: records from byte {begin} go on at {at}, not at {stop}")
                return
            upto = lines.at
            yield tuple(record)
        if stop < file.size and upto <= stop:
            raise ValueError(f"{split.path}: records from byte {begin} end before {stop}")


class _Reads(DataSourceReader):
    def __init__(self, schema: pa.Schema, paths: list[str], size: int):
        self.schema, self.paths, self.size = schema, paths, size

    def partitions(self) -> list[Split]:
        files = listed(self.paths)
        whole = [Split(p, 0, n, n) for p, n in files if p.endswith(".gz")]
        return whole + dealt([f for f in files if not f[0].endswith(".gz")], self.size) or [Split("", 0, 0, 0)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        if partition.size:
            yield from _batches(reads_of(partition), self.schema)


class ReadsSource(DataSource):
    """Options: path (several joined by line breaks), split_bytes."""

    @classmethod
    def name(cls) -> str:
        return "strandloom_reads"

    def schema(self) -> str:
        return READS

    def reader(self, schema) -> _Reads:
        return _Reads(to_arrow_schema(schema), _paths(self.options), int(self.options.get("split_bytes", SPLIT)))


def read_fastq_splits(spark: SparkSession, path: str | list[str], split_bytes: int = SPLIT) -> DataFrame:
    """read_id, seq, qual of four-line records: plain files by splits, in place; gz files (by their suffix) one a task.

    Blank lines between records are passed over; anything else that is no whole record raises an error. Reads may be
    empty.
    """
    spark.dataSource.register(ReadsSource)
    return spark.read.format(ReadsSource.name()).option("split_bytes", split_bytes).load("\n".join([path] if isinstance(path, str) else path))


# Sequences


def _after_name(file: Bytes, offset: int) -> int:
    """``offset``, or the begin of the next line if ``offset`` lies within a name's line."""
    if offset <= 0:
        return 0
    back = file.at(max(0, offset - NAME), min(NAME, offset))
    begin = back.rfind(b"\n") + 1
    if begin == len(back) or back[begin : begin + 1] != b">" or (begin == 0 and offset > NAME):
        return offset
    return _line_end(file, offset)


def _line_end(file: Bytes, offset: int) -> int:
    """Where the line after that of ``offset`` begins."""
    window = FIRST
    while offset < file.size:
        data = file.at(offset, min(window, NAME))
        end = data.find(b"\n")
        if end >= 0:
            return offset + end + 1
        offset, window = offset + len(data), 2 * window
    return file.size


def _names(file: Bytes, start: int, end: int) -> Iterator[int]:
    """Places of ``>`` at a line's begin within [start, end)."""
    at, before = start, b"\n" if start == 0 else file.at(start - 1, 1)
    while at < end:
        data = before + file.at(at, min(WINDOW, end - at))
        k = data.find(b"\n>")
        while k >= 0:
            yield at + k  # one byte less for the one before
            k = data.find(b"\n>", k + 1)
        at, before = at + len(data) - 1, data[-1:]


def segments(file: Bytes, start: int, end: int) -> Iterator[tuple[str | None, int, int]]:
    """(contig, begin, end) of the stretches of sequence of a split: first what goes on from before (contig None)."""
    at = _after_name(file, start)
    if at >= end:
        yield None, at, at
        return
    contig, begin = None, at
    for place in _names(file, at, end):
        yield contig, begin, max(begin, place)
        after = _line_end(file, place)
        words = file.at(place + 1, min(after - place, NAME)).split(None, 1)
        line = file.at(place + 1, after - place - 1)
        contig, begin = (words[0].decode() if words and line[:1] not in (b" ", b"\t", b"\n", b"\r", b"") else ""), after
    yield contig, begin, max(begin, end)


def _bases(file: Bytes, begin: int, end: int) -> int:
    return sum(len(file.at(at, min(WINDOW, end - at)).translate(None, BLANK)) for at in range(begin, end, WINDOW))


@dataclass
class Placed(InputPartition):
    """A split, with the contig that it goes on with and the place in it."""

    split: Split
    contig: str | None
    base: int
    width: int
    overlap: int


def layout_of(split: Split) -> Iterator[tuple]:
    with Bytes(split.path) as file:
        found = [(contig, _bases(file, a, b)) for contig, a, b in segments(file, split.start, split.end)]
    for k, (contig, n) in enumerate(found):
        yield split.path, split.start, k, contig, n, k == len(found) - 1


def _stream(file: Bytes, begin: int, end: int, goes_on: bool) -> Iterator[tuple[bool, str]]:
    """(True, bases) of [begin, end), then (False, bases) of the same contig beyond, up to the next name."""
    for at in range(begin, end, WINDOW):
        yield True, file.at(at, min(WINDOW, end - at)).translate(None, BLANK).decode()
    at, before, window = end, file.at(end - 1, 1) if end else b"\n", FIRST
    while goes_on and (data := file.at(at, min(window, NAME))):
        stop = (before + data).find(b"\n>")
        if stop >= 0:
            yield False, data[:stop].translate(None, BLANK).decode()
            return
        yield False, data.translate(None, BLANK).decode()
        at, before, window = at + len(data), data[-1:], 2 * window


def chunks_of(part: Placed) -> Iterator[tuple[str, int, int, str]]:
    """(contig, chunk, start0, bases) of the chunks that begin in a split, each with the next ``overlap`` bases too.

    A contig without bases is one empty chunk.
    """
    whole = part.width + part.overlap
    with Bytes(part.split.path) as file:
        for contig, begin, end in segments(file, part.split.start, part.split.end):
            name, base = (part.contig, part.base) if contig is None else (contig, 0)
            if name is None:
                continue  # before the first name
            stream, text, limit = _stream(file, begin, end, end >= part.split.end), "", None  # limit: where the split's own bases end
            n, beyond = -(-base // part.width), ""
            while True:
                start = n * part.width
                while base + len(text) < start + whole and (limit is None or start < limit):
                    if base + len(text) <= start:  # nothing of the chunk yet
                        base, text = base + len(text), ""
                    inside, more = next(stream, (False, None))
                    if limit is None and not inside:
                        limit = base + len(text)
                    if more is None:
                        break
                    if limit is not None and start >= limit:
                        beyond = more
                        break
                    text += more
                if limit is not None and start >= limit:
                    if contig is not None and limit == 0 and not beyond and not any(more for _, more in stream):
                        yield name, 0, 0, ""
                    break
                yield name, n, start, text[start - base : start - base + whole]
                if 2 * (start - base) > len(text):  # seldom: a chunk is far shorter than what was read at once
                    base, text = start, text[start - base :]
                n += 1


class _Layout(DataSourceReader):
    def __init__(self, schema: pa.Schema, paths: list[str], size: int):
        self.schema, self.paths, self.size = schema, paths, size

    def partitions(self) -> list[Split]:
        return dealt(listed(self.paths), self.size) or [Split("", 0, 0, 0)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        if partition.size:
            yield from _batches(layout_of(partition), self.schema)


class LayoutSource(DataSource):
    """Options: path, split_bytes."""

    @classmethod
    def name(cls) -> str:
        return "strandloom_fasta_layout"

    def schema(self) -> str:
        return LAYOUT

    def reader(self, schema) -> _Layout:
        return _Layout(to_arrow_schema(schema), _paths(self.options), int(self.options.get("split_bytes", SPLIT)))


class _Chunks(DataSourceReader):
    def __init__(self, schema: pa.Schema, parts: list[Placed]):
        self.schema, self.parts = schema, parts

    def partitions(self) -> list[Placed]:
        return self.parts or [Placed(Split("", 0, 0, 0), None, 0, 1, 0)]

    def read(self, partition: Placed) -> Iterator[pa.RecordBatch]:
        if partition.split.size:
            yield from _batches(chunks_of(partition), self.schema)


class ChunksSource(DataSource):
    """Option parts: lines of path, start, end, size, contig and place that a split goes on with, width and overlap, by tabs."""

    @classmethod
    def name(cls) -> str:
        return "strandloom_fasta_chunks"

    def schema(self) -> str:
        return CHUNKS

    def reader(self, schema) -> _Chunks:
        parts = []
        for line in self.options.get("parts", "").splitlines():
            path, start, end, size, contig, base, width, overlap = line.split("\t")
            parts.append(Placed(Split(path, int(start), int(end), int(size)), contig[1:] if contig else None, int(base), int(width), int(overlap)))
        return _Chunks(to_arrow_schema(schema), parts)


def fasta_layout(spark: SparkSession, path: str | list[str], split_bytes: int = SPLIT) -> DataFrame:
    """LAYOUT: a row for each stretch of sequence of each split, in order (k), without a contig where it goes on from before."""
    spark.dataSource.register(LayoutSource)
    return spark.read.format(LayoutSource.name()).option("split_bytes", split_bytes).load("\n".join([path] if isinstance(path, str) else path))


def _carried(layout: DataFrame) -> dict[tuple[str, int], tuple[str | None, int]]:
    """(path, start) -> the contig and place that a split goes on with; from two rows a split."""
    ends = layout.filter("k = 0 or last").select("path", "start", "k", "contig", "bases").collect()
    out, before, name, base = {}, None, None, 0
    for r in sorted(ends, key=lambda r: (r["path"], r["start"], r["k"])):
        if r["path"] != before:
            before, name, base = r["path"], None, 0
        if r["k"] == 0:
            out[r["path"], r["start"]] = name, base
            base += r["bases"]
        else:
            name, base = r["contig"], r["bases"]
    return out


def read_fasta_chunks(spark: SparkSession, path: str | list[str], width: int = 1 << 20, overlap: int = 64, split_bytes: int = SPLIT) -> DataFrame:
    """contig, chunk, start0 and seq: pieces of ``width`` bases, each with the next ``overlap`` bases too, as ``screens.chunked`` makes them.

    A record begins at ``>`` at the start of a line; its name goes up to the first white space. What stands before the
    first name is passed over. Files are read by splits, none of them compressed.
    """
    carried = _carried(fasta_layout(spark, path, split_bytes))
    files = listed([path] if isinstance(path, str) else path)
    if packed := [p for p, _ in files if p.endswith(".gz")]:
        raise ValueError(f"{packed[0]}: compressed files have no splits; read them by read_fasta")
    lines = []
    for s in dealt(files, split_bytes):
        contig, base = carried[s.path, s.start]
        lines.append("\t".join(map(str, (s.path, s.start, s.end, s.size, "" if contig is None else f">{contig}", base, width, overlap))))
    spark.dataSource.register(ChunksSource)
    return spark.read.format(ChunksSource.name()).option("parts", "\n".join(lines)).load()


def fasta_lengths(spark: SparkSession, path: str | list[str], split_bytes: int = SPLIT) -> DataFrame:
    """chrom and length of every contig, summed over the splits that it runs through."""
    layout = fasta_layout(spark, path, split_bytes)
    names = [(p, s, name) for (p, s), (name, _) in _carried(layout).items() if name is not None]
    names = spark.createDataFrame(names, "p string, s long, name string")
    rows = layout.join(names, (F.col("path") == F.col("p")) & (F.col("start") == F.col("s")) & F.col("contig").isNull(), "left")
    return rows.select(F.coalesce("contig", "name").alias("chrom"), "bases").filter("chrom is not null").groupBy("chrom").agg(F.sum("bases").alias("length"))
