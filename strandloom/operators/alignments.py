"""What alignments say about the reference: exon blocks from CIGAR, mismatches from MD, depth and single-base variants.

CIGAR and MD are read together, once a read, in Arrow batches; the rest is grouped sums. No read becomes a row a base. Depth comes from events: one
more where an aligned block begins, one less where it ends, summed by position before anything is ordered. Running sums go
within bins of the position, with what the bins before add; a bin has at most two rows a position, however many reads
cover it, so a hot locus is as many tasks as it has bins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from strandloom.lineage import cut

from .reads import REVERSE, UNMAPPED, primary

SAMPLE_LOCUS = ("sample", "chrom")
WIDTH = 1 << 16
_BLOCK = "array<struct<start0:bigint,end0:bigint>>"


def cigar_ops(cigar: Column) -> Column:
    """Operations (n, op) of a CIGAR string; none of ``*``, null or an empty one."""
    of = lambda k: F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(k))
    return F.coalesce(F.transform(F.arrays_zip(of(1).alias("n"), of(2).alias("op")), lambda x: F.struct(x["n"].cast("bigint").alias("n"), x["op"].alias("op"))), F.array().cast("array<struct<n:bigint,op:string>>"))


def exon_blocks(pos: Column, cigar: Column) -> Column:
    """Blocks (start0, end0) between the gaps (N) of an alignment; deletions belong to their block, insertions and clips don't count."""
    n = lambda x: F.when(x["op"].isin("M", "=", "X", "D"), x["n"]).otherwise(0)
    block = lambda s: F.when(s["at"] > s["since"], F.array(F.struct(s["since"].alias("start0"), s["at"].alias("end0"))).cast(_BLOCK)).otherwise(F.array().cast(_BLOCK))
    state = lambda at, since, out: F.struct(at.alias("at"), since.alias("since"), out.alias("out"))
    start = pos.cast("bigint")
    step = lambda s, x: F.when(x["op"] == "N", state(s["at"] + x["n"], s["at"] + x["n"], F.concat(s["out"], block(s)))).otherwise(state(s["at"] + n(x), s["since"], s["out"]))
    return F.aggregate(cigar_ops(cigar), state(start, start, F.array().cast(_BLOCK)), step, lambda s: F.concat(s["out"], block(s)))


def mapped(reads: DataFrame) -> DataFrame:
    """Reads that are aligned once each: mapped, primary, with a position and operations."""
    return reads.filter(primary(F.col("flag")) & (F.col("flag").bitwiseAND(UNMAPPED) == 0) & F.col("chrom").isNotNull() & (F.col("pos") >= 0) & (F.size(cigar_ops(F.col("cigar"))) > 0))


def read_exons(reads: DataFrame, gene: Column | None = None) -> DataFrame:
    """Exon rows (tx, gene, chrom, strand, start0, end0) of mapped reads, as ``splice.transcripts`` takes them; the read is its transcript.

    A read's strand is that of its alignment. gene: what to name the gene by; null without.
    """
    strand = F.when(F.col("flag").bitwiseAND(REVERSE) != 0, "-").otherwise("+")
    keep = ["sample"] if "sample" in reads.columns else []
    rows = mapped(reads).select(*keep, F.col("read_id").alias("tx"), (F.lit(None).cast("string") if gene is None else gene).alias("gene"), "chrom", strand.alias("strand"), F.explode(exon_blocks(F.col("pos"), F.col("cigar"))).alias("b"))
    return rows.select(*keep, "tx", "gene", "chrom", "strand", "b.start0", "b.end0")


_OP = re.compile(r"([0-9]+)([MIDNSHP=X])")
_TOKEN = re.compile(r"[0-9]+|\^[A-Za-z]+|[A-Za-z]")


def matched(pos: int, cigar: str | None) -> list[tuple[int, int, int, int]]:
    """Pieces (ref, query, md, n) of an alignment in which bases of the read stand against the reference.

    ref and query: where the piece begins on the reference and in the read; md: bases of the reference before it that
    MD counts (gaps are not).
    """
    ref, query, md, out = pos, 0, 0, []
    for digits, op in _OP.findall(cigar or ""):
        n = int(digits)
        if op in "M=X":
            out.append((ref, query, md, n))
            ref, query, md = ref + n, query + n, md + n
        elif op == "D":
            ref, md = ref + n, md + n
        elif op == "N":
            ref += n
        elif op in "IS":
            query += n
    return out


def differing(pieces: list[tuple[int, int, int, int]], md: str, seq: str, qual: str | None, min_quality: int) -> Iterator[tuple[int, str, str]]:
    """Mismatches (pos, ref, alt) that MD and the read's bases show within its pieces."""
    at = 0
    for token in _TOKEN.findall(md):
        if token[0] == "^":
            at += len(token) - 1
        elif token.isdigit():
            at += int(token)
        else:
            piece = next((p for p in pieces if p[2] <= at < p[2] + p[3]), None)
            if piece is not None:
                q, ref = piece[1] + at - piece[2], token.upper()
                alt = seq[q : q + 1].upper()
                good = not min_quality or (qual is not None and q < len(qual) and ord(qual[q]) - 33 >= min_quality)
                if good and alt != ref and alt in ("A", "C", "G", "T"):
                    yield piece[0] + at - piece[2], ref, alt
            at += 1


def against_reference(reads: DataFrame, keys: tuple[str, ...] = SAMPLE_LOCUS, min_quality: int = 0, variants: bool = True) -> DataFrame:
    """What mapped reads show, by one pass over them: keys, start0, end0, ref, alt.

    A row an interval in which bases stand against the reference (ref and alt null), and with ``variants`` a row a mismatch
    (its position as start0, end0 null). Batches of reads are decoded at once, each read's CIGAR and MD by one match each.
    """
    named = ["cigar", *(["md", "seq", *(["qual"] if min_quality else [])] if variants else [])]
    kept = reads.filter(primary(F.col("flag")) & (F.col("flag").bitwiseAND(UNMAPPED) == 0) & F.col("chrom").isNotNull() & (F.col("pos") >= 0) & F.col("cigar").isNotNull())
    rows = kept.select(F.col("pos").cast("bigint").alias("__pos"), *(F.col(c).alias(f"__{c}") for c in named), *keys)
    at = 1 + len(named)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            own, starts, ends, refs, alts = [], [], [], [], []
            read = [b.column(k).to_pylist() for k in range(at)]
            read += [[None] * b.num_rows] * (5 - len(read))
            for k, (pos, cigar, md, seq, qual) in enumerate(zip(*read, strict=True)):
                pieces = matched(pos, cigar)
                found = list(differing(pieces, md, seq, qual, min_quality)) if md is not None and seq is not None else []
                own += [k] * (len(pieces) + len(found))
                starts += [p[0] for p in pieces] + [x[0] for x in found]
                ends += [p[0] + p[3] for p in pieces] + [None] * len(found)
                refs += [None] * len(pieces) + [x[1] for x in found]
                alts += [None] * len(pieces) + [x[2] for x in found]
            number = pa.array(own, pa.int64())
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([*(b.column(at + k).take(number) for k in range(len(keys))), *(pa.array(c, t) for c, t in zip((starts, ends, refs, alts), kinds, strict=True))], [*keys, "start0", "end0", "ref", "alt"])

    long, text = LongType(), StringType()
    return rows.mapInArrow(run, StructType([*(rows.schema[k] for k in keys), StructField("start0", long), StructField("end0", long), StructField("ref", text), StructField("alt", text)]))


def aligned_blocks(reads: DataFrame, keys: tuple[str, ...] = SAMPLE_LOCUS) -> DataFrame:
    """Intervals (keys, start0, end0) in which bases of mapped reads stand against the reference."""
    return against_reference(reads, keys, variants=False).select(*keys, "start0", "end0")


def _summed(events: DataFrame, keys: tuple[str, ...], width: int) -> tuple[DataFrame, DataFrame]:
    """Events (keys, pos, delta, and sums of other columns) by position with their bin, written; and a row a bin: before, next."""
    rows = cut(events.withColumn("bin", F.floor(F.col("pos") / width)), "events")
    bins = rows.groupBy(*keys, "bin").agg(F.sum("delta").alias("sum"), F.min("pos").alias("first"))  # one row a bin
    order = Window.partitionBy(*keys).orderBy("bin")
    bins = bins.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("bin").alias("__bin"), (F.sum("sum").over(order) - F.col("sum")).alias("__before"), F.lead("first").over(order).alias("__next"))
    on = F.col("bin") == F.col("__bin")
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"__{k}"))
    inside = Window.partitionBy(*keys, "bin").orderBy("pos")
    joined = rows.join(bins, on).withColumns({"depth": F.sum("delta").over(inside.rowsBetween(Window.unboundedPreceding, 0)) + F.col("__before"), "until": F.coalesce(F.lead("pos").over(inside), "__next")})
    return rows, joined.drop("__bin", "__before", "__next", *(f"__{k}" for k in keys))


def _steps(blocks: DataFrame, keys: tuple[str, ...], times: Column | None = None) -> DataFrame:
    """One more at each start and one less at each end, by position; ``times``: how many intervals a row stands for."""
    times = F.lit(1) if times is None else times
    ends = F.explode(F.array(F.struct(F.col("start0").alias("pos"), times.alias("delta")), F.struct(F.col("end0").alias("pos"), (-times).alias("delta"))))
    return blocks.filter("end0 > start0").select(*keys, ends.alias("e")).groupBy(*keys, "e.pos").agg(F.sum("e.delta").alias("delta"))


def depth_runs(blocks: DataFrame, keys: tuple[str, ...] = SAMPLE_LOCUS, width: int = WIDTH) -> DataFrame:
    """Maximal runs (keys, start0, end0, depth) of positions that equally many intervals cover, none of depth 0.

    Empty intervals count nowhere; rows with a null start or end too. Null keys are keys like others.
    """
    _, rows = _summed(_steps(blocks, keys).filter("delta <> 0"), keys, width)
    return rows.filter("depth > 0").select(*keys, F.col("pos").alias("start0"), F.col("until").alias("end0"), "depth")


def mismatches(reads: DataFrame, keys: tuple[str, ...] = SAMPLE_LOCUS, min_quality: int = 0) -> DataFrame:
    """One row a mismatch of a mapped read: keys, pos, ref and alt base. Reads need columns md, seq, and with ``min_quality`` qual.

    Without MD, or without bases, a read shows none. Bases N are no alternative.
    """
    return against_reference(reads, keys, min_quality).filter("ref is not null").select(*keys, F.col("start0").alias("pos"), "ref", "alt")


def snp_table(reads: DataFrame, min_coverage: int = 20, min_reads2: int = 4, keys: tuple[str, ...] = SAMPLE_LOCUS, width: int = WIDTH, min_quality: int = 0) -> DataFrame:
    """Single-base variants: keys, pos, ref, alt, depth, reads1 (of the reference), reads2 (of the variant) and var_freq.

    A position's variant is its most frequent other base (ties to the first in the alphabet) with at least ``min_reads2``
    reads, where at least ``min_coverage`` reads have a base. The depth there is the running sum of ``depth_runs`` at that
    very position: candidates are events that change nothing.
    """
    # Reads are read once: what they show is counted by place before anything else, on the map side first.
    shown = cut(against_reference(reads, keys, min_quality).groupBy(*keys, "start0", "end0", "ref", "alt").agg(F.count("*").alias("n")), "shown")
    by = shown.filter("ref is not null").select(*keys, F.col("start0").alias("pos"), "ref", "alt", "n")
    top = F.max_by(F.struct("alt", "n"), F.struct("n", (-F.ascii("alt")).alias("a"))).alias("top")
    candidates = by.groupBy(*keys, "pos", "ref").agg(top, F.sum("n").alias("others")).filter(F.col("top.n") >= min_reads2)
    kind = "struct<ref:string,alt:string,n:bigint,others:bigint>"
    flagged = candidates.select(*keys, "pos", F.lit(0).cast("bigint").alias("delta"), F.struct("ref", "top.alt", "top.n", "others").cast(kind).alias("v"))
    steps = _steps(shown.filter("ref is null"), keys, F.col("n")).withColumn("v", F.lit(None).cast(kind))
    events = steps.unionByName(flagged).groupBy(*keys, "pos").agg(F.sum("delta").alias("delta"), F.collect_list("v").alias("vs"))  # at most three references a position
    _, rows = _summed(events, keys, width)
    rows = rows.filter((F.size("vs") > 0) & (F.col("depth") >= min_coverage)).select(*keys, "pos", "depth", F.explode("vs").alias("v"))
    return rows.select(*keys, "pos", "v.ref", "v.alt", "depth", (F.col("depth") - F.col("v.others")).alias("reads1"), F.col("v.n").alias("reads2"), (F.col("v.n") / F.col("depth")).alias("var_freq"))
