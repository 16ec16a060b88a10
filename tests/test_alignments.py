"""Binary alignments by splits, CIGAR and MD walks, depth, variants and end regions against plain loops."""

from __future__ import annotations

import glob
import random
import re
import struct
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strandloom.operators import alignments, reads, regions, splice
from strandloom.sources import bam, sequences
from strandloom.sources.files import Bytes, Split, splits

READS = "read_id string, sample string, chrom string, flag int, pos long, cigar string, seq string, md string"


def records(rng, n, longest=3000):
    """Rows of the source's columns, with gaps, clips, missing bases and qualities."""
    out = []
    for i in range(n):
        size = rng.choice([0, 1, 7, 50, 300, longest])
        seq = "".join(rng.choice("ACGTN") for _ in range(size)) or "*"
        third = size // 3
        cigar = "*" if not size else f"{size}M" if third == 0 else f"2S{third}M{rng.randrange(1, 900)}N{size - third - 3}M1I"
        chrom = rng.choice(["chr1", "chr2", None])
        tags = {"NM": str(rng.randrange(9)), "MD": "5A3", "XF": "1.5"}
        out.append((f"m/{i}/ccs", rng.choice([0, 16, 4, 256, 2048]), chrom, rng.randrange(10**6) if chrom else -1, rng.randrange(60), cigar, rng.choice([None, "chr1"]), rng.randrange(1000), rng.randrange(-500, 500), seq, "*" if seq == "*" or rng.random() < 0.1 else "".join(chr(33 + rng.randrange(90)) for _ in seq), tags))
    return out


def key(rows):
    return sorted((tuple(r[:11]) + (tuple(sorted((r[11] or {}).items())),) for r in rows), key=str)


def sam_line(r):
    mate = r[6] or "*"
    return "\t".join([r[0], str(r[1]), r[2] or "*", str(r[3] + 1), str(r[4]), r[5], mate, str(r[7] + 1), str(r[8]), r[9], r[10], *(f"{k}:{'f' if '.' in v else 'i' if v.isdigit() else 'Z'}:{v}" for k, v in r[11].items())])


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    rows = records(random.Random(3), 400) + records(random.Random(4), 3, longest=150_000)  # some run over two blocks
    path = str(tmp_path_factory.mktemp("bam") / "one")
    bam.write_bam(spark.createDataFrame(rows, bam.SCHEMA).coalesce(1), path)
    return rows, path


@pytest.mark.parametrize("size", [1 << 26, 50_000, 9_000])
def test_records_of_any_splits_are_those_written(spark, written, size):
    rows, path = written
    got = bam.read_bam(spark, path, split_bytes=size)
    assert key(r[1:] for r in got.collect()) == key(rows)
    assert got.rdd.getNumPartitions() == -(-sum(len(open(f, "rb").read()) for f in glob.glob(f"{path}/*.bam")) // size)


def test_text_form_gives_the_same_rows(spark, written, tmp_path):
    rows, path = written
    (tmp_path / "x.sam").write_text("@HD\tVN:1.6\n" + "\n".join(sam_line(r) for r in rows) + "\n")
    shared = ["read_id", "sample", "chrom", "flag", "pos", "cigar", "seq", "mapq", "qual"]
    plain, binary = sequences.read_sam(spark, str(tmp_path / "x.sam"), "a"), bam.read_bam(spark, path, "a", split_bytes=40_000)
    md5 = lambda df: sorted(tuple(r) for r in df.select(F.md5(F.concat_ws("|", *shared)).alias("h"), F.array_sort(F.map_entries("tags")).cast("string")).collect())
    assert md5(plain) == md5(binary)


def test_three_blocks_are_read_by_three_tasks(spark, tmp_path):
    rows = [(f"r{i}", 0, "chr1", i, 60, "40M", None, -1, 0, "ACGT" * 10, "I" * 40, {}) for i in range(600)]
    path = str(tmp_path / "three")
    bam.write_bam(spark.createDataFrame(rows, bam.SCHEMA).coalesce(1), path, block_bytes=22_000)  # no multiple of a record
    (name,) = glob.glob(f"{path}/*.bam")
    blocks, at, begins = bam.Blocks(Bytes(name)), 0, []
    while at < blocks.file.size:
        begins.append(at)
        at = blocks.data(at)[1]
    assert len(begins) == 3 + 1  # the last one marks the end
    schema = bam.to_arrow_schema(spark.createDataFrame([], bam.SCHEMA).select("read_id", "pos").schema)
    parts = [[p for b in bam.records(Split(name, lo, hi, blocks.file.size), schema) for p in b.column(1).to_pylist()] for lo, hi in zip(begins, [*begins[1:], blocks.file.size], strict=True)]
    assert [p for part in parts for p in part] == list(range(600)) and sum(bool(p) for p in parts) >= 3
    assert all(bam.first_record(blocks, b, bam.Header(blocks))[1] > 0 for b in begins[1:3])  # a record runs across each border


def test_only_asked_columns_are_decoded(spark, written, monkeypatch):
    _, path = written
    assert bam.read_bam(spark, path, columns=["pos", "read_id"]).columns == ["sample", "pos", "read_id"]
    with pytest.raises(ValueError, match="no columns"):
        bam.read_bam(spark, path, columns=["nothing"])


def test_damaged_and_empty_files(spark, written, tmp_path):
    _, path = written
    (name,) = glob.glob(f"{path}/*.bam")
    whole = open(name, "rb").read()
    schema = bam.to_arrow_schema(spark.createDataFrame([], bam.SCHEMA).schema)
    for bad in (whole[:30_000], whole[:40_000] + b"\0\0\0\0" + whole[40_004:]):
        (tmp_path / "bad.bam").write_bytes(bad)
        with pytest.raises(ValueError):
            for s in splits([(str(tmp_path / "bad.bam"), len(bad))]):
                list(bam.records(s, schema))
    bam.write_bam(spark.createDataFrame([], bam.SCHEMA), str(tmp_path / "none"))
    (tmp_path / "empty.bam").write_bytes(bam.block(bam.header_bytes([("chr1", 5)])) + bam.END_OF_FILE)
    assert bam.read_bam(spark, str(tmp_path / "empty.bam")).count() == 0
    assert [list(bam.records(s, schema)) for s in splits([(str(tmp_path / "empty.bam"), (tmp_path / "empty.bam").stat().st_size)], 20)][0] == []


def test_more_operations_than_the_field_counts(spark, tmp_path):
    cigar = "1M1I" * 40_000
    rows = [("long", 0, "chr1", 5, 60, cigar, None, -1, 0, "AC" * 40_000, "*", {"NM": "3"})]
    path = str(tmp_path / "long")
    bam.write_bam(spark.createDataFrame(rows, bam.SCHEMA).coalesce(1), path)
    (got,) = bam.read_bam(spark, path).collect()
    assert got.cigar == cigar and got.tags == {"NM": "3"}


def test_tags_of_every_kind():
    raw = b"AAAx" + b"ACc" + struct.pack("b", -3) + b"BCC" + b"\xff" + b"DDs" + struct.pack("<h", -300) + b"EES" + struct.pack("<H", 60000) + b"FFI" + struct.pack("<I", 1 << 31) + b"GGf" + struct.pack("<f", 0.25) + b"HHZhi there\0" + b"IIH1AE3\0" + b"JJBs" + struct.pack("<i2h", 2, -1, 7)
    assert bam._tags(raw) == {"AA": "x", "AC": "-3", "BC": "255", "DD": "-300", "EE": "60000", "FF": "2147483648", "GG": "0.25", "HH": "hi there", "II": "1AE3", "JJ": "s,-1,7"}


def test_sorted_files_are_in_order(spark, written, tmp_path):
    rows, _ = written
    bam.write_bam(spark.createDataFrame(rows, bam.SCHEMA).repartition(5), str(tmp_path / "sorted"), coordinate_sorted=True)
    seen = []
    for f in sorted(glob.glob(f"{tmp_path}/sorted/*.bam")):
        seen += [(r.chrom is None, r.chrom or "", r.pos) for r in bam.read_bam(spark, f, columns=["chrom", "pos"]).coalesce(1).collect()]
    assert seen == sorted(seen) and len(seen) == len(rows)


def test_a_region_reads_the_stretches_that_the_index_names(spark, tmp_path):
    rng = random.Random(12)
    rows = [(f"r{i}", 0, rng.choice(["chr1", "chr2", None]), rng.randrange(200_000), 60, rng.choice(["50M", "20M3000N20M", "10M5I10M"]), None, -1, 0, "*", "*", {}) for i in range(6000)]
    path = str(tmp_path / "x")
    bam.write_bam(spark.createDataFrame(rows, bam.SCHEMA).repartition(4), path, coordinate_sorted=True, block_bytes=2000)
    bam.index_bam(spark, path, window=1 << 12, split_bytes=20_000)
    index = spark.read.parquet(f"{path}/{bam.INDEX}").collect()
    assert sum(r.n for r in index) == sum(r[2] is not None for r in rows)
    for chrom, lo, hi in (("chr1", 50_000, 51_000), ("chr2", 0, 200_000), ("chr2", 199_999, 300_000), ("chr9", 0, 10)):
        got = bam.read_bam_region(spark, path, chrom, lo, hi, ["read_id", "cigar"])
        assert sorted(r.read_id for r in got.collect()) == sorted(r[0] for r in rows if r[2] == chrom and r[3] < hi and r[3] + sum(e - s for s, e in [(walk(0, r[5])[0][0][0], walk(0, r[5])[0][-1][1])]) > lo)
    named = [r for r in index if r.chrom == "chr1" and r.first < 51_000 and r.reach > 50_000]
    schema = bam.to_arrow_schema(spark.createDataFrame([], bam.SCHEMA).select("read_id").schema)
    assert 0 < sum(b.num_rows for r in named for b in bam.records(bam.Range(f"{path}/{r.file}", r.begin, r.stop), schema)) < 400  # of 6,000


def test_reads_as_they_were_sequenced(spark):
    rows = [("a", 0, "ACGTN", "IIIH#"), ("b", 16, "AACRG", "ABCDE"), ("c", 256, "A", "I"), ("d", 2048, "A", "I"), ("e", 4, "*", "*"), ("f", 16 | 1 | 64, "AC", "*"), ("g", 1 | 128, "AC", None)]
    got = {r.read_id: (r.seq, r.qual) for r in bam.to_fastq(spark.createDataFrame(rows, "read_id string, flag int, seq string, qual string")).collect()}
    assert got == {"a": ("ACGTN", "IIIH#"), "b": ("CYGTT", "EDCBA"), "e": ("", ""), "f/1": ("GT", '""'), "g/2": ("AC", '""')}


def test_reads_of_a_binary_file_feed_the_operators(spark, tmp_path):
    rows = [(f"r{i}", 0, "chrM" if i % 2 else "chr1", i, 60, "10M100N10M" if i % 3 else "5M5I10M", None, -1, 0, "*", "*", {}) for i in range(200)]
    bam.write_bam(spark.createDataFrame(rows, bam.SCHEMA), str(tmp_path / "x"))
    df = bam.read_bam(spark, str(tmp_path / "x"), "s")
    assert Counter(r.chrom for r in reads.reservoir_cap(df, 30, keys=("sample",)).collect()) == {"chr1": 100, "chrM": 30}
    tx = {r.tx: r for r in splice.transcripts(alignments.read_exons(df)).collect()}
    assert len(tx) == 200 and [(j.donor, j.acceptor) for j in tx["r1"].chain] == [(11, 111)] and tx["r0"].chain == [] and tx["r0"].hi == 15


# CIGAR and MD


def walk(pos, cigar):
    """(exon blocks, aligned places as (reference, query), deleted places) by a plain loop."""
    exons, start, ref, query, places, gone = [], pos, pos, 0, [], []
    for n, op in ((int(a), b) for a, b in re.findall(r"(\d+)([MIDNSHP=X])", cigar or "")):
        if op in "M=X":
            places += [(ref + k, query + k) for k in range(n)]
        if op == "D":
            gone += range(ref, ref + n)
        if op == "N":
            exons, start = exons + [(start, ref)] * (ref > start), ref + n
        ref, query = ref + n * (op in "M=XDN"), query + n * (op in "M=XIS")
    return exons + [(start, ref)] * (ref > start), places, gone


def md_of(cigar, pos, seq, genome):
    """MD of an alignment to a genome, as aligners write it."""
    out, run, ref, query = "", 0, pos, 0
    for n, op in ((int(a), b) for a, b in re.findall(r"(\d+)([MIDNSHP=X])", cigar)):
        if op in "M=X":
            for k in range(n):
                if seq[query + k] == genome[ref + k]:
                    run += 1
                else:
                    out, run = f"{out}{run}{genome[ref + k]}", 0
        if op == "D":
            out, run = f"{out}{run}^{genome[ref : ref + n]}", 0
        ref, query = ref + n * (op in "M=XDN"), query + n * (op in "M=XIS")
    return f"{out}{run}"


@pytest.fixture(scope="module")
def aligned():
    rng = random.Random(8)
    genome = {c: "".join(rng.choice("ACGT") for _ in range(700)) for c in ("c1", "c2")}
    rows = []
    for i in range(300):
        chrom, pos = rng.choice(["c1", "c2"]), rng.randrange(300)
        cigar = rng.choice(["30M", "2S20M1I9M", "10M50N5M2D20M3H", "8=1X6M1D3M40N1I9M", "5M10N5M20N5M", "4S"])
        seq, at = "", pos
        for n, op in ((int(a), b) for a, b in re.findall(r"(\d+)([MIDNSHP=X])", cigar)):
            if op in "M=X":
                seq += "".join(rng.choice("ACGTN") if rng.random() < 0.2 else genome[chrom][at + k] for k in range(n))
            elif op in "IS":
                seq += "A" * n
            at += n * (op in "M=XDN")
        rows.append((f"r{i}", f"s{i % 2}", chrom, rng.choice([0, 0, 0, 16, 256, 4]), pos, cigar, seq, md_of(cigar, pos, seq, genome[chrom])))
    return rows + [("n1", "s0", None, 0, 5, "5M", "AAAAA", "5"), ("n2", "s0", "c1", 0, 5, None, None, None), ("n3", "s0", "c1", 0, 5, "*", "*", ""), ("n4", "s0", "c1", 0, None, "5M", "AAAAA", None)]


def used(rows):
    return [r for r in rows if r[2] and r[4] is not None and r[5] not in (None, "*") and not r[3] & 2308]


def test_exons_of_alignments(spark, aligned):
    got = Counter(tuple(r) for r in alignments.read_exons(spark.createDataFrame(aligned, READS)).select("tx", "chrom", "strand", "start0", "end0").collect())
    assert got == Counter((r[0], r[2], "-" if r[3] & 16 else "+", s, e) for r in used(aligned) for s, e in walk(r[4], r[5])[0])


@pytest.mark.parametrize("width", [16, 1 << 16])
def test_depth_and_variants_equal_plain_loops(spark, aligned, width):
    df = spark.createDataFrame(aligned, READS)
    depth, seen = Counter(), defaultdict(Counter)
    for r in used(aligned):
        _, places, _ = walk(r[4], r[5])
        at = 0
        depth.update((r[1], r[2], p) for p, _ in places)
        order = sorted([(p, q) for p, q in places] + [(p, None) for p in walk(r[4], r[5])[2]])
        for t in re.findall(r"\d+|\^[A-Z]+|[A-Z]", r[7]):
            if t[0].isdigit():
                at += int(t)
            elif t[0] == "^":
                at += len(t) - 1
            else:
                p, q = order[at]
                at += 1
                if r[6][q] in "ACGT" and r[6][q] != t:
                    seen[r[1], r[2], p, t][r[6][q]] += 1
    got = Counter()
    runs = alignments.depth_runs(alignments.aligned_blocks(df), width=width).collect()
    for r in runs:
        got.update({(r.sample, r.chrom, p): r.depth for p in range(r.start0, r.end0)})
    assert got == depth
    assert len(runs) == len({(s, c, p) for s, c, p in depth if depth[s, c, p] != depth.get((s, c, p - 1), 0)})  # maximal
    want = set()
    for (s, c, p, t), alts in seen.items():
        n, alt = max((n, -ord(a)) for a, n in alts.items())
        if n >= 2 and depth[s, c, p] >= 6:
            want.add((s, c, p, t, chr(-alt), depth[s, c, p], depth[s, c, p] - sum(alts.values()), n))
    snps = alignments.snp_table(df, 6, 2, width=width).collect()
    assert {tuple(r)[:8] for r in snps} == want and len(snps) == len(want) > 5


def test_quality_of_mismatches(spark):
    df = spark.createDataFrame([("a", "s", "c", 0, 10, "4M", "AACA", "2G1", "II#I"), ("b", "s", "c", 0, 10, "4M", "AATA", "2G1", "IIII")], READS + ", qual string")
    assert [(r.pos, r.ref, r.alt) for r in alignments.mismatches(df, min_quality=20).collect()] == [(12, "G", "T")]


def test_a_hot_locus_is_a_bounded_number_of_rows(spark):
    """100,000 reads of one place: rows to order are positions, not reads."""
    df = spark.range(100_000).select((F.col("id") % 50).alias("start0"), (F.col("id") % 50 + 200).alias("end0"), F.lit("c").alias("chrom"), F.lit("s").alias("sample"))
    steps = alignments._steps(df, ("sample", "chrom"))
    assert steps.count() == 100
    runs = alignments.depth_runs(df, width=16)
    assert runs.agg(F.max("depth")).first()[0] == 100_000 and runs.agg(F.sum(F.expr("depth * (end0 - start0)"))).first()[0] == 100_000 * 200
    assert alignments.depth_runs(df.limit(0)).count() == 0


# End regions


def test_regions_are_chains_whatever_the_bins(spark):
    rng = random.Random(5)
    pts = [(rng.choice(["c1", None]), rng.choice("+-"), f"s{rng.randrange(3)}", rng.choice([None, *range(0, 3000, 7)]), rng.randrange(1, 9)) for _ in range(400)]
    pts += [("c1", "+", "s0", 5000 + 40 * k, 1) for k in range(30)]  # one chain over many bins
    df = spark.createDataFrame(pts, "chrom string, strand string, sample string, pos long, n long")
    by = defaultdict(Counter)
    for c, st, _, p, n in pts:
        if p is not None:
            by[c, st][p] += n
    want, counts = set(), Counter()
    for (c, st), at in by.items():
        chain = []
        for p in [*sorted(at), float("inf")]:
            if chain and p - chain[-1] > 50:
                n = sum(at[q] for q in chain)
                if n >= 4:
                    want.add((c, st, chain[0], chain[-1] + 1, n, len(chain), min(chain, key=lambda q: (-at[q], q))))  # noqa: B023
                    counts.update({(c, st, chain[0], s): x for s in ("s0", "s1", "s2") if (x := sum(n for c2, st2, s2, p2, n in pts if (c2, st2, s2) == (c, st, s) and p2 in set(chain)))})
                chain = []
            chain.append(p)
    for width in (32, 1 << 16):
        found, by_sample = regions.end_regions(df, min_reads=4, width=width)
        assert {tuple(r) for r in found.select("chrom", "strand", "start0", "end0", "n", "n_pos", "mode").collect()} == want
        assert {tuple(r)[:4]: r.n for r in by_sample.select("chrom", "strand", "start0", "sample", "n").collect()} == counts
    assert any(r[2] == 5000 and r[3] == 6161 for r in want)


def test_ends_move_to_the_mode_of_their_region(spark):
    starts = spark.createDataFrame([("c", "+", 100, 160, 130), ("c", "-", 480, 520, 500)], "chrom string, strand string, start0 long, end0 long, mode long")
    stops = spark.createDataFrame([("c", "+", 90, 121, 110), ("c", "-", 380, 420, 390)], "chrom string, strand string, start0 long, end0 long, mode long")
    tx = spark.createDataFrame([("a", "c", "+", 105, 300), ("b", "c", "-", 400, 510), ("crossed", "c", "+", 105, 120), ("out", "c", "+", 170, 300), ("none", None, "+", 105, 300)], "tx string, chrom string, strand string, lo long, hi long")
    got = {r.tx: (r.lo, r.hi) for r in regions.with_region_modes(tx, starts, stops).collect()}
    assert got == {"a": (130, 300), "b": (390, 500), "crossed": (105, 120), "out": (170, 300), "none": (105, 300)}


def test_records_by_columns_are_those_by_rows(spark, monkeypatch):
    place = {"chr1": 0, "chr2": 1}
    schema = bam.to_arrow_schema(spark.createDataFrame([], bam.SCHEMA).schema)
    names = [f.name for f in schema]
    rows = records(random.Random(8), 300, longest=400)
    rows += [(None,) * 12, ("", 0, None, None, None, "", None, None, None, "acgtn", "", None), ("x", 65535, "chr2", 2**31 - 1, 255, "268435455N1M", "chr2", -1, -(2**31), "A", "~", {"AB": "-7", "CD": None, "EF": "2147483648"})]
    rows = [dict(zip(names, r, strict=True)) for r in rows]
    plain = [{**r, "tags": list(r["tags"].items()) if r["tags"] is not None else None} for r in rows]
    batch = bam.pa.RecordBatch.from_pylist(plain, schema=schema)
    want = b"".join(bam.encoded(r, place) for r in batch.to_pylist())
    odd = [{**plain[0], "cigar": "3M5", "seq": "ACG", "qual": "*"}, {**plain[0], "cigar": "0000000000003M", "seq": "ACG", "qual": "*"}]
    odd = bam.pa.RecordBatch.from_pylist(odd, schema=schema)
    assert bam.encoded_batch(odd, place) == b"".join(bam.encoded(r, place) for r in odd.to_pylist())
    few = batch.select(["pos", "read_id"])
    want_few = b"".join(bam.encoded(r, place) for r in few.to_pylist())
    cut_off = b"".join(bam.encoded(r, place) for r in batch.slice(7, 90).to_pylist())
    for bad in ({"qual": "I" * 999}, {"read_id": "r" * 255}, {"flag": 1 << 16}, {"chrom": "gone"}, {"cigar": "3Q"}):
        with pytest.raises((ValueError, KeyError, struct.error)):
            bam.encoded_batch(bam.pa.RecordBatch.from_pylist([{**plain[0], **bad}], schema=schema), place)
    monkeypatch.setattr(bam, "encoded", None)  # ordinary rows go by columns
    assert bam.encoded_batch(batch, place) == want and bam.encoded_batch(few, place) == want_few and bam.encoded_batch(batch.slice(7, 90), place) == cut_off
    assert bam.encoded_batch(batch.slice(0, 0), place) == b""
