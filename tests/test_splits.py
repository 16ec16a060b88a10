"""Reads and sequences by splits of any size: the whole file's records, each once."""

from __future__ import annotations

import gzip
import random

import pytest

from strandloom.operators import screens
from strandloom.sources import sequences, splittext
from strandloom.sources.files import SPLIT, SPLITS, Bytes, dealt, splits


def test_reads_of_any_splits(monkeypatch, tmp_path):
    rng = random.Random(4)
    for trial in range(150):
        monkeypatch.setattr(splittext, "WINDOW", rng.choice([3, 20, 1 << 20]))
        end = rng.choice(["\n", "\r\n"])
        want = [(f"r{k}", (q := "".join(rng.choice("ACGT") for _ in range(rng.choice([0, 1, 4, 30])))), "".join(rng.choice("@+I#>") for _ in q)) for k in range(rng.choice([0, 1, 3, 12]))]
        text = "".join(f"@{n} x{end}{q}{end}+{end}{z}{end}" for n, q, z in want) + rng.choice(["", "\n"])
        path = tmp_path / f"{trial}.fq"
        path.write_bytes(text.encode())
        assert [r for s in splits([(str(path), len(text))], rng.choice([1, 2, 5, 17, 40, 10**6])) for r in splittext.reads_of(s)] == want


def test_sequences_of_any_splits(monkeypatch, tmp_path):
    rng = random.Random(5)
    monkeypatch.setattr(splittext, "NAME", 64)
    for trial in range(250):
        monkeypatch.setattr(splittext, "WINDOW", rng.choice([3, 7, 50, 1 << 20]))
        fold, width, overlap = rng.choice([3, 10, 10**6]), rng.choice([1, 4, 10, 50]), rng.choice([0, 1, 3, 12])
        text, contigs = rng.choice(["", "\n", "junk\n"]), []
        for k in range(rng.choice([0, 1, 2, 5])):
            seq = "".join(rng.choice("ACGTN") for _ in range(rng.choice([0, 0, 1, 5, 40, 90])))
            contigs.append((f"c{k}", seq))
            text += f">c{k} about > it\n" + "".join(seq[i : i + fold] + rng.choice(["\n", "\r\n"]) for i in range(0, len(seq), fold))
        text = text.rstrip("\n") if rng.random() < 0.3 else text
        path = tmp_path / f"{trial}.fa"
        path.write_bytes(text.encode())
        parts = splits([(str(path), len(text))], rng.choice([1, 2, 5, 17, 100, 10**6]))
        carried, name, base = {}, None, 0
        for s in parts:
            for _, start, k, contig, n, _ in splittext.layout_of(s):
                if k == 0:
                    carried[start], base = (name, base), base + n
                else:
                    name, base = contig, n
        got = [c for s in parts for c in splittext.chunks_of(splittext.Placed(s, *carried[s.start], width, overlap))]
        assert sorted(got) == sorted((name, n, n * width, seq[n * width : n * width + width + overlap]) for name, seq in contigs for n in range(max(1, -(-len(seq) // width))))


def test_a_contig_of_many_splits_feeds_the_screens(spark, tmp_path):
    rng = random.Random(6)
    seq = {c: "".join(rng.choice("ACGT") for _ in range(n)) for c, n in (("long", 300_000), ("short", 90), ("none", 0))}
    path = tmp_path / "g.fa"
    path.write_text("".join(f">{c} x\n" + "\n".join(s[i : i + 60] for i in range(0, len(s), 60)) + "\n" for c, s in seq.items()))
    chunks = splittext.read_fasta_chunks(spark, str(path), 4096, 64, split_bytes=20_000)
    whole = sequences.read_fasta(spark, str(path))
    key = lambda df: sorted(tuple(r) for r in df.select("contig", "chunk", "start0", "seq").collect())
    assert key(chunks) == key(screens.chunked(whole, 4096))
    assert chunks.rdd.getNumPartitions() == 16 and "Exchange" not in chunks._jdf.queryExecution().executedPlan().toString()
    assert {r.chrom: r.length for r in splittext.fasta_lengths(spark, str(path), 20_000).collect()} == {c: len(s) for c, s in seq.items()}
    j = spark.createDataFrame([("t", "long", "+", 4095, 4200), ("t", "long", "-", 10, 299_000), ("t", "gone", "+", 1, 5)], "tx string, contig string, strand string, donor long, acceptor long")
    motifs = lambda genome, width: sorted((r.donor, r.motif) for r in screens.with_windows(j, genome, {"motif": (screens.F.col("donor"), 2)}, width).collect())
    assert motifs(chunks, 4096) == [(1, None), (10, seq["long"][10:12]), (4095, seq["long"][4095:4097])]
    with pytest.raises(ValueError, match="no splits"):
        (tmp_path / "z.fa.gz").write_bytes(gzip.compress(b">a\nAC\n"))
        splittext.read_fasta_chunks(spark, str(tmp_path / "z.fa.gz"))


def test_reads_from_plain_and_compressed_files(spark, tmp_path):
    text = "".join(f"@r{k}/ccs z\n{'ACGT' * (k % 9)}\n+\n{'@III' * (k % 9)}\n" for k in range(2000))
    (tmp_path / "a.fastq").write_text(text)
    (tmp_path / "b.fastq.gz").write_bytes(gzip.compress(text.encode()))
    key = lambda df: sorted(tuple(r) for r in df.select("read_id", "seq", "qual").collect())
    plain = splittext.read_fastq_splits(spark, str(tmp_path / "a.fastq"), 5_000)
    assert key(plain) == key(sequences.read_fastq(spark, str(tmp_path / "a.fastq"))) == key(splittext.read_fastq_splits(spark, str(tmp_path / "b.fastq.gz"), 5_000))
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString() and plain.rdd.getNumPartitions() > 10
    assert splittext.read_fastq_splits(spark, [str(tmp_path / "a.fastq"), str(tmp_path / "b.fastq.gz")]).count() == 4000
    (tmp_path / "c.fastq").write_text(text[:-30] + "\n@x\nAC\n+\nI\n")
    (tmp_path / "d.fastq").write_text("")
    with pytest.raises(Exception, match="no whole record"):
        splittext.read_fastq_splits(spark, str(tmp_path / "c.fastq")).collect()
    assert splittext.read_fastq_splits(spark, str(tmp_path / "d.fastq")).count() == 0


def test_small_splits_of_large_files_stay_few():
    files = [("a", 6 << 30), ("b", 5)]
    assert len(dealt(files, 1 << 15)) <= SPLITS + len(files)
    assert [s for s in dealt(files, 1 << 15) if s.path == "b"] == splits([("b", 5)], 1 << 15)
    assert dealt([("a", 100)], 40) == splits([("a", 100)], 40)
    assert max(s.end - s.start for s in dealt([("a", 1 << 40)], 1 << 15)) == SPLIT


def test_framing_reads_little_more_than_the_split(monkeypatch, tmp_path):
    read = [0]
    at = Bytes.at

    def counted(self, offset, n):
        out = at(self, offset, n)
        read[0] += len(out)
        return out

    monkeypatch.setattr(Bytes, "at", counted)
    reads = tmp_path / "r.fq"
    reads.write_text("".join(f"@r{k}\n{'ACGT' * 100}\n+\n{'I@?5' * 100}\n" for k in range(8000)))
    middle = splits([(str(reads), reads.stat().st_size)], 1 << 16)[3]
    assert len(list(splittext.reads_of(middle))) > 70 and read[0] < 6 * (1 << 16)
    read[0] = 0
    contigs = tmp_path / "c.fa"
    contigs.write_text("".join(f">c{k}\n{'ACGT' * 700}\n" for k in range(2000)))
    size = contigs.stat().st_size
    assert len(list(splittext.layout_of(splits([(str(contigs), size)], size)[0]))) == 2001 and read[0] < 6 * size
