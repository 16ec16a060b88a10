"""Column expressions over nucleotide sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def window(seq: Column, start: Column, width: int | Column) -> Column:
    """``width`` bases from 0-based ``start``; empty for a start before the sequence, shorter at its end."""
    width = F.lit(width) if isinstance(width, int) else width
    return F.when(start < 0, F.lit("")).otherwise(F.substring(seq, (start + 1).cast("int"), width))


def motif_of(after_donor: Column, before_acceptor: Column, strand: Column) -> Column:
    """The two bases after the donor and the two before the acceptor, on the transcript's strand; NNNN without sequence."""
    four = F.upper(F.concat(after_donor, before_acceptor))
    return F.coalesce(F.when(strand == "-", reverse_complement(four)).otherwise(four), F.lit("NNNN"))


def splice_motif(seq: Column, donor: Column, acceptor: Column, strand: Column) -> Column:
    """``motif_of`` for positions on one whole sequence."""
    return motif_of(window(seq, donor, 2), window(seq, acceptor - 2, 2), strand)
