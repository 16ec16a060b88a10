"""Isoform screens: each gives the ids (tx) that fail. A registry holds them by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.functions import coords, sequence
from strandloom.lineage import Observation, cut

from . import splice
from .intervals import interval_join, union_intervals
from .levels import Filed, filed, level_join

SCREENS: dict[str, Callable[..., DataFrame]] = {}


def register_screen(name: str, screen: Callable[..., DataFrame]) -> None:
    """Adds a screen: a function that returns a DataFrame with the failing ``tx``."""
    if name in SCREENS:
        raise ValueError(f"a screen named {name} exists")
    SCREENS[name] = screen


def screen(name: str):
    def add(f):
        register_screen(name, f)
        return f

    return add


def failed(ids: dict[str, DataFrame]) -> DataFrame:
    """(screen, tx) of all given results."""
    rows = [df.select(F.lit(n).alias("screen"), "tx").distinct() for n, df in sorted(ids.items())]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


@screen("monoexon_tss")
def monoexon_no_tss(tx: DataFrame, tss: DataFrame, reference_tss: DataFrame, sizes: DataFrame | None = None, distance: int = 10) -> DataFrame:
    """Mono-exon transcripts with a TSS row (tx, chrom, start0, end0) that no reference TSS lies within ``distance`` of.

    One such row fails the transcript; transcripts without TSS rows are kept. sizes (chrom, length): only known
    chromosomes count, and extended rows are clipped to them.
    """
    rows = tss.join(tx.filter(F.size("exons") == 1).select("tx"), "tx", "left_semi")
    length = None
    if sizes is not None:
        rows = rows.join(sizes.select("chrom", "length"), "chrom")
        length = F.col("length")
    lo, hi = coords.slop(F.col("start0"), F.col("end0"), distance, length)
    wide = rows.select("tx", "chrom", lo.alias("start0"), hi.alias("end0"))
    return level_join(wide, reference_tss.select("chrom", "start0", "end0"), how="left_anti").select("tx").distinct()


@screen("premrna")
def premrna_monoexon(tx: DataFrame, reference: DataFrame, min_overlap: int = 10) -> DataFrame:
    """Mono-exon transcripts that lie on a reference transcript's span and in one intron by ``min_overlap`` bases, but on no mono-exon reference; all on their strand."""
    place = lambda t: t.select("tx", "chrom", "strand", F.col("lo").alias("start0"), F.col("hi").alias("end0"), (F.size("exons") == 1).alias("mono"), coords.introns(F.col("exons")).alias("introns"))
    mono = filed(place(tx).filter("mono").select("tx", "chrom", "strand", "start0", "end0"))
    spans = filed(place(reference))  # read once; introns and mono-exons come from what is written
    keys = ("chrom", "strand")
    ref = spans.rows.select(*spans.columns)
    # Whoever lies in an intron lies on its transcript's span.
    introns = filed(ref.select("chrom", "strand", F.explode("introns").alias("i")).select("chrom", "strand", "i.start0", "i.end0"))
    enough = coords.overlap(F.col("a_start0"), F.col("a_end0"), F.col("b_start0"), F.col("b_end0")) >= min_overlap
    in_intron = level_join(mono, introns, enough, keys, "left_semi").select("tx")
    on_mono = level_join(mono, filed(ref.filter("mono").select("chrom", "strand", "start0", "end0")), keys=keys, how="left_semi").select("tx")
    return in_intron.distinct().join(on_mono.select(F.col("tx").alias("gone")).distinct(), F.col("tx").eqNullSafe(F.col("gone")), "left_anti")


def chunked(genome: DataFrame, width: int = 1 << 20, overlap: int = 64) -> DataFrame:
    """(contig, chunk, start0, seq): pieces of ``width`` bases, each with the next ``overlap`` bases too, so short windows never straddle."""
    n = F.greatest(F.ceil(F.length("seq") / width), F.lit(1)).cast("int")
    rows = genome.select("contig", "seq", F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk"))
    return rows.select("contig", "chunk", (F.col("chunk").cast("bigint") * width).alias("start0"), F.substring("seq", F.col("chunk") * width + 1, F.lit(width + overlap)).alias("seq"))


def with_windows(rows: DataFrame, genome: DataFrame, windows: dict[str, tuple[Column, int]], width: int = 1 << 20) -> DataFrame:
    """Adds a column for each of ``windows``: the (start, length) bases of the row's contig; null for an unknown contig.

    A start before the sequence gives no bases, one near its end fewer. Rows meet the chunk of the genome in which a
    window starts, by (contig, chunk), never a whole contig. genome: (contig, seq), or its chunks as ``chunked`` gives
    them with the same ``width``; windows are at most as long as the chunks overlap.
    """
    last, starts = None, {f"__s{i}": start for i, (start, _) in enumerate(windows.values())}
    if "chunk" in genome.columns:
        pieces = genome
    else:  # the genome is read once
        seen = Observation()
        pieces = cut(chunked(genome, width), "chunks", (seen, F.max("chunk").alias("last")))
        last = seen.get["last"]
    piece = pieces.select(F.col("contig").alias("__c"), F.col("chunk").alias("__k"), F.col("start0").alias("__at"), F.col("seq").alias("__seq"), F.lit(True).alias("__known"))
    out, names = rows.withColumns(starts), list(windows)

    def fill(met: DataFrame, which: list[int]) -> DataFrame:
        local = {names[i]: F.when(F.col("__known"), F.when(F.col(f"__s{i}") < 0, F.lit("")).otherwise(sequence.window(F.col("__seq"), F.col(f"__s{i}") - F.col("__at"), windows[names[i]][1]))) for i in which}
        return met.withColumns(local).drop("__c", "__k", "__at", "__seq", "__known")

    every = range(len(names))
    here = F.col("contig") == F.col("__c")
    if last == 0:  # every contig is one chunk
        return fill(out.join(piece, here & (F.col("__k") == 0), "left"), every).drop(*starts)
    ends = pieces.groupBy(F.col("contig").alias("__c")).agg(F.max("chunk").alias("__last"))
    at = {f"__w{i}": F.least(F.greatest(F.floor(F.col(f"__s{i}") / width), F.lit(0)), F.col("__last")).cast("int") for i in every}
    out = cut(out.join(ends, here, "left").withColumns(at).drop("__c", "__last"), "window-rows")  # read by both cases
    one = F.lit(True)
    for i in every:
        one &= F.col(f"__w{i}") == F.col("__w0")
    # Nearly all rows have their windows in one chunk: they meet it once. The others meet a chunk for each window.
    single = fill(out.filter(one).join(piece, here & (F.col("__w0") == F.col("__k")), "left"), every)
    apart = out.filter(~one)
    for i in every:
        apart = fill(apart.join(piece, here & (F.col(f"__w{i}") == F.col("__k")), "left"), [i])
    return single.unionByName(apart).drop(*starts, *at)


def _motif_windows() -> dict[str, tuple[Column, int]]:
    return {"__md": (F.col("donor"), 2), "__ma": (F.col("acceptor") - 2, 2)}


def _with_motif(rows: DataFrame) -> DataFrame:
    return rows.withColumn("motif", sequence.motif_of(F.col("__md"), F.col("__ma"), F.col("strand"))).drop("__md", "__ma")


def motifs(junctions: DataFrame, genome: DataFrame) -> DataFrame:
    """junctions (with contig, and donor and acceptor on it) with their motif; NNNN where the contig is unknown."""
    return _with_motif(with_windows(junctions, genome, _motif_windows()))


@screen("noncanonical")
def noncanonical_splice(junctions: DataFrame, genome: DataFrame, allowed: tuple[str, ...] = ("GTAG", "GCAG", "ATAC")) -> DataFrame:
    """Transcripts with a junction outside the allowed motifs: tx, motifs (distinct ones of all its bad junctions, sorted, comma-joined)."""
    return noncanonical_motifs(motifs(junctions, genome), allowed)


def noncanonical_motifs(rows: DataFrame, allowed: tuple[str, ...] = ("GTAG", "GCAG", "ATAC")) -> DataFrame:
    """``noncanonical_splice`` of junctions that have their motif."""
    bad = rows.filter(~F.col("motif").isin(*allowed))
    return bad.groupBy("tx").agg(F.array_join(F.array_sort(F.collect_set("motif")), ",").alias("motifs"))


CORE = 10


def _rt_sides(wiggle: int) -> dict[str, tuple[Column, int]]:
    n, plus = CORE + 2 * wiggle, F.col("strand") == "+"
    return {"__d": (F.when(plus, F.col("donor") - n + wiggle - 1).otherwise(F.col("donor") - wiggle - 1), n), "__a": (F.when(plus, F.col("acceptor") - n + wiggle).otherwise(F.col("acceptor") - wiggle), n)}


def _with_rt(rows: DataFrame) -> DataFrame:
    plus, d, a = F.col("strand") == "+", F.upper("__d"), F.upper("__a")
    back = sequence.reverse_complement
    return rows.withColumns({"seq_exon": F.when(plus, d).otherwise(back(a)), "seq_intron": F.when(plus, a).otherwise(back(d))})


def rt_windows(junctions: DataFrame, genome: DataFrame, wiggle: int = 1) -> DataFrame:
    """junctions with the exon and intron windows in which template switching shows; contigs without sequence are left out."""
    rows = with_windows(junctions, genome, _rt_sides(wiggle)).filter("__d is not null")
    return _with_rt(rows).drop("__d", "__a")


def motifs_and_windows(junctions: DataFrame, genome: DataFrame, wiggle: int = 1) -> tuple[DataFrame, DataFrame]:
    """What ``motifs`` and ``rt_windows`` give, from one meeting of junctions and genome, written."""
    rows = with_windows(junctions, genome, _motif_windows() | _rt_sides(wiggle)).withColumn("sequenced", F.col("__d").isNotNull())
    rows = cut(_with_rt(_with_motif(rows)).drop("__d", "__a"), "junction-windows")
    return rows.drop("sequenced", "seq_exon", "seq_intron"), rows.filter("sequenced").drop("sequenced", "motif")


def _first(hits: Column) -> Column:
    """Explodes the first element, or no row. As a generator, so that filters on the result don't evaluate ``hits`` again."""
    return F.explode(F.slice(hits, 1, 1))


def _exact_hits(a: Column, b: Column, m: int) -> Column:
    """(i, j), 0-based, of each run of ``m`` bases of ``a`` that is in ``b``, with its first place there; in order of i."""
    hits = F.transform(F.sequence(F.lit(0), F.greatest(F.length(a) - m, F.lit(0))), lambda i: F.struct(i.alias("i"), (F.call_function("instr", b, F.substring(a, i + 1, F.lit(m))) - 1).alias("j")))
    return F.filter(hits, lambda h: (h["j"] >= 0) & (F.length(a) >= m))


@screen("rt_switching")
def rt_switching(windows: DataFrame, min_match: int = 8, wiggle: int = 1) -> DataFrame:
    """Junctions whose windows share ``min_match`` bases, where the first such place ends inside both cores.

    The first place is the smallest (exon offset, intron offset); later ones are not looked at.
    """
    rows = windows.withColumn("hit", _first(_exact_hits(F.col("seq_exon"), F.col("seq_intron"), min_match)))
    core = F.length("seq_exon") - wiggle
    rows = rows.filter((F.col("hit.i") + min_match <= core) & (F.col("hit.j") + min_match <= core))
    return rows.select("tx", "junction", "chrom", "strand", "donor", "acceptor", F.lit(min_match).alias("match_len"), F.substring("seq_exon", F.col("hit.i") + 1, F.lit(min_match)).alias("match_pat"), F.lit(0).alias("mismatch"))


def rt_switching_mismatch(windows: DataFrame, min_match: int = 8, wiggle: int = 1) -> DataFrame:
    """As ``rt_switching``, with up to one mismatch beyond a seed of half the length, to the right or else to the left.

    For each exon offset of a seed, and each place of that seed in the intron window, in order: extend as far as the
    bases agree, then accept the rest to the right, else what is missing to the left, with at most one mismatch. All
    in array functions: the places are few (windows have at most 16 bases).
    """
    seed = min_match // 2
    a, b = F.col("seq_exon"), F.col("seq_intron")
    base = lambda s, k: F.substring(s, k + 1, F.lit(1))
    places = F.flatten(F.transform(F.sequence(F.lit(0), F.length(a) - seed), lambda i: F.transform(F.sequence(F.lit(0), F.length(b) - seed), lambda j: F.struct(i.alias("i"), j.alias("j")))))
    places = F.filter(places, lambda p: F.substring(a, p["i"] + 1, F.lit(seed)) == F.substring(b, p["j"] + 1, F.lit(seed)))

    def longest(p: Column) -> Column:
        most = F.least(F.length(a) - p["i"], F.length(b) - p["j"])
        run = F.aggregate(F.sequence(F.lit(0), most - 1), F.struct(F.lit(0).alias("k"), F.lit(True).alias("on")), lambda acc, t: F.struct(F.when(acc["on"] & (base(a, p["i"] + t) == base(b, p["j"] + t)), acc["k"] + 1).otherwise(acc["k"]).alias("k"), (acc["on"] & (base(a, p["i"] + t) == base(b, p["j"] + t))).alias("on")))
        return run["k"]

    def differ(i: Column, j: Column, m: Column) -> Column:
        return F.when(m <= 0, F.lit(0)).otherwise(F.aggregate(F.sequence(F.lit(0), F.greatest(m - 1, F.lit(0))), F.lit(0), lambda acc, t: acc + F.when(base(a, i + t) == base(b, j + t), 0).otherwise(1)))

    def judge(p: Column) -> Column:
        i, j, k = p["i"], p["j"], p["k"]
        m = F.lit(min_match) - k
        # Past the needed length (m < 0) the slices cross and are empty: a match of exactly min_match.
        fits = (i + k + m <= F.length(a)) & (j + k + m <= F.length(b))
        right = differ(i + k, j + k, m)
        left = differ(i - m, j - m, m)
        hit = lambda x, y, d: F.struct(x.alias("i"), y.alias("j"), d.alias("mismatch"))
        return F.when(fits & (right <= 1), hit(i, j, right)).when((i - m >= 0) & (j - m >= 0) & (left <= 1), hit(i - m, j - m, left))

    sized = F.transform(places, lambda p: F.struct(p["i"].alias("i"), p["j"].alias("j"), longest(p).alias("k")))
    rows = windows.filter((F.length(a) >= seed) & (F.length(b) >= seed)).withColumn("hit", _first(F.filter(F.transform(sized, judge), lambda h: h.isNotNull())))
    core = F.length("seq_exon") - wiggle
    rows = rows.filter((F.col("hit.i") + min_match <= core) & (F.col("hit.j") + min_match <= core))
    return rows.select("tx", "junction", "chrom", "strand", "donor", "acceptor", F.lit(min_match).alias("match_len"), F.substring("seq_exon", F.col("hit.i") + 1, F.lit(min_match)).alias("match_pat"), F.col("hit.mismatch").alias("mismatch"))


@screen("antisense")
def antisense(tx: DataFrame, reference: DataFrame, mode: str = "compat") -> DataFrame:
    """Transcripts that share a junction with a reference transcript of the other strand.

    compat: as the established screen works, a reference junction counts only where its row's strand differs from the
    first strand seen under the same reference name, which single-stranded names never have; so it finds nothing
    unless a name occurs on both strands. intended: any reference junction on the other strand.
    """
    own = tx.select("tx", "chrom", "strand", F.explode("chain").alias("j"))
    ref = reference.select(F.col("tx").alias("name"), F.col("chrom").alias("r_chrom"), F.col("strand").alias("r_strand"), F.explode("chain").alias("r_j"))
    if mode == "compat":
        first = reference.groupBy(F.col("tx").alias("name")).agg(F.min(F.struct("ord", "strand")).alias("f")).select("name", F.col("f.strand").alias("name_strand"))
        ref = ref.join(first, "name").filter("r_strand <> name_strand").withColumn("r_strand", F.lit(None).cast("string"))
        hit = own.join(ref, (F.col("chrom") == F.col("r_chrom")) & (F.col("j") == F.col("r_j")), "left_semi")
    else:
        hit = own.join(ref, (F.col("chrom") == F.col("r_chrom")) & (F.col("j") == F.col("r_j")) & (F.col("strand") != F.col("r_strand")), "left_semi")
    return hit.select("tx").distinct()


def exon_overlap(exons: DataFrame, regions: DataFrame, stranded: bool = False) -> DataFrame:
    """tx, total_exon_bp, overlap_bp, overlap_fraction: bases of a transcript's exons under merged regions."""
    keys = ("chrom", "strand") if stranded else ("chrom",)
    merged = union_intervals(regions, keys)
    hits = interval_join(exons, merged, keys=keys)
    bp = coords.overlap(F.col("a_start0"), F.col("a_end0"), F.col("b_start0"), F.col("b_end0"))
    over = hits.groupBy(F.col("a_tx").alias("tx")).agg(F.sum(bp).alias("overlap_bp"))
    total = exons.groupBy("tx").agg(F.sum(F.col("end0") - F.col("start0")).alias("total_exon_bp"))
    rows = total.join(over, "tx", "left").withColumn("overlap_bp", F.coalesce("overlap_bp", F.lit(0)))
    return rows.withColumn("overlap_fraction", F.round(coords.safe_fraction(F.col("overlap_bp").cast("double"), F.col("total_exon_bp")), 4)).select("tx", "total_exon_bp", "overlap_bp", "overlap_fraction")


@screen("region_overlap")
def region_overlap(exons: DataFrame, regions: DataFrame, min_fraction: float = 0.0, stranded: bool = False) -> DataFrame:
    """Transcripts with at least ``min_fraction`` of their exon bases under the regions; 0 means any base."""
    if min_fraction == 0:  # any base: neither sums nor merged regions are needed
        hits = interval_join(exons, regions, keys=("chrom", "strand") if stranded else ("chrom",))
        return hits.filter("a_tx is not null").select(F.col("a_tx").alias("tx")).distinct()
    rows = exon_overlap(exons, regions, stranded)
    return rows.filter(F.col("overlap_bp") / F.col("total_exon_bp") >= min_fraction).select("tx")


def segdup_report(tx: DataFrame, segdups: DataFrame, genes: DataFrame, levels: tuple[int, ...] = (1, 2, 3, 4), exon_fraction: float = 0.9, strict_compat: bool = True) -> DataFrame:
    """By transcript and level: contained, first/last terminal exons in segmental duplications, genes inside the terminal introns, their lengths.

    genes (chrom, start0, end0, n_exons). contained: the whole transcript inside a single duplication; strict_compat
    measures it from one base further right, as the established report does. A gene counts where it lies wholly inside
    the intron.
    """
    parts = filed(splice.numbered(tx))  # exons and introns, written once
    of = lambda kind: Filed(parts.rows.filter(F.col("kind") == kind), ["tx", "ord", "cnt", "chrom", "start0", "end0"], parts.levels)
    held_by = filed(segdups)
    shift = 1 if strict_compat else 0
    spans = tx.select("tx", "chrom", (F.col("lo") + shift).alias("start0"), F.col("hi").alias("end0"))
    inside = level_join(spans, held_by, (F.col("b_start0") <= F.col("a_start0")) & (F.col("b_end0") >= F.col("a_end0")), how="left_semi").select("tx").distinct().withColumn("contained", F.lit(True))
    enough = coords.overlap(F.col("a_start0"), F.col("a_end0"), F.col("b_start0"), F.col("b_end0")) >= exon_fraction * (F.col("a_end0") - F.col("a_start0"))
    exons = level_join(of("ex"), held_by, enough, how="left_semi")
    by_level = lambda df: df.withColumn("level", F.explode(F.array(*map(F.lit, levels))))
    last = F.col("ord") >= F.col("cnt") - (F.col("level") - 1)
    ex = by_level(exons).filter("cnt > level").groupBy("tx", "level").agg(
        (F.sum((F.col("ord") <= F.col("level")).cast("int")) == F.col("level")).alias("first_segdup"), (F.sum(last.cast("int")) == F.col("level")).alias("last_segdup")
    )
    held = level_join(of("in"), genes, (F.col("b_start0") >= F.col("a_start0")) & (F.col("b_end0") <= F.col("a_end0")))
    held = by_level(held.select(F.col("a_tx").alias("tx"), F.col("a_ord").alias("ord"), F.col("a_cnt").alias("cnt"), (F.col("a_end0") - F.col("a_start0")).alias("len"), F.col("b_n_exons").alias("n_exons"))).filter("cnt >= level")
    is_first, is_last, mono = F.col("ord") == F.col("level"), F.col("ord") == F.col("cnt") - (F.col("level") - 1), F.col("n_exons") == 1
    count = lambda c: F.sum(c.cast("int"))
    genes_in = held.groupBy("tx", "level").agg(
        count(is_first & mono).alias("first_mono"), count(is_first & ~mono).alias("first_multi"), F.coalesce(F.max(F.when(is_first, F.col("len"))), F.lit(0)).alias("first_len"),
        count(is_last & mono).alias("last_mono"), count(is_last & ~mono).alias("last_multi"), F.coalesce(F.max(F.when(is_last, F.col("len"))), F.lit(0)).alias("last_len"),
    )
    rows = ex.join(genes_in, ["tx", "level"], "full").join(inside, "tx", "left")
    zero = {c: 0 for c in ("first_mono", "first_multi", "first_len", "last_mono", "last_multi", "last_len")}
    rows = rows.na.fill(zero).na.fill({"first_segdup": False, "last_segdup": False, "contained": False})
    return rows.select("tx", "level", "contained", "first_segdup", "first_mono", "first_multi", "first_len", "last_segdup", "last_mono", "last_multi", "last_len")


@screen("segdup")
def segdup_terminal(report: DataFrame, min_intron: int = 100_000) -> DataFrame:
    """Transcripts with terminal exons in duplications behind a long intron that holds multi-exon genes, at any level."""
    bad = lambda side: F.col(f"{side}_segdup") & (F.col(f"{side}_multi") > 0) & (F.col(f"{side}_len") > min_intron)
    return report.filter(~F.col("contained") & (bad("first") | bad("last"))).select("tx").distinct()
