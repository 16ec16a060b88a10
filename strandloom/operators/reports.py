"""Cohort reports: pivots, balance sheets, sequence statistics, length histograms, novel-gene rescue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def to_wide(long: DataFrame, how: str = "first", metrics: list[str] | None = None, missing: str = "NA") -> DataFrame:
    """sample x metric of (sample, metric, value, pos): first by position (default), sum or mean; columns in order of appearance.

    Where any value of a metric isn't a number, sums and means of it are not taken but the first stays.
    """
    if metrics is None:
        metrics = [r["metric"] for r in long.groupBy("metric").agg(F.min("pos").alias("p")).orderBy("p").collect()]
    number = F.expr("try_cast(value as double)")
    value = {"first": F.min(F.struct("pos", "value"))["value"], "sum": F.sum(number).cast("string"), "mean": F.avg(number).cast("string")}[how]
    if how != "first":
        value = F.when(F.max((number.isNull() & F.col("value").isNotNull()).cast("int")) == 1, F.min(F.struct("pos", "value"))["value"]).otherwise(value)
    return long.groupBy("sample").pivot("metric", metrics).agg(value).na.fill(missing)


def balance(original: DataFrame, failures: DataFrame) -> DataFrame:
    """(metric, value, filter): removed by each screen, by all together, original and remaining. failures: screen, tx."""
    real = failures.filter("tx is not null").distinct()
    each = real.groupBy("screen").agg(F.count_distinct("tx").alias("value")).select(F.lit("removed").alias("metric"), "value", F.col("screen").alias("filter"))
    gone = original.join(real.select("tx").distinct().withColumn("gone", F.lit(1)), "tx", "left").agg(F.count("*").alias("n"), F.coalesce(F.sum("gone"), F.lit(0)).alias("g"))
    rows = F.array(*(F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in (("removed_union", F.col("g")), ("original", F.col("n")), ("remaining", F.col("n") - F.col("g")))))
    return each.unionByName(gone.select(F.explode(rows).alias("x")).select("x.metric", "x.value", F.lit("all").alias("filter")))


def retained(raw: DataFrame, assigned: DataFrame) -> DataFrame:
    """sample, raw_reads (0 if missing), assigned_reads, retained_pct (NA as null without raw reads)."""
    rows = assigned.join(raw, "sample", "left").select("sample", F.coalesce("raw_reads", F.lit(0)).cast("double").alias("raw_reads"), "assigned_reads")
    return rows.withColumn("retained_pct", F.when(F.col("raw_reads") > 0, F.col("assigned_reads") / F.col("raw_reads") * 100))


def sequence_stats(lengths: DataFrame) -> DataFrame:
    """By sample over (sample, len): number, sum, smallest, mean, largest, quartiles and N50 (the longest length at which sequences of at least that length make up half of all bases)."""
    base = lengths.groupBy("sample").agg(F.count("*").alias("num_seqs"), F.sum("len").alias("sum_len"), F.min("len").alias("min_len"), F.round(F.avg("len"), 4).alias("avg_len"), F.max("len").alias("max_len"), *(F.percentile("len", F.lit(q)).alias(f"q{k}") for k, q in ((1, 0.25), (2, 0.5), (3, 0.75))))
    # Lengths first: the window runs over different lengths, not over reads.
    hist = lengths.groupBy("sample", "len").agg((F.count("*") * F.col("len")).alias("bases"))
    upto = F.sum("bases").over(Window.partitionBy("sample").orderBy(F.desc("len")))
    n50 = hist.withColumn("upto", upto).withColumn("all", F.sum("bases").over(Window.partitionBy("sample"))).filter("2 * upto >= `all`").groupBy("sample").agg(F.max("len").alias("n50"))
    return base.join(n50, "sample")


def quality_shares(reads: DataFrame) -> DataFrame:
    """By sample over (sample, qual): percent of bases with a quality of at least 20 and 30 (offset 33), and the mean quality's error as -10 log10; null without bases."""
    n = F.length("qual")
    at_least = lambda q: F.length(F.regexp_replace("qual", f"[^{chr(33 + q)}-~]", ""))
    error = F.aggregate(F.split("qual", ""), F.lit(0.0), lambda a, c: a + F.when(c != "", F.pow(F.lit(10.0), -(F.ascii(c) - 33) / 10)).otherwise(0.0))
    sums = reads.filter("qual is not null").groupBy("sample").agg(F.sum(n).alias("n"), F.sum(at_least(20)).alias("q20"), F.sum(at_least(30)).alias("q30"), F.sum(error).alias("e"))
    pct = lambda c: F.round(F.when(F.col("n") > 0, F.col(c) / F.col("n") * 100), 2)
    return sums.select("sample", pct("q20").alias("q20_pct"), pct("q30").alias("q30_pct"), F.round(F.when(F.col("n") > 0, -10 * F.log10(F.col("e") / F.col("n"))), 2).alias("avg_qual"))


def frequencies(lengths: DataFrame) -> DataFrame:
    return lengths.groupBy("sample", "len").agg(F.count("*").alias("freq"))


def histogram(lengths: DataFrame, width: int = 200, method: str = "median") -> DataFrame:
    """sample, bin start, density: the sum, mean or median of the frequencies of a bin's lengths, over the sample's total."""
    value = {"sum": F.sum("freq").cast("double"), "mean": F.avg("freq"), "median": F.percentile("freq", F.lit(0.5))}[method]
    bins = frequencies(lengths).groupBy("sample", (F.floor(F.col("len") / width) * width).alias("bin")).agg(value.alias("v"))
    return bins.select("sample", "bin", (F.col("v") / F.sum("v").over(Window.partitionBy("sample"))).alias("density"))


def sliding_histogram(lengths: DataFrame, width: int = 200, step: int = 10, method: str = "median") -> DataFrame:
    """sample, mid, density over windows [s, s + width), s from the smallest length in steps up to the largest less ``width``.

    Each length goes to the windows that hold it (width / step of them), so windows meet lengths by an equi-join.
    Empty windows are 0.
    """
    freq = frequencies(lengths)
    ends = freq.groupBy("sample").agg(F.min("len").alias("lo"), F.max("len").alias("hi"))
    windows = ends.filter(F.col("hi") - width >= F.col("lo")).select("sample", "lo", F.explode(F.sequence(F.lit(0), F.floor((F.col("hi") - width - F.col("lo")) / step))).alias("k"))
    placed = freq.join(ends.select("sample", "lo"), "sample")
    off = F.col("len") - F.col("lo")
    first = F.greatest(F.floor((off - width) / step) + 1, F.lit(0))
    placed = placed.select("sample", "freq", F.explode(F.sequence(first, F.floor(off / step))).alias("k"))
    value = {"sum": F.sum("freq").cast("double"), "mean": F.avg("freq"), "median": F.percentile("freq", F.lit(0.5))}[method]
    got = placed.groupBy("sample", "k").agg(value.alias("v"))
    rows = windows.join(got, ["sample", "k"], "left").withColumn("v", F.coalesce("v", F.lit(0.0)))
    total = F.sum("v").over(Window.partitionBy("sample"))
    return rows.select("sample", (F.col("lo") + F.col("k") * step + F.lit(width / 2)).alias("mid"), F.when(total > 0, F.col("v") / total).otherwise(F.lit(0.0)).alias("density"))


def grouped_lengths(freq: DataFrame, groups: DataFrame) -> DataFrame:
    """(group, len, freq) by a map (sample, grp); samples without a group are Unmapped."""
    return freq.join(groups, "sample", "left").groupBy(F.coalesce("grp", F.lit("Unmapped")).alias("grp"), "len").agg(F.sum("freq").alias("freq"))


NOVEL = ("antisense", "divergent", "intergenic", "intronic", "ncRNA_host_gene", "overlapping")


def novel_gene_rescue(present: DataFrame, unfiltered: DataFrame, status: DataFrame, hard_failures: DataFrame) -> DataFrame:
    """tx of ``present`` and of unfiltered isoforms that share an exon boundary with a present novel-gene isoform and fail no hard screen.

    present, hard_failures: tx; unfiltered: exon rows (tx, chrom, strand, start0, end0); status (tx, status).
    """
    keys = F.explode(F.array(F.struct(F.lit("s").alias("side"), F.col("start0").alias("at")), F.struct(F.lit("e").alias("side"), F.col("end0").alias("at"))))
    bounds = unfiltered.select("tx", "chrom", "strand", keys.alias("k"))
    novel = status.filter(F.col("status").isin(*NOVEL)).join(present, "tx", "left_semi").select("tx")
    known = bounds.join(novel, "tx", "left_semi").select("chrom", "strand", "k").distinct()
    extra = bounds.join(known, ["chrom", "strand", "k"], "left_semi").select("tx").distinct()
    extra = extra.join(present, "tx", "left_anti").join(hard_failures, "tx", "left_anti")
    return present.select("tx").union(extra).distinct()
