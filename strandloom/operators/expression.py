"""Expression in long form (tx, sample, value): fractions, filters, protection, cascade, rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.functions.coords import safe_fraction
from strandloom.lineage import cut

GROUP = ("gene", "chrom", "strand")


def samples_of(expr: DataFrame) -> list:
    """The matrix's sample columns, sorted; as many as a wide matrix has columns."""
    return sorted(r["sample"] for r in expr.select("sample").distinct().collect())


def dense(expr: DataFrame, keys: DataFrame, samples: list) -> DataFrame:
    """Every row of ``keys`` (tx, ...) with every sample; a missing value is 0."""
    grid = keys.withColumn("sample", F.explode(F.array(*map(F.lit, samples)).cast(f"array<{dict(expr.dtypes)['sample']}>")))
    return grid.join(expr.select("tx", "sample", "value"), ["tx", "sample"], "left").withColumn("value", F.coalesce(F.col("value").cast("double"), F.lit(0.0)))


def cpm(expr: DataFrame) -> DataFrame:
    """Adds cpm: a million times the value over its sample's total, 0 for an empty sample. Totals are one row a sample."""
    totals = expr.groupBy("sample").agg(F.sum("value").alias("total"))
    return expr.join(totals, "sample").select("tx", "sample", "value", F.when(F.col("total") > 0, F.lit(1e6) * F.col("value") / F.col("total")).otherwise(F.lit(0.0)).alias("cpm"))


def low_expression(expr: DataFrame, min_cpm: float = 0.5, min_samples: float = 3) -> DataFrame:
    """tx of rows that reach ``min_cpm`` in fewer than ``min_samples`` samples (an absolute number)."""
    return cpm(expr).groupBy("tx").agg(F.sum((F.col("cpm") >= min_cpm).cast("int")).alias("n")).filter(F.col("n") < min_samples).select("tx")


def _with_total(rows: DataFrame) -> DataFrame:
    """Adds the sum of value by group and sample; rows without a gene are one group.

    Sums are combined on the map side and written, so that Spark splits a hot group's rows in the join back; the rows
    without a gene, however many, get theirs from one number a sample.
    """
    keys = [*GROUP, "sample"]
    rows = cut(rows, "group-rows")  # read three times below
    sums = cut(rows.groupBy(*keys).agg(F.sum("value").alias("total")), "group-totals")
    known = rows.filter("gene is not null").join(sums, keys)
    bare = sums.filter("gene is null").select(*(F.col(k).alias(f"__{k}") for k in keys), "total")
    same = F.col("sample").eqNullSafe(F.col("__sample")) & F.col("chrom").eqNullSafe(F.col("__chrom")) & F.col("strand").eqNullSafe(F.col("__strand"))
    unknown = rows.filter("gene is null").join(bare, same).drop(*(f"__{k}" for k in keys))
    return known.unionByName(unknown)


def fractions(expr: DataFrame, tx: DataFrame) -> DataFrame:
    """Adds the group's total and the row's fraction of it, by sample."""
    rows = _with_total(expr.join(tx.select("tx", *GROUP), "tx", "left"))
    return rows.withColumn("fraction", safe_fraction(F.col("value").cast("double"), F.col("total")))


def protected(expr: DataFrame, tx: DataFrame, min_fraction: float = 0.1, min_samples: int = 2) -> DataFrame:
    """tx with at least ``min_fraction`` of their group in at least ``min_samples`` samples; unknown transcripts never."""
    rows = fractions(expr.join(tx.filter("gene is not null").select("tx"), "tx", "left_semi"), tx).filter(F.col("fraction") >= min_fraction)
    return rows.groupBy("tx").agg(F.count("*").alias("n")).filter(F.col("n") >= min_samples).select("tx")


def dominance(expr: DataFrame, tx: DataFrame, samples: list | None = None) -> DataFrame:
    """By group and sample: the largest fraction, and how many transcripts have at least 10, 5 and 1 % of it."""
    samples = samples_of(expr) if samples is None else samples
    known = expr.select("tx").distinct().join(tx.select("tx", *GROUP), "tx", "left")
    rows = _with_total(dense(expr, known, samples))
    rows = rows.withColumn("fraction", safe_fraction(F.col("value"), F.col("total")))
    return rows.groupBy(*GROUP, "sample").agg(F.max("fraction").alias("top_fraction"), *(F.sum((F.col("fraction") >= t / 100).cast("int")).alias(f"n_ge_{t}") for t in (10, 5, 1)))


def dominance_summary(profile: DataFrame) -> DataFrame:
    """By threshold over all groups and samples: mean, median, 90th and 95th percentile, and the share with 1, 2, 3 and 4 or more."""
    rows = profile.select(F.explode(F.array(*(F.struct(F.lit(t).alias("threshold_pct"), F.col(f"n_ge_{t}").alias("n")) for t in (10, 5, 1)))).alias("x")).select("x.*")
    share = lambda c: (F.avg(c.cast("double")) * 100)
    n = F.col("n")
    return rows.groupBy("threshold_pct").agg(
        F.avg("n").alias("mean_n"), F.percentile("n", F.lit(0.5)).alias("median_n"), F.percentile("n", F.lit(0.9)).alias("p90_n"), F.percentile("n", F.lit(0.95)).alias("p95_n"),
        share(n == 1).alias("pct_1"), share(n == 2).alias("pct_2"), share(n == 3).alias("pct_3"), share(n >= 4).alias("pct_ge4"),
    )


def cascade(expr: DataFrame, tx: DataFrame, edges: DataFrame, protect: DataFrame | None = None, proportional: bool = True, samples: list | None = None) -> DataFrame:
    """Moves the mass of contained transcripts to their supersets: (tx, sample, value) after all donations.

    tx has ord (position in the annotation) and chain. Within a group and sample, donors go one after another, by chain
    length and then ord; each gives all its current mass, in proportion to its supersets' current positive mass or else
    in equal shares. Protected donors don't give. Supersets that the matrix lacks are added by what they get.

    The order is a property of the semantics, so a group is one fold over its ordered donors, with an array of masses
    as state; groups are independent. Sizes are those of one gene.
    """
    samples = samples_of(expr) if samples is None else samples
    if protect is not None:
        edges = edges.join(protect.select(F.col("tx").alias("guard")), F.col("child") == F.col("guard"), "left_anti")
    nodes = edges.select(F.col("child").alias("tx")).union(edges.select(F.col("parent").alias("tx"))).distinct()
    known = tx.join(nodes, "tx", "left_semi").select("tx", *GROUP, "ord", F.size("chain").alias("len"))
    index = known.withColumn("i", (F.row_number().over(Window.partitionBy(*GROUP).orderBy("ord")) - 1))
    donors = edges.join(index.select(F.col("tx").alias("child"), "i", "len", "ord"), "child").join(index.select(F.col("tx").alias("parent"), F.col("i").alias("p")), "parent")
    donors = donors.groupBy(*GROUP, "child", "i", "len", "ord").agg(F.collect_set("p").alias("to"))
    plans = donors.groupBy(*GROUP).agg(F.array_sort(F.collect_list(F.struct("len", "ord", "i", "to"))).alias("donors"))
    mass = dense(expr, index, samples).groupBy(*GROUP, "sample").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "value"))), lambda x: x["value"]).alias("mass"))

    def donate(m: Column, d: Column) -> Column:
        amount = F.get(m, d["i"])
        total = F.aggregate(d["to"], F.lit(0.0), lambda acc, p: acc + F.greatest(F.get(m, p), F.lit(0.0)))
        share = (lambda v: F.when(total > 0, v / total).otherwise(F.lit(1.0) / F.size(d["to"]))) if proportional else (lambda v: F.lit(1.0) / F.size(d["to"]))
        moved = F.transform(m, lambda v, k: F.when(k == d["i"], F.lit(0.0)).when(F.array_contains(d["to"], k), v + amount * share(v)).otherwise(v))
        return F.when(amount > 0, moved).otherwise(m)

    after = mass.join(plans, list(GROUP)).select(*GROUP, "sample", F.aggregate("donors", F.col("mass"), donate).alias("mass"))
    after = after.select(*GROUP, "sample", F.posexplode("mass").alias("i", "new")).join(index.select(*GROUP, "i", "tx"), [*GROUP, "i"]).select("tx", "sample", F.col("new").alias("value"))
    present = expr.select("tx", "sample").distinct()
    got = after.join(present.withColumn("there", F.lit(True)), ["tx", "sample"], "left").filter("there or value <> 0").drop("there")
    rest = expr.join(index.select("tx"), "tx", "left_anti").select("tx", "sample", F.col("value").cast("double").alias("value"))
    return got.unionByName(rest)


def drop_contained(values: DataFrame, edges: DataFrame, protect: DataFrame | None = None) -> DataFrame:
    """``values`` without contained transcripts, but for protected ones."""
    gone = edges.select(F.col("child").alias("tx")).distinct()
    if protect is not None:
        gone = gone.join(protect.select("tx"), "tx", "left_anti")
    return values.join(gone, "tx", "left_anti")


#: Slices of the remainders of one sample when a rank among them is looked for.
SLICES = 1024


def round_preserve_sum(values: DataFrame, method: str = "nearest") -> DataFrame:
    """Integer values whose sum by sample is the rounded sum (half to even): floors (or ceilings), mended by largest remainders.

    nearest is floor; none returns the values. Negative values and NaN count as 0; ties go by tx. Only the rows of the
    slice of remainders in which the last mended row lies are ranked; of the other slices, counts tell.
    """
    if method == "none":
        return values
    x = F.when(F.isnan("value") | (F.col("value") < 0), F.lit(0.0)).otherwise(F.coalesce("value", F.lit(0.0)))
    rows = values.select("tx", "sample", "value", x.alias("x")).withColumn("base", (F.ceil("x") if method == "ceil" else F.floor("x")).cast("bigint"))
    diff = F.bround(F.sum(F.when(~F.isnan("value"), F.col("value")).otherwise(0.0)) - F.sum("base"), 0).cast("bigint")
    rows = rows.join(rows.groupBy("sample").agg(diff.alias("diff")), "sample")  # one row a sample
    rest = F.col("x") - F.col("base")
    rows = rows.withColumn("r", F.when(F.col("diff") >= 0, -rest).otherwise(rest)).withColumn("u", F.floor(F.col("r") * SLICES).cast("int"))
    upto = F.sum("n").over(Window.partitionBy("sample").orderBy("u"))
    slices = rows.groupBy("sample", "u").agg(F.count("*").alias("n")).withColumn("upto", upto)  # at most 2 * SLICES + 1 rows a sample
    rows = rows.join(slices, ["sample", "u"])
    need, before = F.abs("diff"), F.col("upto") - F.col("n")
    edge = (before < need) & (F.col("upto") > need)
    rank = F.row_number().over(Window.partitionBy("sample", "u").orderBy("r", "tx"))
    ranked = rows.filter(edge).withColumn("mend", rank + before <= need).unionByName(rows.filter(~edge).withColumn("mend", F.col("upto") <= need))
    value = F.when(~F.col("mend"), F.col("base")).when(F.col("diff") >= 0, F.col("base") + 1).otherwise(F.greatest(F.col("base") - 1, F.lit(0)))
    return ranked.select("tx", "sample", value.cast("bigint").alias("value"))
