"""GTF and GFF text as DataFrames. Coordinates become 0-based half-open on the way in."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _rows(spark: SparkSession, path: str | list[str], ordered: bool = False) -> DataFrame:
    """Nine tab columns of every line that has them and isn't a comment; gz files are opened by their suffix.

    ordered: also ``line``, which grows in order of appearance: by place in the list of paths, file name, and place in
    the file (a split's first byte, then the order in which its task reads it), however Spark packs the files.
    """
    c = F.split("value", "\t")
    names = ("chrom", "source", "feature", "start", "end", "score", "strand", "frame", "attributes")
    columns = [F.get(c, F.lit(i)).alias(n) for i, n in enumerate(names)]
    if not ordered:
        lines = spark.read.text(path)
    else:
        at = lambda i: F.struct(F.lit(i).alias("path"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id")).alias("line")
        each = [spark.read.text(p).select("value", at(i)) for i, p in enumerate([path] if isinstance(path, str) else path)]
        lines, columns = reduce(DataFrame.unionAll, each), [*columns, F.col("line")]
    return lines.filter(~F.startswith("value", F.lit("#"))).filter(F.size(c) >= 9).select(*columns)


#: What stands between a key and its value; a value begins with no white space.
_GAP = r"(?:\s*=\s*|\s+(?!=))"


def _unquoted(value: Column) -> Column:
    return F.translate(F.trim(value), '"', "")


def _pairs(attributes: Column) -> Column:
    """Array of (key, value): ``key value`` or ``key=value``, quotes dropped; items without a value are passed over."""
    items = F.transform(F.split(attributes, ";"), lambda x: F.trim(x))
    pair = lambda x: F.struct(F.regexp_extract(x, r"^([^\s=]+)", 1).alias("key"), _unquoted(F.regexp_extract(x, rf"^[^\s=]+{_GAP}(.*)$", 1)).alias("value"))
    return F.transform(F.filter(items, lambda x: F.regexp(x, F.lit(rf"^[^\s=]+{_GAP}\S"))), pair)


def attribute_map(attributes: Column) -> Column:
    """Map of the attributes; of a repeated key the last value stays."""
    last = lambda pairs, k: F.element_at(F.filter(pairs, lambda p: p["key"] == k), -1)["value"]
    made = lambda pairs: F.transform(F.array_distinct(F.transform(pairs, lambda p: p["key"])), lambda k: F.struct(k.alias("key"), last(pairs, k).alias("value")))
    # The pairs are a lambda's argument: made once, and not again for each key.
    return F.map_from_entries(F.get(F.transform(F.array(_pairs(attributes)), made), F.lit(0)))


def attribute(attributes: Column, name: str) -> Column:
    """One attribute's last value, as ``attribute_map`` has it, by one match instead of a map of all; null without."""
    found = F.regexp_extract(attributes, rf"(?s)^(?:.*;)? *{re.escape(name)}{_GAP}([^;\s][^;]*)", 1)
    return F.when(found != "", _unquoted(found))


def attribute_values(attributes: Column, name: str) -> Column:
    """All values of an attribute, in order."""
    return F.transform(F.regexp_extract_all(attributes, F.lit(rf"(?:^|;) *{re.escape(name)}{_GAP}([^;\s][^;]*)"), F.lit(1)), _unquoted)


def read_gtf(spark: SparkSession, path: str | list[str], ordered: bool = False, names: tuple[str, ...] = ()) -> DataFrame:
    """Every feature: chrom, source, feature, start0, end0, score, strand, frame, attrs (map), tags (array of all ``tag`` values), line if ``ordered``, and the attributes ``names`` as columns at__name, which cost less than the map."""
    rows = _rows(spark, path, ordered)
    tags = attribute_values(F.col("attributes"), "tag")
    return rows.select("chrom", "source", "feature", (F.col("start").cast("bigint") - 1).alias("start0"), F.col("end").cast("bigint").alias("end0"), "score", "strand", "frame", attribute_map(F.col("attributes")).alias("attrs"), tags.alias("tags"), *(["line"] if ordered else []), *(attribute(F.col("attributes"), n).alias(f"at__{n}") for n in names))


def read_hierarchy(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Exon rows of an annotation: gene, tx, gene_name, transcript_name, gene_type, transcript_type, exon_id, exon (number), chrom, strand, start0, end0, tags.

    ``_biotype`` stands for ``_type``; names default to ids; an exon without a number gets its place among the exons of
    its transcript, in order of appearance. Rows without a gene or transcript id are skipped.
    """
    at = lambda *names: F.coalesce(*(F.col(f"at__{n}") for n in names))
    kinds = [f"{of}_{name}" for of in ("gene", "transcript") for name in ("id", "name", "type", "biotype")]
    rows = read_gtf(spark, path, ordered=True, names=(*kinds, "exon_id", "exon_number")).filter("feature = 'exon'").withColumns({"gene": at("gene_id"), "tx": at("transcript_id")}).filter("gene is not null and tx is not null")
    place = F.row_number().over(Window.partitionBy("gene", "tx").orderBy("line"))
    number = F.coalesce(at("exon_number").try_cast("int"), place).alias("exon")
    return rows.select("gene", "tx", F.coalesce(at("gene_name"), "gene").alias("gene_name"), F.coalesce(at("transcript_name"), "tx").alias("transcript_name"), at("gene_type", "gene_biotype").alias("gene_type"), at("transcript_type", "transcript_biotype").alias("transcript_type"), at("exon_id").alias("exon_id"), number, "chrom", "strand", "start0", "end0", "tags")


def depth_of(attrs: Column, name: str = "depth") -> Column:
    """The number in a feature's depth attribute; null without one."""
    return F.try_element_at(attrs, F.lit(name)).try_cast("bigint")


def read_exons(spark: SparkSession, path: str | list[str], on_mixed: str = "drop", keep_empty_ids: bool = True) -> DataFrame:
    """Exon rows: tx, gene, chrom, strand, start0, end0, ord (order of the transcript's first line), transcript_type, tags.

    Rows without transcript or gene id are skipped (empty ones too, unless keep_empty_ids). A transcript on several
    chromosomes or strands is dropped (``drop``) or takes those of its first line (``first``).
    """
    rows = read_gtf(spark, path, ordered=True, names=("transcript_id", "gene_id", "transcript_type", "transcript_biotype")).filter("feature = 'exon'")
    at = lambda k: F.col(f"at__{k}")
    kind = F.coalesce(at("transcript_type"), at("transcript_biotype"))
    rows = rows.select(at("transcript_id").alias("tx"), at("gene_id").alias("gene"), "chrom", "strand", "start0", "end0", "line", kind.alias("transcript_type"), "tags").filter("tx is not null and gene is not null")
    if not keep_empty_ids:
        rows = rows.filter("tx <> '' and gene <> ''")
    place = F.struct("chrom", "strand")
    head = rows.groupBy("tx").agg(F.min(F.struct("line", "chrom", "strand")).alias("h"), F.min(place).alias("least"), F.max(place).alias("most"))
    if on_mixed == "drop":
        head = head.filter("least = most")
    elif on_mixed != "first":
        raise ValueError("on_mixed: drop or first")
    rows = rows.select("tx", "gene", "start0", "end0", "transcript_type", "tags").join(head.select("tx", "h"), "tx")
    return rows.select("tx", "gene", F.col("h.chrom").alias("chrom"), F.col("h.strand").alias("strand"), "start0", "end0", F.col("h.line").alias("ord"), "transcript_type", "tags")


def to_gtf_lines(exons: DataFrame, source: str = "strandloom") -> DataFrame:
    """One text column: exon lines, 1-based closed, by chromosome and position."""
    attrs = F.concat(F.lit('gene_id "'), F.col("gene").cast("string"), F.lit('"; transcript_id "'), F.col("tx").cast("string"), F.lit('";'))
    line = F.concat_ws("\t", "chrom", F.lit(source), F.lit("exon"), (F.col("start0") + 1).cast("string"), F.col("end0").cast("string"), F.lit("."), "strand", F.lit("."), attrs)
    return exons.orderBy("chrom", "start0", "tx").select(line.alias("value"))


def read_exon_intron_gff(spark: SparkSession, path: str) -> DataFrame:
    """tx, kind (ex or in), ord, cnt, chrom, start0, end0 of numbered rows ``ID.exN:COUNT`` and ``ID.inN:COUNT``; others are skipped."""
    name = r"^(\S+)\.(ex|in)(\d+):(\d+)$"
    rows = _rows(spark, path).filter(F.col("attributes").rlike(name))
    part = lambda i: F.regexp_extract("attributes", name, i)
    return rows.select(part(1).alias("tx"), part(2).alias("kind"), part(3).cast("int").alias("ord"), part(4).cast("int").alias("cnt"), "chrom", (F.col("start").cast("bigint") - 1).alias("start0"), F.col("end").cast("bigint").alias("end0"))


def read_gene_regions(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start0, end0, n_exons: gene regions whose score is the number of exons of the gene's model."""
    return _rows(spark, path).select("chrom", (F.col("start").cast("bigint") - 1).alias("start0"), F.col("end").cast("bigint").alias("end0"), F.expr("try_cast(score as int)").alias("n_exons"))
