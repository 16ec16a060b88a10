"""A training-data pipeline over ``documents``: quality, near-duplicates, personal data, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. A
stage's result is written as Parquet and reread as the next one's docs.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom import lineage
from strandloom.llm import bpe, mixing, neardup, pii, quality
from strandloom.llm.common import cut, numbered, table
from strandloom.llm.queries import VOCABULARY
from strandloom.operators.numbering import number_by_range

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Similarity of the near-duplicate stage, in percent.
NEAR_PERCENT = 80
#: Ids of copies up to this many are broadcast; more are joined by shuffle.
BROADCAST_IDS = 1_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the quality classifier keeps, fitted on the labels of ``sf_dir``.

    Null, empty and blank texts are rejected; without labels all others stay. Null sources and languages are sites of
    their own. Texts are judged whole, however long; equal rows alike, none is lost. Columns beside those of documents
    are left out, whatever their names; an empty table gives no rows.
    """
    return quality.keep_good(docs.select(COLUMNS), quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that with the smallest id.

    Every row with a text of its own counts: where an id has several rows, or is null, equal texts of one id are one row
    (that with the smallest other columns, nulls first), and different texts are compared like any documents: when a
    group's smallest is sought, the first of them by a hash has the id's place, and the others come after all ids. Null
    and empty texts link with nothing. Texts are compared whole, however long. Columns beside those of documents are left out,
    whatever their names; an empty table gives no rows.
    """
    docs = docs.select(COLUMNS)
    shared = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null").select("doc_id")
    shared = cut(shared, "shared-ids")
    rows = docs.withColumn("node", F.col("doc_id"))
    if not shared.isEmpty():
        same = F.col("doc_id").eqNullSafe(F.col("s"))
        by = shared.select(F.col("doc_id").alias("s"))
        rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
        several = docs.join(by, same, "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(*rest)).alias("rest"))
        several = numbered(cut(several, "shared-id-rows"), F.struct("doc_id", "text"), [F.col("doc_id"), F.col("text")], "number")
        last = docs.agg(F.max("doc_id").alias("m")).first()["m"] or 0
        several = cut(several.select("doc_id", "text", "rest.*", "number"), "numbered-rows")
        head = several.groupBy(F.col("doc_id").alias("h")).agg(F.min("number").alias("least")).filter("h is not null")
        several = several.join(head, (F.col("doc_id") == F.col("h")) & (F.col("number") == F.col("least")), "left")
        # Rows without a place of their own come after all ids: numbered on from the last, or, where numbers end before
        # that, all rows by their rank.
        extra = F.col("h").isNull()
        rows = rows.join(by, same, "left_anti").select(*COLUMNS, F.col("doc_id").alias("place"), F.lit(None).cast("bigint").alias("after"))
        rows = rows.unionByName(several.select(*COLUMNS, F.when(~extra, F.col("doc_id")).alias("place"), F.when(extra, F.col("number")).alias("after")))
        if last < (1 << 63) - 1 - several.count():
            rows = rows.withColumn("node", F.coalesce("place", F.col("after") + F.lit(last + 1)))
        else:
            rows = cut(rows, "unnumbered")
            ordered = number_by_range(rows.select("place", "after").withColumn("late", F.col("place").isNull()), ["late"], F.shiftright(F.coalesce("place", "after"), 32), ["place", "after"], "rank")
            n = rows.filter("place is not null").count()
            ranks = ordered.select(F.col("place").alias("p"), F.col("after").alias("a"), (F.col("rank") + F.when(F.col("late"), F.lit(n)).otherwise(0)).alias("node"))
            rows = rows.join(ranks, F.col("place").eqNullSafe(F.col("p")) & F.col("after").eqNullSafe(F.col("a")))
        rows = rows.select(*COLUMNS, "node")
    found = neardup.near_duplicates(rows.select(F.col("node").alias("doc_id"), "text"), NEAR_PERCENT)
    gone = cut(found.filter("not kept").select(F.col("doc_id").alias("node")).distinct(), "copies")
    few = gone.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(gone) if few else gone, "node", "left_anti").select(COLUMNS)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, the personal data of their texts replaced by its kind; n_chars follows the text.

    Null texts stay null (and have a null n_chars), empty ones empty. Texts are searched whole, however long; equal rows
    are treated alike and stay repeated. Columns beside those of documents are left out, whatever their names; an empty
    table gives no rows.
    """
    return pii.redact(docs.select(COLUMNS)).withColumn("n_chars", F.length("text").cast("bigint"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in the order of the mix of their sources.

    Null sources are one source; null and repeated ids are rows like others; equal rows stay repeated and lie together.
    Texts play no part. Columns beside those of documents are left out, whatever their names; an empty table gives no rows.
    """
    return mixing.mixed(docs.select(COLUMNS))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's ids, as packed integers, with their number and the digest of the text decoded from them, and its place in the mix.

    mix_part and mix_row: the number of the file that the mixing stage wrote the row to, and the row's in it. However
    readers pack the files, (mix_part, mix_row) is the order of the mix. Rows that come from no file have nulls there.
    Null texts count as empty: no ids. Texts are encoded whole, however long; equal rows stay repeated. Columns beside
    doc_id, source and text are left out, whatever their names; an empty table gives no rows.
    """
    columns, none = ["doc_id", "source", "text"], F.lit(None).cast("bigint")
    try:
        part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).try_cast("bigint")
        placed = docs.select(*columns, part.alias("mix_part"), F.col("_metadata.row_index").cast("bigint").alias("mix_row"))
    except AnalysisException:  # not read from files
        placed = docs.select(*columns, none.alias("mix_part"), none.alias("mix_row"))
    out = bpe.encode_decode(placed, VOCABULARY)
    return out.select("doc_id", "source", "mix_part", "mix_row", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("PII", personal_data_stage),
    ("mixing sources", mixing_stage),
    ("BPE encoding", token_stage),
]

#: SQL can't express the trained, sketched and scheduled stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written to the shared folder and reread; what a stage wrote on its way goes then."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        point = lineage.mark()
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        lineage.forget_since(point, keep=(docs,))  # what the stage wrote on its way
    return STAGES[-1][1](spark, docs, sf_dir)
