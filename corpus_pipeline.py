"""The corpus pipeline: from documents to packed token sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. Its result is
written to the shared folder and read again, so lineage ends between stages and a lost executor
costs no more than the stage it works on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtables.llm import langid, orderhash, packing, streamdedup, suffixes
from logtables.llm.shared import folder


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that language identification rejects: no letters, or like no language.

    Null and empty texts have no letters and go; repeated rows are judged one by one. An empty
    table stays empty.
    """
    return langid.keep_known(docs)


def _staying(docs: DataFrame, tag: Column, decided: DataFrame, by: str) -> DataFrame:
    """The rows whose id and text (by its tag) a result has as kept; of repeated rows, any one.

    Texts move once: the rows are dealt by id and tag, neither of them null, and both the join and
    the removal of repeats go by exactly these two.
    """
    mark, other = ("_" * max(map(len, docs.columns)) + x for x in ("tag", "key"))
    number = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(streamdedup.LEAST))
    stay = decided.where("kept").select(
        F.coalesce(F.col("doc_id"), F.lit(streamdedup.LEAST)).alias(other), F.col(by).alias(mark))
    tagged = docs.withColumns({mark: tag, other: number})
    return tagged.join(stay.distinct(), [other, mark], "left_semi").dropDuplicates(
        [other, mark]).select(*map(quoted, docs.columns))


def quoted(name: str) -> str:
    """A column by its very name, whatever characters are in it."""
    return "`" + name.replace("`", "``") + "`"


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z folded), the document with the largest id stays.

    A null text is empty, a null id is the smallest; of repeated rows one stays. An empty table
    stays empty.
    """
    digest = F.lower(F.hex(streamdedup.sha256(streamdedup.folded("text"))))
    return _staying(docs, digest, streamdedup.duplicates(docs), "text_sha256")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, the document with the smallest id stays.

    Texts without words, null ones too, are one class; a null id is the smallest; of repeated rows
    one stays. An empty table stays empty.
    """
    tag = F.xxhash64(F.coalesce("text", F.lit("")))
    return _staying(docs, tag, orderhash.near_copies(docs), "text_hash")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes and more that a document with a smaller id has too are cut out.

    Where a text changes, `n_chars` follows it. No row goes: null texts and rows without an id
    stay as they are, and a text of which nothing is left is empty.
    """
    cut = suffixes.without_repeats(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.length("text").cast(kind))
    return cut.select(*map(quoted, docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 2048 tokens; a null or empty text is one
    piece. An empty table gives no rows."""
    return packing.pack(docs)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", exact_duplicates),
    ("minhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("best_fit_packing", packed),
]

#: No stage but the exact dedup can be said in SQL; tests hold the whole against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of `sf_dir`. Extra columns go along up to the last stage,
    whatever their names; an empty table runs through all stages and gives no rows."""
    place = folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{place}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
