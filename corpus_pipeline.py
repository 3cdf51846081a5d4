"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  Stages are cut by a written table:
the next one reads what the last one kept.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftgate.llm import line_crf
from driftgate.llm.jaccard_join import jaccard_components
from driftgate.llm.mixing import mix, ordered
from driftgate.llm.packing import pack
from driftgate.llm.store import stash
from driftgate.llm.substring_dedup import remove_repeats

MIN_SCORE = 0.3
TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier, trained on the labelled ones, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return line_crf.keep(docs, line_crf.train(docs, labels, F.lit(True)), MIN_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of near copies (five words, similarity 0.8).

    Rows that repeat an id with the same text are one document (of their other columns the smallest stay);
    other texts under the same id stay beside it, and so do rows without an id.
    """
    groups = jaccard_components(docs, k=5, threshold="0.8")
    kept = groups.where("component_id = doc_id").select("doc_id").distinct()
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    named = docs.join(kept, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(*rest)).alias("_rest"))
    return named.select(*[F.col(f"_rest.{c}").alias(c) if c in rest else F.col(c) for c in docs.columns]).union(docs.where(F.col("doc_id").isNull()))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; documents left without a word go, unless they had none."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    cut = remove_repeats(docs, keep=rest).where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    if "n_chars" in rest:
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per copy the mix takes, in training order: the numbers of the files it is written to, and the rows in each, follow the positions."""
    return ordered(mix(docs)).select(*docs.columns)


def written_order(docs: DataFrame) -> list[Column]:
    """The order in which a table's rows were written: its scan deals files out by size.  Empty for a table that no files carry, which is read as it is dealt."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        return []
    name = F.col("_metadata.file_name")
    return [F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long"), name, F.col("_metadata.row_index")]


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens, whose ids grow in training order."""
    return pack(docs, public_tokenizers.path(TOKENIZER), order=written_order(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: a trained classifier and a tokenizer: SQL cannot express them; the tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs, _ = stash(docs)
    return docs
