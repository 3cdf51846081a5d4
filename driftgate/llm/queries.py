"""One query per operator of this subpackage, over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftgate.llm import language_id, line_crf
from driftgate.llm.jaccard_join import jaccard_components
from driftgate.llm.lexical_search import search
from driftgate.llm.line_frequency import line_rules
from driftgate.llm.mixing import mix
from driftgate.llm.notice_search import scan_notices
from driftgate.llm.packing import pack
from driftgate.llm.pivot_codes import coded
from driftgate.llm.quote_linking import link_quotes
from driftgate.llm.substring_dedup import remove_repeats
from driftgate.llm.twins import TWIN_OP12, TWIN_OP13
from driftgate.llm.url_templates import judge
from driftgate.llm.vector_search import nearest

PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _fold(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op1_output_codes(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    model = language_id.train(docs, F.col("doc_id").isNotNull() & (_fold(3) != 1))
    out = language_id.predict(docs, model)
    return out.select("doc_id", F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")


def op2_path_templates(spark: SparkSession, sf: str) -> DataFrame:
    return judge(_table(spark, sf, "pages"), RULES)


def op3_line_frequency(spark: SparkSession, sf: str) -> DataFrame:
    out = line_rules(_table(spark, sf, "documents"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & F.col("kept"))
    return out.withColumn("kept_sha256", F.sha2(F.col("text").cast("binary"), 256)).drop("text")


def op4_curriculum_mix(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mix(_table(spark, sf, "documents").select("doc_id", "source", "text"))
    out = mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "positions")
    # in training order by first use; rows never used come last, spread by their ids
    order = [F.get("positions", F.lit(0)).asc_nulls_last(), F.xxhash64("doc_id").asc()]
    return out.repartitionByRange(*order).sortWithinPartitions(*order)


def _ids_crc32(batches):
    """CRC-32 of each piece's ids as little-endian unsigned 32-bit numbers, in place of the ids."""
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("ids"))
        cut, flat = np.asarray(ids.offsets), np.asarray(ids.values).astype("<u4")
        crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        rest = batch.drop_columns(["ids"])
        yield rest.append_column("ids_crc32", pa.array(crc, pa.int64()))


def op5_online_packing(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    pieces = pack(_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    rest = pieces.drop("ids").schema.simpleString()[len("struct<") : -1].replace(":", " ")
    return pieces.select(*pieces.drop("ids").columns, "ids").mapInArrow(_ids_crc32, f"{rest}, ids_crc32 long")


def op6_line_crf(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = _table(spark, sf, "documents"), _table(spark, sf, "labels")
    model = line_crf.train(docs, labels, _fold(5) != 0)
    out = line_crf.score(docs, model)
    good = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return out.select("doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "score", good)


def op7_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_components(_table(spark, sf, "documents"), k=3, threshold="0.9")


def op8_dimension_scan(spark: SparkSession, sf: str) -> DataFrame:
    return nearest(_table(spark, sf, "embeddings"), F.col("id") % 50 == 0, k=5)


def op9_quote_linking(spark: SparkSession, sf: str) -> DataFrame:
    return link_quotes(_table(spark, sf, "conversations"))


def op10_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = remove_repeats(_table(spark, sf, "documents"), words_only=True)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"), F.size("factors").cast("long").alias("n_factors"))


def op11_notice_search(spark: SparkSession, sf: str) -> DataFrame:
    return scan_notices(_table(spark, sf, "documents"), PHRASES)


def op12_pivot_codes(spark: SparkSession, sf: str) -> DataFrame:
    return coded(_table(spark, sf, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return search(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"), k=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_output_codes": op1_output_codes,
    "op2_path_templates": op2_path_templates,
    "op3_line_frequency": op3_line_frequency,
    "op4_curriculum_mix": op4_curriculum_mix,
    "op5_online_packing": op5_online_packing,
    "op6_line_crf": op6_line_crf,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_dimension_scan": op8_dimension_scan,
    "op9_quote_linking": op9_quote_linking,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_notice_search": op11_notice_search,
    "op12_pivot_codes": op12_pivot_codes,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE: dict[str, str] = {
    "op12_pivot_codes": TWIN_OP12,
    "op13_lexical_search": TWIN_OP13,
}
