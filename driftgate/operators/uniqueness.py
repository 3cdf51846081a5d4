"""Uniqueness across batches: which keys of a batch a table already holds.

A batch is small, the table is not.  The batch's keys go into a Bloom filter of
a fixed number of bits, so what is broadcast has a bound whatever the batch; the
table's keys are tested against it where they are scanned, and only those that
may match are shuffled to meet the batch's keys.  The final join is exact: a
full filter costs time, never a wrong answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 27  # 16 MB of filter
_WORDS = 64  # 64-bit words to a block


def _places(key: str, bits: int) -> list:
    """Two bits of a key: block, word and bit of each."""
    out = []
    for seed in (0, 1):
        at = F.pmod(F.xxhash64(F.lit(seed), F.col(key).cast("string")), F.lit(bits))
        out.append((F.shiftright(at, 12).cast("int"), (F.shiftright(at, 6) % _WORDS).cast("int"), (at % 64).cast("int")))
    return out


def key_filter(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """``(block, words)``: the Bloom filter of the keys, at most ``bits / 4096`` rows of 64 numbers."""
    cells = F.array(*[F.struct(b.alias("block"), w.alias("word"), i.alias("bit")) for b, w, i in _places(key, bits)])
    words = keys.select(F.inline(cells)).groupBy("block", "word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))).alias("value"))
    by_word = words.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("word", "value"))).alias("m"))
    return by_word.select("block", F.transform(F.sequence(F.lit(0), F.lit(_WORDS - 1)), lambda w: F.coalesce(F.col("m")[w], F.lit(0).cast("bigint"))).alias("words"))


def may_hold(table: DataFrame, key: str, blocks: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows of ``table`` whose key passes the filter; no row moves, as the filter is bounded by ``bits``."""
    out = table
    for n, (block, word, bit) in enumerate(_places(key, bits)):
        side = blocks.select(F.col("block").alias(f"_b{n}"), F.col("words").alias(f"_w{n}"))
        out = out.withColumns({f"_at{n}": block, f"_word{n}": word, f"_bit{n}": bit}).join(F.broadcast(side), F.col(f"_at{n}") == F.col(f"_b{n}"))
        out = out.where(F.bit_get(F.element_at(f"_w{n}", F.col(f"_word{n}") + 1), F.col(f"_bit{n}")) == 1)
    return out.select(*table.columns)


def held_keys(batch: DataFrame, table: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """``(key)``: the batch's keys that the table holds, each once.  NULL is no key."""
    keys = batch.select(key).where(F.col(key).isNotNull()).distinct()
    near = may_hold(table.select(key).where(F.col(key).isNotNull()), key, key_filter(keys, key, bits), bits)
    return keys.join(near, key, "left_semi")


def with_held(batch: DataFrame, table: DataFrame, key: str, flag: str, bits: int = BITS) -> DataFrame:
    """The batch with a Boolean column: whether the table already holds the row's key."""
    held = held_keys(batch, table, key, bits).select(F.col(key).alias("_held"))
    return batch.join(held, F.col(key) == F.col("_held"), "left").withColumn(flag, F.col("_held").isNotNull()).drop("_held")
