"""A filter of fixed size that passes all rows with a kept value and few others.

Each value sets a bit of a bitmap of `BITS` bits, which is small enough to be sent to every
task whatever the number of values. Rows whose bit is not set need not be shuffled to find
that they meet nothing. It only saves work: what passes is still to be joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import keep

BITS = 1 << 25  # 4 MB
WORDS = 512  # of 64 bits in each bitmap of 32,768 bits that Spark makes


def _place(columns: list[str]) -> Column:
    return F.pmod(F.xxhash64(F.lit("sieve"), *columns), F.lit(BITS)) + 1


def sifted(df: DataFrame, kept: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of `df` that may have an equal in `kept` by the columns, which are not null."""
    place = _place(columns)
    bits = kept.select(F.bitmap_bucket_number(place).alias("_bucket"), F.bitmap_bit_position(place).alias("_at"))
    bits = bits.groupBy("_bucket").agg(F.bitmap_construct_agg("_at").alias("_bits"))
    # numbers in place of bytes, which Spark can test a bit of without a detour by text
    word = F.transform(
        F.sequence(F.lit(1), F.lit(8 * WORDS), F.lit(8)),
        lambda at: F.conv(F.hex(F.substring("_bits", at, F.lit(8))), 16, -10).cast("long"),
    )
    bits = keep(bits.select("_bucket", word.alias("_words")), "sieve")
    marked = df.withColumn("_bucket", F.bitmap_bucket_number(place)).withColumn("_at", F.bitmap_bit_position(place))
    # at most BITS / 8 bytes in rows of 4096
    met = marked.join(F.broadcast(bits), "_bucket")
    # bits count from the lowest of each byte, bytes from the highest of each word
    turn = F.expr("CAST((_at & 63) ^ 56 AS INT)")
    bit = F.call_function("shiftright", F.get("_words", F.shiftright("_at", 6).cast("int")), turn).bitwiseAND(1)
    return met.filter(bit == 1).select(*df.columns)
