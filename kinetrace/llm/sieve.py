"""A bounded bit table that tells most rows apart before a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of the table, 64 bits each: at most 4 MB, however many ids there are. Over some ten million ids it
#: lets most rows through, and the exact join after it does the work alone.
WORDS = 1 << 18


def _key(c: Column) -> Column:
    """One type for the hash: an id may be an integer on one side and a long on the other."""
    return c.cast("string")


def bit_table(ids: DataFrame, column: str) -> DataFrame:
    """A bit for each id's hash, as rows (word, bits); its size has a fixed bound, so it may be broadcast."""
    h = F.xxhash64(_key(F.col(column)))
    bit = F.expr("shiftleft(1L, cast(shiftright(h, 20) & 63 as int))")
    return ids.where(F.col(column).isNotNull()).select(h.alias("h")).select(F.pmod("h", F.lit(WORDS)).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def split(df: DataFrame, table: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be among the table's ids, and rows whose key surely is not (null keys are among these)."""
    h = F.xxhash64(_key(key))
    names = df.columns
    marked = df.withColumns({"_sieve_word": F.when(key.isNotNull(), F.pmod(h, F.lit(WORDS))), "_sieve_bit": F.shiftright(h, 20).bitwiseAND(F.lit(63))})
    named = table.select(F.col("word").alias("_sieve_of"), F.col("bits").alias("_sieve_bits"))
    met = marked.join(F.broadcast(named), F.col("_sieve_word") == F.col("_sieve_of"), "left")
    maybe = F.coalesce(F.expr("shiftright(_sieve_bits, cast(_sieve_bit as int)) & 1L") == 1, F.lit(False))
    return met.where(maybe).select(*[F.col(f"`{c}`") for c in names]), met.where(~maybe).select(*[F.col(f"`{c}`") for c in names])
