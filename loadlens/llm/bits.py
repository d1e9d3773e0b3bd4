"""A table of bits of bounded size, by which most rows of a large table are told apart from the few that a join is needed for."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.scratch import free_name, stored

LEAST, MOST = 15, 26
#: Bits per row, as long as the table stays below its bound.
PER_ROW = 16


@dataclass
class BitTable:
    """Rows (bucket, bits) of 32,768 bits each, at most 2**MOST bits (8 MB) in all."""

    rows: DataFrame
    size: int


def _place(hashed: Column, size: int) -> Column:
    """Spark's bit positions count from 1: bucket b holds the places (b - 1) * 32,768 + 1 and up."""
    return F.pmod(hashed, F.lit(size)) + 1


def bit_table(rows: DataFrame, hashed: Column, most: int = MOST) -> BitTable:
    """A bit for each value of ``hashed`` (a 64-bit hash), modulo the number of bits: a power of two that grows with the rows
    up to 2**most. A full table tells nothing apart, and loses nothing."""
    size = 1 << min(most, max(LEAST, (PER_ROW * rows.count()).bit_length()))
    places = rows.select(_place(hashed, size).alias("place")).distinct()
    made = places.groupBy(F.expr("bitmap_bucket_number(place)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits"))
    return BitTable(stored(made, "bits"), size)


def may_hold(docs: DataFrame, table: BitTable, hashed: Column) -> tuple[DataFrame, str]:
    """``docs`` with one more column, and its name: false where the hash is in none of the rows the table was made of; where
    it is true, a join must tell. The table goes to every task, its size being bounded."""
    place, bucket, bits, out = (free_name(docs, name) for name in ("_place", "_bucket", "_bits", "_may"))
    rows = F.broadcast(table.rows.select(F.col("bucket").alias(bucket), F.col("bits").alias(bits)))
    placed = docs.withColumn(place, _place(hashed, table.size))
    joined = placed.join(rows, F.expr(f"bitmap_bucket_number(`{place}`)") == F.col(bucket), "left")
    at = F.expr(f"bitmap_bit_position(`{place}`)")
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.pmod(F.floor(byte / F.pow(F.lit(2.0), F.pmod(at, F.lit(8)))), F.lit(2))
    return joined.withColumn(out, F.coalesce(bit == 1, F.lit(False))).drop(place, bucket, bits), out
