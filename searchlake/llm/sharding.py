"""Sharding by jump consistent hashing (operator 2), in native columns.

The jump hash walks from bucket to bucket with a 64-bit linear congruential
generator and stops at the last bucket below the shard count, so appending a
shard moves only the keys that the new shard receives, and no ring table is
needed.  The generator's 64-bit product is taken in 32-bit halves, because
Spark's long arithmetic rejects overflow.

An integer key is used as it is, any other key by its xxhash64.  A null key
counts as 0.  Equal keys share a shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Multiplier of the published generator, in 32-bit and 16-bit parts.
_MULT = 2862933555777941757
_MH, _ML1, _ML0 = _MULT >> 32, (_MULT >> 16) & 0xFFFF, _MULT & 0xFFFF
_LOW32 = 0xFFFFFFFF

#: Groups inside a shard for numbering its rows; a group is one sort unit.
SLOT_GROUPS = 256


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """high:low * multiplier + 1, modulo 2**64, as unsigned 32-bit halves."""
    cross = low * _ML1
    sum_low = low * _ML0 + F.shiftleft(cross.bitwiseAND(0xFFFF), 16) + 1
    carry = F.shiftright(sum_low, 32) + F.shiftright(cross, 16)
    top = high * _ML0 + F.shiftleft((high * _ML1).bitwiseAND(0xFFFF), 16)
    return (carry + (low * _MH).bitwiseAND(_LOW32) + top).bitwiseAND(_LOW32), sum_low.bitwiseAND(_LOW32)


def _halves(key: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(key, 32), key.bitwiseAND(_LOW32)


def jump_hash(key: Column, shards: int) -> Column:
    """The shard (0 to ``shards`` - 1) of a long column."""
    high, low = _halves(key)
    start = F.struct(high.alias("h"), low.alias("l"), F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(s: Column, _: Column) -> Column:
        h, l = _next(s["h"], s["l"])
        jump = (s["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(h, 1) + 1).cast("double"))
        live = s["j"] < shards
        return F.when(
            live, F.struct(h.alias("h"), l.alias("l"), s["j"].alias("b"), F.floor(jump).cast("long").alias("j"))
        ).otherwise(s)

    # Every jump moves at least one bucket ahead: no more than `shards` steps.
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["b"].cast("int"))


def key_column(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.coalesce(F.col(name).cast("long"), F.lit(0).cast("long"))
    return F.when(F.col(name).isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(name))


def assign(df: DataFrame, key: str, shards: int) -> DataFrame:
    """``df`` plus ``shard`` and ``grown_shard`` (with one shard more)."""
    k = key_column(df, key)
    return df.withColumn("shard", jump_hash(k, shards)).withColumn("grown_shard", jump_hash(k, shards + 1))


def number(df: DataFrame, order: list[str], key: str, groups: int = SLOT_GROUPS) -> DataFrame:
    """``df`` (with ``shard``) plus ``slot``: 0, 1, 2 ... inside each shard,
    by (hash group of the key, ``order``).  A shard is cut into ``groups``
    sort units; the counts before each unit are a table of at most shards *
    groups rows, computed by partial aggregation."""
    high, _ = _next(*_halves(key_column(df, key)))
    grouped = df.withColumn("_group", (F.shiftright(high, 3) % groups).cast("int"))
    counts = grouped.groupBy("shard", "_group").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("shard", "_group").orderBy(*order))
    numbered = grouped.withColumn("_own", own).join(F.broadcast(offsets), ["shard", "_group"])
    return numbered.withColumn("slot", (F.col("_before") + F.col("_own") - 1).cast("long")).drop("_group", "_own", "_before")


def shard_documents(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, size, text_crc32, law, shard, slot, grown_shard``: the id and
    the shard count decide (law ``key``).  ``size`` is the text's UTF-8
    bytes (null: none) plus 16.  Only ids, sizes and checksums are shuffled."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    out = number(assign(rows, id_col, shards), [id_col, "text_crc32", "size"], id_col)
    return out.select(id_col, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
