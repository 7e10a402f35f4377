"""Sharding by jump consistent hashing, in DataFrame functions only.

A row's key (a hash of it, or a whole number taken as it is) seeds the
published 64-bit linear congruential generator; each draw says after how many
added shards the row next moves, so shard counts n and n + 1 share all draws
and a new shard only takes rows in.  Spark's long arithmetic traps overflow, so
the generator's state is three limbs of 22, 22 and 20 bits whose products fit.

Slots number a shard's rows without gaps.  Rows are numbered inside buckets (a
shard's rows that one input task read), and the buckets' counts, added up, give
each bucket's first slot: no task holds a whole shard, whatever key repeats.

Defined cases: a NULL key is a key of its own; a NULL text has no bytes; rows
that repeat a key share its shard and get slots of their own.  Other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from fleetlens.llm.common import Workspace

# Multiplier of the generator in the published algorithm, cut in limbs (fixed value).
MULTIPLIER = 2862933555777941757
LIMB = 22
MASK = (1 << LIMB) - 1
TOP_MASK = (1 << 20) - 1
MAX_DRAWS = 400  # a row needs about ln(shards) draws; this many never happen


def _limbs(value: int) -> tuple[int, int, int]:
    return value & MASK, (value >> LIMB) & MASK, (value >> 2 * LIMB) & TOP_MASK


def jump(key: Column, shards: int) -> Column:
    """Struct (shard, grown): the key's shard of ``shards``, and of one shard more.  ``key`` is a long, used as unsigned."""
    if shards < 1:
        raise ValueError("at least one shard")
    m0, m1, m2 = _limbs(MULTIPLIER)
    start = F.struct(
        key.bitwiseAND(MASK).alias("k0"),
        F.shiftrightunsigned(key, LIMB).bitwiseAND(MASK).alias("k1"),
        F.shiftrightunsigned(key, 2 * LIMB).bitwiseAND(TOP_MASK).alias("k2"),
        F.lit(-1).cast("long").alias("b"),
        F.lit(0).cast("long").alias("j"),
    )

    def draw(s: Column) -> Column:
        low = s["k0"] * m0 + 1
        mid = s["k0"] * m1 + s["k1"] * m0 + F.shiftrightunsigned(low, LIMB)
        top = s["k0"] * m2 + s["k1"] * m1 + s["k2"] * m0 + F.shiftrightunsigned(mid, LIMB)
        k1, k2 = mid.bitwiseAND(MASK), top.bitwiseAND(TOP_MASK)
        drawn = F.shiftleft(k2, 2 * LIMB - 33) + F.shiftrightunsigned(k1, 33 - LIMB) + 1
        after = F.floor((s["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / drawn.cast("double")))
        return F.struct(
            low.bitwiseAND(MASK).alias("k0"), k1.alias("k1"), k2.alias("k2"), s["j"].alias("b"), after.cast("long").alias("j")
        )

    end = F.aggregate(
        F.sequence(F.lit(1), F.lit(min(shards, MAX_DRAWS))), start, lambda s, _: F.when(s["j"] < shards, draw(s)).otherwise(s)
    )
    done = F.when(end["j"] >= shards, end).otherwise(F.raise_error(F.lit("jump hash needs more draws")))
    # the last draw said where the row is next: exactly the new shard, or further on
    return F.transform(
        F.array(done),
        lambda s: F.struct(
            s["b"].cast("int").alias("shard"), F.when(s["j"] == shards, F.lit(shards)).otherwise(s["b"]).cast("int").alias("grown")
        ),
    )[0]


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    work = Workspace(docs.sparkSession, "sharding")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    placed = (
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        )
        .select("*", F.spark_partition_id().alias("bucket"), jump(F.xxhash64("doc_id"), shards).alias("to"))
        .select("doc_id", "size", "text_crc32", "bucket", "to.shard", F.col("to.grown").alias("grown_shard"))
    )
    rows = work.save(placed, "rows")  # written, so that a row's bucket is the same for its count and its number

    counts = rows.groupBy("shard", "bucket").count()
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))

    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")) - 1
    return (
        rows.withColumn("inside", inside)
        .join(first, ["shard", "bucket"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("first") + F.col("inside")).cast("long").alias("slot"),
            "grown_shard",
        )
    )
