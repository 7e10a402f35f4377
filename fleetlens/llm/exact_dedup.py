"""Exact deduplication by counting quotient filters.

A text is compared after deleting ASCII white space.  Its 64-bit fingerprint is
cut in three: the top ``block_bits`` name a block, the next ``QUOTIENT_BITS``
the quotient (the run inside the block), the rest is the remainder.  Every task
builds the filter of its own rows: per block the length of each quotient's run,
the sorted remainders and a counter for each.  Filters of a block merge without
loss by merging sorted remainders and adding counters, so a group of copies
costs one entry per task however large it is.

Fingerprints counted above one route their texts to byte verification: groups
of equal fingerprint and SHA-256 must have one text only (smallest = largest,
kept per task, so no group is ever gathered).  All other texts are unique
without being moved.

Defined cases: NULL counts as the empty text, and empty texts are equal.  In a
group the row with the most code points in its original text stays, then the
smallest doc_id (NULL first).  Rows that repeat a doc_id belong to one
document: ``kept`` is the same for them.  Only the id and text columns are
read, so other columns can have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from fleetlens.llm.common import SPACES, Workspace, small_side

QUOTIENT_BITS = 10
BLOCK_ENTRIES = 1 << 14  # fingerprints a block is meant to hold
FLUSH = 1 << 20  # fingerprints a task gathers before it writes its filter
FILTER_SCHEMA = "block int, runs binary, remainders binary, counts binary"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def _encode(fingerprints: np.ndarray, counts: np.ndarray, block_bits: int) -> Iterator[tuple]:
    """Filter rows (one per block) of sorted distinct fingerprints and their counters."""
    rest = 64 - block_bits - QUOTIENT_BITS
    head = fingerprints >> np.uint64(rest)  # block and quotient together
    blocks = (head >> np.uint64(QUOTIENT_BITS)).astype(np.int64)
    quotients = (head & np.uint64((1 << QUOTIENT_BITS) - 1)).astype(np.int64)
    remainders = fingerprints & np.uint64((1 << rest) - 1)
    starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(blocks) else []
    for a, b in zip(starts, [*starts[1:], len(blocks)], strict=True):
        runs = np.bincount(quotients[a:b], minlength=1 << QUOTIENT_BITS).astype("<u4")
        yield (
            int(blocks[a]),
            runs.tobytes(),
            remainders[a:b].astype("<u8").tobytes(),
            counts[a:b].astype("<u8").tobytes(),
        )


def _decode(block: int, runs: bytes, remainders: bytes, counts: bytes, block_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted fingerprints and counters of one filter row."""
    rest = 64 - block_bits - QUOTIENT_BITS
    lengths = np.frombuffer(runs, "<u4")
    quotients = np.repeat(np.arange(len(lengths), dtype=np.uint64), lengths)
    head = (np.uint64(block) << np.uint64(QUOTIENT_BITS)) | quotients
    return (head << np.uint64(rest)) | np.frombuffer(remainders, "<u8"), np.frombuffer(counts, "<u8")


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of counting filters given as (sorted fingerprints, counters)."""
    fingerprints, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.zeros(len(fingerprints), np.uint64)
    np.add.at(counts, at, np.concatenate([p[1] for p in parts]))
    return fingerprints, counts


def block_bits_for(rows: int) -> int:
    """So many leading bits that a block holds BLOCK_ENTRIES fingerprints on average; 24 at most (about 10^11 rows a GB-sized task)."""
    return min(24, max(1, (max(rows, 1) // BLOCK_ENTRIES).bit_length()))


def build_filters(fingerprints: DataFrame, block_bits: int) -> DataFrame:
    """One filter per task and block of a frame with a single long column."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(arrays: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if not arrays:
                return
            found, counts = np.unique(np.concatenate(arrays), return_counts=True)
            out = list(_encode(found, counts.astype(np.uint64), block_bits))
            for i in range(0, len(out), 1000):
                columns = zip(*out[i : i + 1000], strict=True)
                kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["block", "runs", "remainders", "counts"],
                )

        held: list[np.ndarray] = []
        n = 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            n += len(held[-1])
            if n >= FLUSH:
                yield from rows(held)
                held, n = [], 0
        yield from rows(held)

    return fingerprints.mapInArrow(build, FILTER_SCHEMA)


def counted_above_one(filters: DataFrame, block_bits: int) -> DataFrame:
    """Fingerprints (column fp) whose counter is above one in the sum of the filters.

    A task merges the filters of one block, whose size depends on distinct
    fingerprints only, and picks from it in the same Python worker.
    """

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        fingerprints, counts = _merge([_decode(*row, block_bits) for row in pdf.itertuples(index=False)])
        return pd.DataFrame({"fp": fingerprints[counts > 1].view(np.int64)})

    return filters.groupBy("block").applyInPandas(pick, "fp long")


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    fingerprint: Column | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``fingerprint`` (a long expression over ``norm``) replaces the 64-bit hash,
    for tests of the verification.
    """
    work = Workspace(docs.sparkSession, "exact-dedup")
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    texts = texts.withColumn("norm", normalised(F.col("text")))
    texts = texts.withColumn("fp", F.xxhash64("norm") if fingerprint is None else fingerprint)
    sha = F.sha2(F.col("norm").cast("binary"), 256)
    keys = work.save(
        texts.select("doc_id", "fp", F.unhex(sha).alias("sha"), F.length(F.coalesce("text", F.lit(""))).alias("points")),
        "keys",
    )
    bits = block_bits_for(keys.count())
    filters = build_filters(keys.select("fp"), bits)
    repeated = small_side(work.save(counted_above_one(filters, bits), "repeated"), 16)

    best = F.min(F.struct((-F.col("points")).alias("less"), "doc_id"))["doc_id"]
    candidates = texts.join(repeated, "fp", "left_semi").select(
        "doc_id", "fp", "norm", F.unhex(sha).alias("sha"), F.length(F.coalesce("text", F.lit(""))).alias("points")
    )
    verified = F.when(
        F.col("lo") == F.col("hi"), F.col("n")
    ).otherwise(F.raise_error(F.lit("two texts share a SHA-256")).cast("long"))
    groups = work.save(
        candidates.groupBy("fp", "sha")
        .agg(best.alias("keep"), F.count("*").alias("n"), F.min("norm").alias("lo"), F.max("norm").alias("hi"))
        .select("fp", "sha", "keep", verified.alias("n"))
        .where("n > 1"),
        "groups",
    )
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep"))
    return (
        keys.join(small_side(groups, 64), ["fp", "sha"], "left")
        .withColumn("keep_id", keep)
        .select(
            "doc_id",
            "keep_id",
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("sha")).alias("text_sha256"),
        )
    )
