"""Helpers the operators of this subpackage share.

Intermediate tables go to the shared folder the session names in
``spark.checkpoint.dir``; they are Parquet, so a lost executor costs only the
tasks it ran and a later stage never recomputes the ones before.
"""

from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from fleetlens.session import ensure_checkpoint_dir

# A side is broadcast only when its measured rows times their width stay under this many bytes.
BROADCAST_BYTES = 32 << 20
# Rows handed to Python at a time: whole texts travel, so far fewer than Spark's 10,000.
ARROW_ROWS = 256
# The white space of the word rules: tab, line feed, vertical tab, form feed, carriage return, space.
SPACES = "\t\n\x0b\x0c\r "


class Workspace:
    """A folder of intermediate tables in the shared checkpoint folder, one per operator run.

    ``save`` writes a frame and returns the written table.  ``drop`` removes
    tables no later step reads; what a returned (lazy) result still reads
    stays until the application's owner clears the shared folder.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
        self.root = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            remove(self.spark, self.path(name))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a table by its URI, on whatever file system it lives."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def small_side(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when the written table ``df`` is counted to be under ``limit``; else leave the join to Spark."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def only(df: DataFrame, *names: str) -> DataFrame:
    """Just the named columns, matched exactly where another differs by case only."""
    return df.select(*(F.col(f"`{n}`") for n in names))


def crc_fold(id_col: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n`` (NULL ids: fold of the empty string)."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(n))


_NOT_WORD = bytes(
    32 if (c <= 0x2F or 0x3A <= c <= 0x60 or 0x7B <= c <= 0x7F) else c
    for c in (b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
)


def space_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words between ASCII white space, as UTF-8."""
    # bytes.lower touches A-Z only and bytes.split cuts at exactly the six characters of SPACES
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) runs of ASCII letters, digits and non-ASCII characters, as UTF-8."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_NOT_WORD).split()


WORD_CACHE = 1 << 17


class _WordHashes(dict):
    """word -> 64-bit hash, cleared when it holds WORD_CACHE words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_hashes = _WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of every word."""
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def safe_join_ids(docs: DataFrame, ids: DataFrame, how: str, id_col: str = "doc_id") -> DataFrame:
    """Semi or anti join of whole rows with a frame of ids; the ids are written first, and broadcast only when few."""
    work = Workspace(docs.sparkSession, "ids")
    side = small_side(work.save(ids.select(F.col(id_col)).distinct(), "ids"), 16)
    return docs.join(side, id_col, how).select(*docs.columns)
