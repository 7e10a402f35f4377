"""Token totals by source, language and tokenizer version, maintained by signed deltas.

A change to the corpus is a batch of signed rows (source, lang, tokenizer,
sign, tokens): +1 for an insert, -1 for a delete, and both for a revised count,
with the old and the new tokens.  A commit adds a batch up by key (partial sums
before the shuffle, so a source with a third of the rows costs one row per
task) and writes the sums as one Parquet folder named after the batch.  Totals
are the sum of all committed folders, so batches may arrive in any order.

A commit is idempotent: a folder counts once its ``_SUCCESS`` mark is there,
committing the batch again changes nothing, and a commit that was cut short
left no mark and is written anew.  ``compact`` replaces committed folders by
their sum under a snapshot that names them.

Defined cases: NULL source or language is a key of its own; a NULL text has no
tokens but is a document; rows that repeat an id count as often as they occur;
an empty batch commits an empty folder; keys whose documents and tokens are
all taken back disappear from the totals.  Only named columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.column import Column

KEYS = ("source", "lang", "tokenizer")
SIGNED = "source string, lang string, tokenizer string, sign int, tokens long"
DELTAS = "source string, lang string, tokenizer string, documents long, tokens long"
SNAPSHOT = "snapshot-"
# Tokenizer versions as the pattern whose matches are tokens.
TOKENIZERS = {
    "spaced-1": r"[^ \t\n\x0B\f\r]+",
    "letters-2": r"[0-9A-Za-z\x{80}-\x{10FFFF}]+",
}


def count_tokens(text: Column, tokenizer: str) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(TOKENIZERS[tokenizer])).cast("long")


def counted(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """(doc_id, source, lang, tokenizer, tokens) of whole texts."""
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.lit(tokenizer).alias("tokenizer"),
        count_tokens(F.col(f"`{text_col}`"), tokenizer).alias("tokens"),
    )


def inserts(rows: DataFrame) -> DataFrame:
    return rows.select(*KEYS, F.lit(1).alias("sign"), "tokens")


def deletes(rows: DataFrame) -> DataFrame:
    return rows.select(*KEYS, F.lit(-1).alias("sign"), "tokens")


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    return deletes(old).unionByName(inserts(new))


class Rollup:
    """The committed batches under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _folder(self, batch: str) -> str:
        if not batch or not all(c.isalnum() or c in "-." for c in batch):
            raise ValueError(f"a batch id has letters, digits, '-' and '.' only: {batch!r}")
        return f"{self.root}/{batch}"

    def is_committed(self, batch: str) -> bool:
        return self._fs.exists(self._path(f"{self._folder(batch)}/_SUCCESS")) or batch in self._absorbed()

    def batches(self) -> list[str]:
        """Folders with a mark, snapshots included."""
        if not self._fs.exists(self._path(self.root)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.root))]
        return sorted(n for n in names if not n.startswith("_") and self._fs.exists(self._path(f"{self.root}/{n}/_SUCCESS")))

    def _absorbed(self) -> set[str]:
        """Batches that a snapshot holds."""
        held: set[str] = set()
        for name in self.batches():
            if name.startswith(SNAPSHOT):
                held |= {r["batch"] for r in self.spark.read.parquet(f"{self.root}/_held/{name}").collect()}
        return held

    def commit(self, batch: str, signed: DataFrame) -> bool:
        """Add a batch of SIGNED rows; False when it was committed before."""
        if batch.startswith(SNAPSHOT):
            raise ValueError("that name is kept for snapshots")
        if self.is_committed(batch):
            return False
        rows = signed.groupBy(*KEYS).agg(
            F.sum("sign").cast("long").alias("documents"), F.sum(F.col("sign") * F.col("tokens")).cast("long").alias("tokens")
        )
        rows.write.mode("overwrite").parquet(self._folder(batch))
        return True

    def _live(self) -> list[str]:
        held = self._absorbed()
        return [b for b in self.batches() if b not in held]

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, documents, tokens over all committed batches."""
        folders = [f"{self.root}/{b}" for b in self._live()]
        rows = self.spark.read.schema(DELTAS).parquet(*folders) if folders else self.spark.createDataFrame([], DELTAS)
        summed = rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return summed.where("documents <> 0 or tokens <> 0")

    def compact(self, name: str) -> None:
        """Sum the live folders into one; they stay on disk, named as held, and no longer count."""
        live = self._live()
        held = [(b,) for b in {*live, *self._absorbed()}]
        totals = self.totals()
        # the list comes first: without the snapshot's own mark it has no effect
        self.spark.createDataFrame(held, "batch string").coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/_held/{SNAPSHOT}{name}"
        )
        totals.write.mode("overwrite").parquet(f"{self.root}/{SNAPSHOT}{name}")
