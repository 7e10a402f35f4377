"""The corpus pipeline: language ID, exact and near deduplication, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps,
with their columns; the last returns packed pieces.  ``run`` writes each
stage's result to the shared folder and reads it back for the next.

Rows are judged one by one: every row gets a key of its own, so of equal texts
one row stays whatever ids they have, and a doc_id that occurs with two texts
can lose one and keep the other.  NULL texts are empty texts (which language ID
rejects), extra columns are carried along under any name.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm import decontaminate, exact_dedup, language_id, near_dedup, packing
from fleetlens.llm.common import Workspace, safe_join_ids, small_side
from fleetlens.llm.queries import tokenizer_files

# A text is rejected when no language holds this share of its letter n-grams: far below any prose of a known language.
MIN_LANGUAGE_SCORE = 0.1
# Near duplicates share at least this part of their five-word shingles (op1 alone has a threshold of its own).
NEAR_LINK = (80, 100)


def _free(docs: DataFrame, name: str) -> str:
    """``name``, with so many underscores that no column of ``docs`` is called so in any case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _keyed(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that numbers its rows, and that column's name.

    A row read from Parquet is known by its file's number and its place in the
    file, which are the same whenever and wherever it is read, so no text is
    copied.  A frame without files is written first.
    """
    key = _free(docs, "row")
    work = Workspace(spark, "rows")
    try:
        path = _free(docs, "path")
        placed = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(key))
    except AnalysisException:  # not a scan of files
        return work.save(docs.withColumn(key, F.monotonically_increasing_id()), "rows"), key
    number = F.row_number().over(Window.orderBy(path)) - 1  # one row a file
    files = work.save(placed.select(path).distinct().withColumn("file", number.cast("long")), "files")
    numbered = placed.join(small_side(files.toDF(path, f"{key}_file"), 512), path)
    return numbered.withColumn(key, F.shiftleft(F.col(f"{key}_file"), 40) + F.col(key)).select(*docs.columns, key), key


def _without(keyed: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """The rows of ``keyed`` whose key is not in ``dropped`` (columns: the key), without the key."""
    return safe_join_ids(keyed, dropped, "left_anti", key).drop(key)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those that fit none of the languages the corpus is labelled with."""
    model = language_id.train(docs)
    found = _free(docs, "decided")
    decided = docs.withColumn(found, language_id.predict(docs, model))
    keep = (F.col(f"{found}.lang_pred") != language_id.UNDETERMINED) & (F.col(f"{found}.score") >= MIN_LANGUAGE_SCORE)
    return decided.where(keep).drop(found)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays: most code points, then smallest doc_id."""
    keyed, key = _keyed(spark, docs)
    # rows are ordered by (doc_id, key) in a group of equal texts
    texts = keyed.select(F.struct(F.col("doc_id"), F.col(key).alias("key")).alias("id"), F.col("text"))
    dropped = exact_dedup.exact_groups(texts, id_col="id").where("not kept").select(F.col("doc_id.key").alias(key))
    return _without(keyed, key, dropped)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group of near duplicates the row of smallest doc_id stays."""
    keyed, key = _keyed(spark, docs)
    found = near_dedup.near_duplicates(keyed.select(F.col(key).alias("key"), "text"), id_col="key", link=NEAR_LINK)
    found = Workspace(spark, "near-rows").save(found.select(F.col("doc_id").alias("key"), "component_id", "kept"), "found")
    # groups of one row are left out; the others choose their row by partial minima
    groups = found.where("not kept").select("component_id").distinct()
    members = found.join(groups, "component_id", "left_semi").join(keyed.select(F.col(key).alias("key"), "doc_id"), "key")
    stays = members.groupBy("component_id").agg(F.min(F.struct("doc_id", "key")).alias("stays"))
    dropped = members.join(stays, "component_id").where("key <> stays.key").select(F.col("key").alias(key))
    return _without(keyed, key, dropped)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a passage of the benchmark occurs."""
    keyed, key = _keyed(spark, docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(keyed.select(F.col(key).alias("key"), "text"), benchmark, id_col="key")
    return _without(keyed, key, found.where("n_hit > 0").select(F.col("doc_id").alias(key)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of packed sequences."""
    return packing.pack_documents(docs, tokenizer_files())


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# Letter n-gram filters, MinHash and a BPE vocabulary are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "corpus-pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.save(stage(spark, docs, sf_dir), name)
    return docs
