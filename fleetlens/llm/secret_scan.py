r"""Secret scanning with a random forest against false positives, in DataFrame and Spark ML operations only.

Candidates are, over whole texts, the runs of 12 or more key-like characters,
with or without digits, and values of any length that follow an assignment or
one of the two words after a secret's name.  Each carries features:

* its length, its share of digits, capitals and other signs, its distinct
  characters;
* character transitions: how often the kind of character changes;
* dictionary coverage: the share of it that lies in letter runs which are words
  of the corpus (seen in ``MIN_DOCS`` documents or more, counted over all);
* the path it was found in: depth, words such as "test", a hash;
* neighbouring words: whether the text just before names a secret, an example
  or a number, how it is assigned, and hashes of the words around.

A random forest learns from labelled findings.  ``label_by_format`` labels
those whose format settles the matter (issuer prefixes, assignments to a
secret's name; addresses, hosts, dates, plain numbers); any other frame of
labelled findings will do.  At most ``MAX_LABELLED`` labelled rows, of either
label half of them and those of smallest hash, are learned from.  Every candidate gets the forest's probability.

Defined cases: NULL or empty texts have no candidates; a NULL path has depth 0;
without findings of both labels nothing is removed and the probability is 1;
rows that repeat an id are scanned one by one.  Only named columns are read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from fleetlens.llm.common import Workspace, small_side

MIN_LENGTH = 12
MIN_DOCS = 3
MAX_LABELLED = 20_000
TREES, DEPTH, SEED = 24, 7, 7
HASHES = 32
THRESHOLD = 0.5

CANDIDATE = r"[A-Za-z0-9+/_.\-]{12,}={0,2}"
VALUE = r"[^\s\"'`=:,;()\[\]{}<>]+"  # passwords hold other signs too
ASSIGNED_VALUE = rf"(?<=[=:]['\"`]?){VALUE}"
# not what stands after a closing quote
LED_VALUE = rf"(?:^|(?<=^[\"'`(\[{{<])|(?<=[=:,;(\[{{<])|(?<=[=:,;(\[{{<][\"'`])){VALUE}"
SECRET_NAME = r"(?i)(token|secret|passw|pwd|api.?key|credential|bearer|private)"
EXAMPLE_NAME = r"(?i)(example|sample|dummy|placeholder|test|xxxx)"
NUMBER_NAME = r"(?i)(phone|card|order|invoice|isbn|version|date|page)"
# Formats that settle the matter (fixed values: published key prefixes and everyday formats).
ISSUED = r"^(AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|xox[abprs]-[0-9A-Za-z-]{10,}|AIza[0-9A-Za-z_\-]{35}|sk-[0-9A-Za-z]{20,})$"
HARMLESS = r"^([0-9.\-+/_]+|[0-9]{4}-[0-9]{2}-[0-9]{2}.*|[A-Za-z0-9\-]+(\.[A-Za-z0-9\-]+)*\.(com|org|net|edu|io|html|md|py|txt)|[a-z]+(-[a-z]+)+-?[0-9]*)$"

FEATURES = [
    "length", "digits", "capitals", "signs", "distinct", "transitions", "hex", "coverage",
    "path_depth", "path_test", "path_hash", "near_secret", "near_example", "near_number",
    "assigned", "quoted", "mailed", "before_hash", "after_hash",
]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """(doc_id, path, place, part, candidate, word, before, before2, after) of every candidate; place is the word's number."""
    path = F.col(f"`{path_col}`").cast("string") if path_col else F.lit(None).cast("string")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        path.alias("path"),
        F.split(text, r"[ \t\n\x0B\f\r]+").alias("words"),
        text.rlike(SECRET_NAME).alias("names"),  # most texts have none, so their words are not searched for it
        (F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))).alias("signs"),
    )
    word = lambda i: F.coalesce(F.get("words", i), F.lit(""))
    # a name that has its value in its own word names no other
    is_name = lambda w: w.rlike(SECRET_NAME) & ~w.rlike(ASSIGNED_VALUE)
    after_name = lambda i: F.col("names") & (is_name(word(i - 1)) | is_name(word(i - 2)))
    after_sign = lambda i: F.col("signs") & word(i - 1).rlike(r"[=:]['\"`]?$")
    hit = lambda i: (
        (F.length(word(i)) >= MIN_LENGTH)
        | (F.col("signs") & word(i).rlike(ASSIGNED_VALUE))
        | after_sign(i)
        | after_name(i)
    )
    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), hit)
    around = F.transform(
        places,
        lambda i: F.struct(
            i.alias("place"),
            word(i).alias("word"),
            word(i - 1).alias("before"),
            word(i - 2).alias("before2"),
            word(i + 1).alias("after"),
            (after_sign(i) | after_name(i)).alias("led"),
        ),
    )
    found = base.select("doc_id", "path", F.inline(around))
    runs = lambda pattern: F.regexp_extract_all("word", F.lit(pattern), F.lit(0))
    parts = F.array_distinct(F.concat(runs(CANDIDATE), F.when(F.col("led"), runs(LED_VALUE)).otherwise(runs(ASSIGNED_VALUE))))
    return found.select("*", F.posexplode(parts).alias("part", "candidate")).drop("led")


def dictionary(docs: DataFrame, pieces: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """The ``pieces`` (column piece) that occur as words of their own in ``min_docs`` rows of ``docs`` or more."""
    text = F.lower(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    words = F.array_distinct(F.split(text, r"[^\p{L}\p{N}]+"))
    return (
        docs.select(F.explode(words).alias("piece"))
        .join(pieces, "piece", "left_semi")
        .groupBy("piece")
        .agg(F.count("*").alias("docs"))
        .where(F.col("docs") >= min_docs)
        .select("piece")
    )


def _pieces(candidate: Column) -> Column:
    return F.regexp_extract_all(F.lower(candidate), F.lit("[a-z]{3,}"), F.lit(0))


def featured(found: DataFrame, known: DataFrame) -> DataFrame:
    """The candidates with their features; ``known`` is the dictionary of their letter runs (column piece)."""
    texts = found.select("candidate").distinct()
    covered = (
        texts.select("candidate", F.explode(_pieces(F.col("candidate"))).alias("piece"))
        .join(known, "piece")
        .groupBy("candidate")
        .agg(F.sum(F.length("piece")).alias("covered"))
    )
    c = F.col("candidate")
    n = F.length(c).cast("double")
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / n
    lead = F.expr("substring_index(word, candidate, 1)")  # the word's text before the candidate
    near = F.concat_ws(" ", "before2", "before", lead, c)
    just = F.concat_ws(" ", "before", lead)
    path = F.coalesce("path", F.lit(""))
    flag = lambda e: F.when(e, 1.0).otherwise(0.0)
    bucket = lambda e: F.pmod(F.xxhash64(F.lower(e)), F.lit(HASHES)).cast("double")
    return found.join(covered, "candidate", "left").withColumns(
        {
            "length": n,
            "digits": share("[0-9]"),
            "capitals": share("[A-Z]"),
            "signs": share("[^A-Za-z0-9]"),
            "distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
            "transitions": (F.regexp_count(c, F.lit("[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+")) - 1) / n,
            "hex": flag(c.rlike("^[0-9a-f]+$")),
            "coverage": F.coalesce("covered", F.lit(0)) / n,
            "path_depth": F.regexp_count(path, F.lit("/")).cast("double"),
            "path_test": flag(path.rlike(EXAMPLE_NAME)),
            "path_hash": bucket(path),
            "near_secret": flag(near.rlike(SECRET_NAME)),
            "near_example": flag(near.rlike(EXAMPLE_NAME)),
            "near_number": flag(near.rlike(NUMBER_NAME)),
            "assigned": flag(just.rlike(r"[=:]\s*['\"]?$")),
            "quoted": flag(lead.rlike("['\"]$")),
            "mailed": flag(lead.rlike("@$")),
            "before_hash": bucket(F.col("before")),
            "after_hash": bucket(F.col("after")),
        }
    ).drop("covered")


def label_by_format(findings: DataFrame) -> DataFrame:
    """Adds ``label``: 1.0 or 0.0 where the format settles it, else NULL."""
    c = F.col("candidate")
    named = (F.col("near_secret") == 1.0) & (F.col("assigned") == 1.0)
    settled = (
        F.when(c.rlike(ISSUED), 1.0)
        .when(c.rlike(HARMLESS) | (F.col("mailed") == 1.0), 0.0)
        .when(named & (F.col("coverage") < 0.5), 1.0)
        .when(~named & (F.col("coverage") >= 0.7), 0.0)  # copies make a password that is no word one of the corpus
    )
    return findings.withColumn("label", settled)


def classify(findings: DataFrame, labelled: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``findings`` with ``probability`` of a forest learned from ``labelled`` (features and label)."""
    rows = labelled.where("label is not null").select(*FEATURES, "label")
    order = F.xxhash64(*FEATURES, "label")
    some = lambda label: rows.where(F.col("label") == label).orderBy(order).limit(max_labelled // 2)
    bounded = some(0.0).unionByName(some(1.0))  # ordinary words are far more than secrets
    kinds = {r["label"] for r in bounded.select("label").distinct().collect()}
    if kinds != {0.0, 1.0}:
        return findings.withColumn("probability", F.lit(1.0))
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="_features")
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="_features", numTrees=TREES, maxDepth=DEPTH, seed=SEED, probabilityCol="_probability"
    )
    model = forest.fit(assemble.transform(bounded))
    scored = model.transform(assemble.transform(findings))
    return scored.withColumn("probability", vector_to_array("_probability")[1]).drop(
        "_features", "_probability", "rawPrediction", "prediction"
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """One row per candidate: where it is, its text, features, label by format (or NULL), probability, is_secret."""
    work = Workspace(docs.sparkSession, "secret-scan")
    found = work.save(candidates(docs, id_col, text_col, path_col), "candidates")
    pieces = work.save(found.select(F.explode(_pieces(F.col("candidate"))).alias("piece")).distinct(), "pieces")
    known = work.save(dictionary(docs, small_side(pieces, 48), text_col), "dictionary")
    findings = work.save(label_by_format(featured(found, known)), "findings")
    scored = classify(findings, findings)
    return scored.withColumn("is_secret", F.col("probability") >= THRESHOLD)


def redact(docs: DataFrame, findings: DataFrame, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs`` with the secrets of their own findings masked in the text; other rows and columns are unchanged."""
    secrets = findings.where("is_secret").groupBy("doc_id").agg(F.collect_set("candidate").alias("_secrets"))
    longest_first = F.array_sort("_secrets", lambda a, b: F.length(b) - F.length(a))
    # a short one is masked where it stands alone, not inside other words
    alone = lambda s: F.concat(
        F.lit(r"(?<![A-Za-z0-9])\Q"), F.replace(s, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?![A-Za-z0-9])")
    )
    hide = lambda t, s: F.when(F.length(s) >= MIN_LENGTH, F.replace(t, s, F.lit(mask))).otherwise(
        F.regexp_replace(t, alone(s), F.lit(mask.replace("\\", "\\\\").replace("$", "\\$")))
    )
    masked = F.aggregate(longest_first, F.col(f"`{text_col}`"), hide)
    text = F.when(F.col("_secrets").isNull(), F.col(f"`{text_col}`")).otherwise(masked)
    return docs.join(secrets, "doc_id", "left").withColumn(text_col, text).select(*docs.columns)
