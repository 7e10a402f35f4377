"""Language identification with a bit-sliced Bloom filter over letter n-grams.

Training counts, per language, how many documents hold each n-gram.  An n-gram
belongs to every language where its document rate is at least ``ratio`` times
its highest rate and at least ``min_share`` of the documents.  All languages
share one filter: slot ``s`` holds one bit per language (a row of the sliced
filter), so the AND of an n-gram's slots returns every language containing it
in one look-up.  A text's score for a language is the number of its n-grams
with that bit, less the expected false positives; the largest decides.

The filter has a fixed size (``2**slot_bits`` slots of 8 bytes per 64
languages), whatever the corpus; it is the only thing broadcast.  Training
moves one row per distinct (task, language, n-gram).

Defined cases: a NULL text or one without letters is ``und`` with score 0; a
text with letters but no known n-gram gets the language with most training
documents and score 0; without any labelled document everything is ``und``.
Rows with a NULL or empty language are not learned from.  Repeated rows and
ids are predicted row by row.  Columns already called like the outputs are
replaced.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from fleetlens.llm.common import ARROW_ROWS

UNDETERMINED = "und"
GRAM = 3
HASHES = 3  # slots per n-gram; slot i is bits [20 i, 20 i + slot_bits) of its hash
SLOT_BITS = 20
MIN_SHARE = 0.002
RATIO = 0.5
MAX_LANGUAGES = 4096
FLUSH = 1 << 18  # n-grams a training task holds back before it merges them
HELD = 1 << 20  # distinct (language, n-gram) a training task holds before it hands them on

_letter: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letter
    if _letter is None:
        kinds = (unicodedata.category(chr(c))[0] for c in range(0x110000))
        _letter = np.fromiter((k in "LM" for k in kinds), bool, 0x110000)
    return _letter


def has_letter(text: str) -> bool:
    return any(unicodedata.category(c)[0] == "L" for c in set(text))


def gram_hashes(text: str | None, size: int = GRAM) -> np.ndarray:
    """64-bit hashes of all n-grams of the lower-cased letter runs, each run between two blanks."""
    if not text:
        return np.empty(0, np.uint64)
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _is_letter()[points]
    points = np.where(letters, points, 32)
    keep = letters.copy()
    keep[0] = True
    keep[1:] |= letters[:-1]  # of a run of blanks only the first
    points = points[keep].astype(np.uint64)
    n = len(points) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h = h * np.uint64(0x1F3D5B79A3C1E57) + points[i : i + n]
    # finaliser of the splitmix64 generator
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass(frozen=True)
class LanguageFilter:
    """``slots[w, s]``: languages 64 w .. 64 w + 63 of slot s; languages are ordered by training documents."""

    languages: tuple[str, ...]
    slots: np.ndarray

    def false_positive(self) -> np.ndarray:
        """Per language, the chance that an n-gram it lacks passes: its share of set bits to the power of HASHES."""
        out = []
        for i in range(len(self.languages)):
            bit = (self.slots[i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            out.append(float(bit.mean()) ** HASHES)
        return np.array(out)

    def lookup(self, grams: np.ndarray) -> np.ndarray:
        """Language bit masks (64 per row) of each n-gram."""
        mask = np.uint64(self.slots.shape[1] - 1)
        found = None
        for i in range(HASHES):
            row = self.slots[:, (grams >> np.uint64(20 * i)) & mask]
            found = row if found is None else found & row
        return found

    def decide(self, text: str | None, rates: np.ndarray) -> tuple[str, float]:
        """The language and the share of the text's n-grams it holds, corrected for false positives."""
        if not text or not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        grams = gram_hashes(text)
        if not len(grams):
            return self.languages[0], 0.0
        found = self.lookup(grams)
        hits = np.array(
            [((found[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).sum() for i in range(len(self.languages))],
            dtype=np.float64,
        )
        expected = len(grams) * rates
        true = np.clip((hits - expected) / np.maximum(1 - rates, 1e-9), 0, None)
        best = int(np.argmax(true))
        return self.languages[best], float(min(1.0, true[best] / len(grams)))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per (language, n-gram) of one task, merged whenever FLUSH n-grams have gathered."""
    done: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    waiting: dict[str, list[np.ndarray]] = {}
    held = 0

    def merge() -> None:
        for lang, arrays in waiting.items():
            old, n_old = done.get(lang, (np.empty(0, np.uint64), np.empty(0, np.int64)))
            grams, at = np.unique(np.concatenate([old, *arrays]), return_inverse=True)
            counts = np.bincount(at[len(old) :], minlength=len(grams)).astype(np.int64)
            counts[at[: len(old)]] += n_old
            done[lang] = grams, counts
        waiting.clear()

    def rows() -> Iterator[pa.RecordBatch]:
        merge()
        for lang, (grams, counts) in done.items():
            for i in range(0, len(grams), 50_000):
                part = grams[i : i + 50_000].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array(part), pa.array(counts[i : i + 50_000])],
                    names=["lang", "gram", "n"],
                )
        done.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            grams = np.unique(gram_hashes(text))
            if len(grams):
                waiting.setdefault(lang, []).append(grams)
                held += len(grams)
        if held >= FLUSH:
            merge()
            held = 0
            if sum(len(g) for g, _ in done.values()) >= HELD:
                yield from rows()
    yield from rows()


def train(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_share: float = MIN_SHARE,
    ratio: float = RATIO,
    slot_bits: int = SLOT_BITS,
) -> LanguageFilter:
    """Learn the filter from every row of ``docs`` with a non-empty language.

    At most ``average n-grams per document / min_share`` n-grams of a language
    qualify, a bound that does not grow with the corpus; the driver receives
    ``2**slot_bits`` slots per 64 languages at most.
    """
    labelled = docs.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    labelled = labelled.where("lang is not null and lang <> '' and lang <> 'und'")
    sizes = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = tuple(r["lang"] for r in sizes)
    slots = np.zeros((max(1, -(-len(languages) // 64)), 1 << slot_bits), np.uint64)
    if not languages:
        return LanguageFilter(languages, slots)

    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    columns = pa.array(languages), pa.array(range(len(sizes)), pa.int32()), pa.array([float(r["count"]) for r in sizes])
    # from an Arrow table: rows of Python objects would start Python workers of another kind, which stay
    known = spark.createDataFrame(pa.table(columns, ["lang", "bit", "docs"]))
    rates = (
        labelled.mapInArrow(_count_grams, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .join(F.broadcast(known), "lang")  # at most MAX_LANGUAGES rows
        .select("gram", "bit", (F.col("n") / F.col("docs")).alias("rate"))
        .where(F.col("rate") >= min_share)
    )
    top = F.array_max(F.col("of.rate"))
    kept = (
        rates.groupBy("gram")
        .agg(F.collect_list(F.struct("bit", "rate")).alias("of"))  # one entry per language
        .select("gram", F.explode(F.filter("of", lambda x: x["rate"] >= ratio * top)).alias("x"))
        .select("gram", (F.col("x.bit") / 64).cast("int").alias("word"), F.pmod("x.bit", F.lit(64)).alias("bit"))
    )
    slot = [F.shiftrightunsigned("gram", 20 * i).bitwiseAND((1 << slot_bits) - 1) for i in range(HASHES)]
    filled = (
        kept.select("word", F.expr("shiftleft(1L, bit)").alias("mask"), F.explode(F.array(*slot)).alias("slot"))
        .groupBy("word", "slot")
        .agg(F.bit_or("mask").alias("mask"))
        .toArrow()
    )
    slots[filled["word"].to_numpy(), filled["slot"].to_numpy()] = filled["mask"].to_numpy().view(np.uint64)
    return LanguageFilter(languages, slots)


def predict(docs: DataFrame, model: LanguageFilter, text_col: str = "text") -> Column:
    """A struct column (lang_pred, score) of the text column."""
    shared = docs.sparkSession.sparkContext.broadcast((model, model.false_positive()))
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))

    @F.pandas_udf("lang_pred string, score double")
    def decide(texts: pd.Series) -> pd.DataFrame:
        filt, rates = shared.value
        return pd.DataFrame([filt.decide(t, rates) for t in texts], columns=["lang_pred", "score"])

    return decide(F.col(f"`{text_col}`"))


def identify(docs: DataFrame, model: LanguageFilter, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns lang_pred and score (existing ones of these names are replaced)."""
    rest = docs.drop("lang_pred", "score")
    found = rest.withColumn("_decided", predict(docs, model, text_col))
    return found.select(*(F.col(f"`{c}`") for c in rest.columns), "_decided.lang_pred", "_decided.score")
