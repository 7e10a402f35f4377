"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

1. Voters.  A lexicon voter is a term (a word, or the first bytes of a longer
   one) that labelled texts show to go with the label: terms are counted over
   all labelled training texts, and the VOTERS most significant by likelihood
   ratio vote "toxic" where they occur and abstain elsewhere.  Pattern voters
   look at the raw text (shouting, masked letters, stretched letters, runs of
   marks); nothing is assumed about how good they are.
2. Votes.  Every training text, labelled or not, gives a vector of votes; equal
   vectors are counted together.
3. Label model.  The unknown label, and for toxic texts their kind, decides how
   likely each voter fires.  EM over all vectors estimates the kinds' shares and
   each voter's firing rates in them (its accuracy); the labels that are known
   stay fixed and name the classes.  Voters whose firing still goes together
   once the kind is given (correlation above CORRELATED) are no independent
   witnesses: they form a group, and a second EM estimates how often none, some
   or most of a group fire in either kind, so a group speaks once.
4. Classifier.  Texts with the posterior as label, at most SAMPLE of either
   kind, train a logistic model over their terms, found anew in that sample, so
   the score does not need the voters.

Everything but the classifier's sample covers all training texts: counts and EM
sums are Spark aggregations, of which at most kinds x VOTERS squared numbers
reach the driver.  A score reads the text alone.

Defined cases: NULL and empty texts have no terms and get the classifier's base
score.  A NULL label is no label; of repeated labels of an id the largest
counts; rows that repeat a doc_id are texts of their own with that label.
Without labelled texts of both kinds nothing is known and ``train`` gives a
model that scores every text the share of toxic labels.  Other columns are not
read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from fleetlens.llm.common import Workspace, plain_words, small_side

VOTERS = 128
PER_STEM = 2  # lexicon voters that share their first STEM bytes, at most: variants of a word are one witness
STEM = 4
POOL = 2048  # terms the voters are chosen from
MIN_SUPPORT = 3  # toxic texts a voter's term occurs in, at least
MIN_SIGNIFICANCE = 30.0  # likelihood ratio (G) of a term, at least: chance gives as much to one term in 20 million
MIN_PRECISION = 0.8
LENGTHS = (4, 6, 8)  # bytes of the beginnings of words that are terms
WHOLE = 8  # bytes of the longest word that is a term whole
LEVELS = 4  # a term occurring once, twice and so on, up to this, are features of their own
CANDIDATES = 1 << 16  # terms of toxic texts, the most frequent, that are judged by all texts
FLUSH = 1 << 18  # terms a task counts before it passes them on
PATTERN_ROWS = 1 << 15  # distinct vote vectors a task of the label model reads
CORRELATED = 0.5
KIN = 0.1  # correlation of voters on labelled toxic texts from which they are taken to know the same kind
ROUNDS = 8
SMOOTH = 1.0  # rows of either kind that the rates are started with
SAMPLE = 10_000  # texts of either kind that train the classifier, at most (hashes of ids pick them)
FEATURES = 4096
STEPS = 300
RIDGE = 1e-4

# Voters that look at the text itself.
PATTERNS = {
    "shouting": re.compile(r"(?:\b[A-Z]{3,}\b\W+){3}"),
    "masked": re.compile(r"\b[A-Za-z]+[*#@$]{2,}[A-Za-z]*"),
    "stretched": re.compile(r"([A-Za-z])\1{3,}"),
    "marks": re.compile(r"[!?]{3,}"),
}


def word_terms(word: bytes) -> list[bytes]:
    """The beginnings of a word, marked with a caret, and the word whole if it is not long."""
    out = [b"^" + word[:n] for n in LENGTHS if n < len(word)]
    return [*out, word] if len(word) <= WHOLE else out


class Finder:
    """How often some terms, by their places in a list, occur in a text; words are remembered."""

    LIMIT = 1 << 17

    def __init__(self, wanted: list[bytes]):
        self.index = {t: i for i, t in enumerate(wanted)}
        self.cache: dict[bytes, tuple[int, ...]] = {}

    def __call__(self, text: str | None) -> dict[int, int]:
        total: dict[int, int] = {}
        for word, n in Counter(plain_words(text)).items():
            found = self.cache.get(word)
            if found is None:
                if len(self.cache) >= self.LIMIT:
                    self.cache.clear()
                found = self.cache[word] = tuple(i for t in word_terms(word) if (i := self.index.get(t)) is not None)
            for i in found:
                total[i] = total.get(i, 0) + n
        return total


class Features:
    """Which of some features (term, level) a text has; a term found n times has the levels up to n."""

    def __init__(self, wanted: list[tuple[bytes, int]]):
        terms = sorted({t for t, _ in wanted})
        place = {t: i for i, t in enumerate(terms)}
        self.levels: list[list[tuple[int, int]]] = [[] for _ in terms]
        for i, (term, level) in enumerate(wanted):
            self.levels[place[term]].append((level, i))
        self.find = Finder(terms)

    def __call__(self, text: str | None) -> list[int]:
        return sorted(i for at, n in self.find(text).items() for level, i in self.levels[at] if n >= level)


# --- voters ---------------------------------------------------------------------------------


def _candidates(toxic: DataFrame) -> list[bytes]:
    """The CANDIDATES terms that occur in most of these texts, MIN_SUPPORT at least."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def partial() -> Iterator[pa.RecordBatch]:
            found = list(counts.items())
            counts.clear()
            for i in range(0, len(found), 10_000):
                term, n = zip(*found[i : i + 10_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(term, pa.binary()), pa.array(n, pa.int64())], names=["term", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update({t for w in set(plain_words(text)) for t in word_terms(w)})
            if len(counts) >= FLUSH:
                yield from partial()
        yield from partial()

    counts = toxic.select("text").mapInArrow(rows, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
    best = counts.where(F.col("n") >= MIN_SUPPORT).orderBy(F.desc("n"), "term").limit(CANDIDATES)
    return [bytes(r.term) for r in best.collect()]


def _term_counts(texts: DataFrame) -> DataFrame:
    """(term, level, pos, neg) over (text, toxic, weight): the weight of toxic and of other texts each feature occurs in."""
    wanted = _candidates(texts.where("toxic >= 0.5"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Finder(wanted)
        sums = np.zeros((2, LEVELS * len(wanted)))  # by level, then term
        for batch in batches:
            places, sizes = [], []
            for text in batch.column(0).to_pylist():
                found = find(text)
                places += [(min(n, LEVELS) - 1) * len(wanted) + i for i, n in found.items()]
                sizes.append(len(found))
            toxic, weight = (batch.column(i).to_numpy() for i in (1, 2))
            at = np.array(places, np.int64)
            for kind, w in enumerate((weight * (1 - toxic), weight * toxic)):
                sums[kind] += np.bincount(at, np.repeat(w, sizes), sums.shape[1])
        neg, pos = (s.reshape(LEVELS, -1)[::-1].cumsum(axis=0)[::-1] for s in sums)  # found so often or more
        level, term = np.nonzero(pos + neg)
        for i in range(0, len(level), 10_000):
            at = level[i : i + 10_000], term[i : i + 10_000]
            columns = (pa.array(at[1].astype(np.int32)), pa.array((at[0] + 1).astype(np.int32)), pa.array(pos[at]), pa.array(neg[at]))
            yield pa.RecordBatch.from_arrays(list(columns), names=["place", "level", "pos", "neg"])

    parts = texts.select("text", F.col("toxic").cast("double"), F.col("weight").cast("double"))
    counts = parts.mapInArrow(rows, "place int, level int, pos double, neg double")
    counts = counts.groupBy("place", "level").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    named = texts.sparkSession.createDataFrame(list(enumerate(wanted)), "place int, term binary")
    return counts.join(F.broadcast(named), "place").drop("place")  # CANDIDATES rows at most


def _significant(counts: DataFrame, all_pos: float, all_neg: float, limit: int) -> list:
    """The ``limit`` rows of term counts with the greatest likelihood ratio (G), from MIN_SIGNIFICANCE on."""

    def part(found: Column, other: Column, of: float, of_other: float) -> Column:
        expected = (found + other) * (of / (of + of_other))
        return F.when(found > 0, found * F.log(found / expected)).otherwise(F.lit(0.0))

    pos, neg = F.col("pos"), F.col("neg")
    pos0, neg0 = all_pos - pos, all_neg - neg  # texts without the term
    g = 2 * (
        part(pos, neg, all_pos, all_neg) + part(neg, pos, all_neg, all_pos)
        + part(pos0, neg0, all_pos, all_neg) + part(neg0, pos0, all_neg, all_pos)
    )
    # sums of weights differ in their last bits with the order of tasks: rounded, they rank alike in every run
    ranked = counts.withColumn("g", F.round(g, 6)).where(F.col("g") >= MIN_SIGNIFICANCE)
    return ranked.orderBy(F.desc("g"), "term", "level").limit(limit).collect()


def lexicon(labelled: DataFrame, all_pos: int, all_neg: int, voters: int = VOTERS) -> list[tuple[bytes, int, float, float]]:
    """(term, level, pos, neg) of the most significant terms that go with toxic labels, at most PER_STEM alike."""
    counts = _term_counts(labelled).where(
        (F.col("pos") >= MIN_SUPPORT) & (F.col("pos") * all_neg > F.col("neg") * all_pos)
        & (F.col("pos") >= MIN_PRECISION * (F.col("pos") + F.col("neg")))
    )
    alike: Counter = Counter()
    out = []
    for r in _significant(counts, all_pos, all_neg, POOL):
        stem = bytes(r.term).lstrip(b"^")[:STEM]
        alike[stem] += 1
        if alike[stem] <= PER_STEM and len(out) < voters:
            out.append((bytes(r.term), r.level, r.pos, r.neg))
    return out


def _votes(rows_: DataFrame, wanted: list[tuple[bytes, int]], extra: list[str]) -> DataFrame:
    """(votes, *extra): bits of the voters that fire on each text, lexicon first, then the patterns."""
    width = len(wanted) + len(PATTERNS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Features(wanted)
        for batch in batches:
            bits = np.zeros((batch.num_rows, width), bool)
            for i, text in enumerate(batch.column(0).to_pylist()):
                bits[i, find(text)] = True
                bits[i, len(wanted) :] = [text is not None and p.search(text) is not None for p in PATTERNS.values()]
            packed = np.packbits(bits, axis=1)
            votes = pa.array([row.tobytes() for row in packed], pa.binary())
            yield pa.RecordBatch.from_arrays([votes, *batch.columns[1:]], names=["votes", *extra])

    types = {f.name: f.dataType.simpleString() for f in rows_.schema}
    schema = ", ".join(["votes binary", *(f"{c} {types[c]}" for c in extra)])
    return rows_.select("text", *extra).mapInArrow(rows, schema)


# --- the generative label model ---------------------------------------------------------------


@dataclass
class LabelModel:
    """A mixture: kind 0 of texts is not toxic, the others are kinds of toxic texts.

    ``priors``: P(kind).  ``levels``: for each group of voters P(how many fire |
    kind), an array (kinds, size).  Kinds let voters be silent on texts that
    others find, as those of another language, without that silence being held
    against them.
    """

    width: int
    priors: np.ndarray
    groups: list[list[int]]
    levels: list[np.ndarray] = field(default_factory=list)

    def level(self, votes: np.ndarray) -> np.ndarray:
        """(rows, groups): 0 none, 1 some, 2 more than half of the group fire; a voter by itself 0 or 1."""
        out = np.zeros((len(votes), len(self.groups)), np.int64)
        for g, members in enumerate(self.groups):
            fired = votes[:, members].sum(axis=1)
            out[:, g] = np.where(fired == 0, 0, np.where((2 * fired > len(members)) & (len(members) > 1), 2, 1))
        return out

    def kinds(self, votes: np.ndarray, known: np.ndarray | None = None) -> np.ndarray:
        """P(kind) of each row, as (kinds, rows); ``known`` labels (NaN: none) leave only the kinds of that label."""
        level = self.level(votes)
        log = np.repeat(np.log(self.priors)[:, None], len(votes), axis=1)
        for g, table in enumerate(self.levels):
            log += np.log(table)[:, level[:, g]]
        if known is not None:
            log[0, known == 1] = -np.inf
            log[1:, known == 0] = -np.inf
        p = np.exp(log - log.max(axis=0))
        return p / p.sum(axis=0)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 - self.kinds(votes)[0]


def unpack(column: pa.Array, width: int) -> np.ndarray:
    """Vote bits of packed rows."""
    size = (width + 7) // 8
    return np.unpackbits(np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), size), axis=1)[:, :width].astype(bool)


def _weights(batch: pa.RecordBatch, model: LabelModel) -> tuple[np.ndarray, np.ndarray]:
    """Votes of a batch of (votes, label, n), and how many of each row's texts are of each kind."""
    votes = unpack(batch.column(0), model.width)
    known = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
    return votes, model.kinds(votes, known) * batch.column(2).to_numpy()


def _summed(patterns: DataFrame, one) -> dict[tuple[int, int, int], float]:
    """Sum over all rows of the arrays ``one(batch)`` gives, by their three indices."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                total = one(batch) if total is None else total + one(batch)
        if total is not None:
            at = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(i.astype(np.int64)) for i in at), pa.array(total[at])], names=["i", "j", "k", "value"]
            )

    sums = patterns.mapInArrow(rows, "i long, j long, k long, value double").groupBy("i", "j", "k").agg(F.sum("value").alias("value"))
    return {(r.i, r.j, r.k): r.value for r in sums.collect()}


def _dense(sums: dict, shape: tuple[int, int, int]) -> np.ndarray:
    out = np.zeros(shape)
    for at, value in sums.items():
        out[at] = value
    return out


def _estimated(patterns: DataFrame, groups: list[list[int]], by: LabelModel) -> LabelModel:
    """The model with these groups that fits the kinds the model ``by`` sees best."""
    kinds = len(by.priors)
    shape = (len(groups) + 1, kinds, 3)  # one row more than there are groups: all texts of a kind

    def one(batch: pa.RecordBatch) -> np.ndarray:
        votes, weights = _weights(batch, by)
        level = LabelModel(by.width, by.priors, groups).level(votes)
        total = np.zeros(shape)
        for kind in range(kinds):
            for g in range(len(groups)):
                total[g, kind] = np.bincount(level[:, g], weights[kind], 3)
            total[-1, kind, 0] = weights[kind].sum()
        return total

    total = _dense(_summed(patterns, one), shape)
    share = total[-1, :, 0] + SMOOTH
    model = LabelModel(by.width, share / share.sum(), groups)
    for g, members in enumerate(groups):
        size = 3 if len(members) > 1 else 2
        rates = total[g, :, :size] + SMOOTH * np.array(total[g, :, :size].sum(axis=0) + SMOOTH) / (total[g].sum() + size * SMOOTH)
        model.levels.append(rates / rates.sum(axis=1, keepdims=True))
    return model


def _pairs(patterns: DataFrame, width: int, kinds: int, weigh) -> np.ndarray:
    """(kinds, width + 1, width + 1): the texts of each kind on which two voters both fire; a last voter always fires."""

    def one(batch: pa.RecordBatch) -> np.ndarray:
        votes, weights = weigh(batch)
        bits = np.concatenate([votes, np.ones((len(votes), 1), bool)], axis=1).astype(float)
        return np.stack([(bits * w[:, None]).T @ bits for w in weights])

    return _dense(_summed(patterns, one), (kinds, width + 1, width + 1))


def _correlation(both: np.ndarray) -> np.ndarray:
    """Correlation of voters from their joint counts; 0 where one fires on fewer than MIN_SUPPORT texts."""
    n = max(both[-1, -1], 1e-9)
    p = both[:-1, -1] / n
    spread = np.sqrt(np.maximum(p * (1 - p), 0))
    often = both[:-1, -1] >= MIN_SUPPORT
    with np.errstate(invalid="ignore", divide="ignore"):
        r = (both[:-1, :-1] / n - np.outer(p, p)) / np.outer(spread, spread)
    return np.where(np.outer(often, often), np.nan_to_num(r, posinf=0, neginf=0), 0.0)


def _joined(linked: np.ndarray) -> list[list[int]]:
    """Voters grouped by chains of links."""
    root = list(range(len(linked)))
    for i, j in zip(*np.nonzero(linked), strict=True):
        low, high = sorted((root[i], root[j]))
        root = [low if r == high else r for r in root]
    return [[v for v in range(len(linked)) if root[v] == r] for r in sorted(set(root))]


def correlated_groups(patterns: DataFrame, model: LabelModel) -> list[list[int]]:
    """Voters joined when their firing correlates beyond CORRELATED although the kind is given."""
    total = _pairs(patterns, model.width, len(model.priors), lambda batch: _weights(batch, model))
    return _joined(np.any([_correlation(both) >= CORRELATED for both in total], axis=0))


def _start(patterns: DataFrame, width: int) -> LabelModel:
    """Rates of single voters as the known labels have them; voters that toxic texts share make a kind of toxic texts."""

    def known(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        label, n = batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(float)
        return unpack(batch.column(0), width), np.stack([n * (label == y) for y in (0, 1)])

    other, toxic = _pairs(patterns.where("label is not null"), width, 2, known)
    all_other, all_toxic = other[-1, -1], toxic[-1, -1]
    clean = (other[:-1, -1] + SMOOTH) / (all_other + 2 * SMOOTH)
    fired = toxic[:-1, -1]
    speaks = (fired + SMOOTH) / (all_toxic + 2 * SMOOTH) >= 2 * clean
    kin = _joined((_correlation(toxic) >= KIN) & np.outer(speaks, speaks))
    kinds = [members for members in kin if speaks[members[0]] and fired[members].max() >= MIN_SUPPORT]
    # one voter finds part of its kind: a kind is taken to be half as many again as its best voter finds
    sizes = [min(1.5 * fired[members].max(), all_toxic) for members in kinds]
    rates = [clean]
    for members, size in zip(kinds, sizes, strict=True):
        own = clean.copy()
        own[members] = np.clip(fired[members] / size, clean[members], 0.95)
        rates.append(own)
    rates.append(clean)  # toxic texts no voter knows
    share = np.array([*sizes, max(all_toxic - sum(sizes), SMOOTH)])
    toxic_share = (all_toxic + SMOOTH) / (all_toxic + all_other + 2 * SMOOTH)
    priors = np.array([1 - toxic_share, *(toxic_share * share / share.sum())])
    table = np.stack(rates)
    return LabelModel(width, priors, [[v] for v in range(width)], [np.stack([1 - r, r], axis=1) for r in table.T])


def label_model(patterns: DataFrame, width: int) -> LabelModel:
    """EM over vote vectors (votes, label or NULL, n), first with single voters, then with the groups they turn out to form."""
    model = _start(patterns, width)
    for _ in range(ROUNDS // 2):
        model = _estimated(patterns, model.groups, model)
    groups = correlated_groups(patterns, model)
    for _ in range(ROUNDS):
        model = _estimated(patterns, groups, model)
    return model


# --- the classifier -----------------------------------------------------------------------------


def logistic(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, width: int) -> tuple[np.ndarray, float]:
    """Weights and base of a logistic model of sets of features with soft labels, by gradient steps with momentum (Adam).

    All features speak for the label, so no weight may fall below zero: features that
    mostly come together would else be played off against each other.
    """
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    features = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    share = float((weight * y).sum() / weight.sum())
    value = np.zeros(width + 1)
    value[-1] = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
    mean, square = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(at, value[features], len(rows)) + value[-1]
        error = weight * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) / weight.sum()
        slope = np.append(np.bincount(features, error[at], width) + RIDGE * value[:-1], error.sum())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        value = value - 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        value[:-1] = np.maximum(value[:-1], 0)
    return value[:-1], float(value[-1])


@dataclass
class Model:
    """A linear classifier over (term, level) features, and the voters and label model it learnt from, if any."""

    features: list[tuple[bytes, int]]
    weights: np.ndarray
    base: float
    voters: list[tuple[bytes, int]] = field(default_factory=list)
    labels: LabelModel | None = None

    @cached_property
    def find(self) -> Features:
        return Features(self.features)

    def score_text(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[self.find(text)].sum() + self.base, -500, 500))))


def fit(sample: DataFrame) -> Model:
    """The logistic model of (text, toxic, weight), a bounded sample: its terms are counted and found by Spark, then one task fits."""
    sizes = sample.agg(F.sum(F.col("weight") * F.col("toxic")), F.sum(F.col("weight") * (1 - F.col("toxic")))).first()
    # only terms that speak for the label: those against it are the common words of a language with fewer toxic texts
    counts = _term_counts(sample).where(F.col("pos") * sizes[1] > F.col("neg") * sizes[0])
    features = [(bytes(r.term), r.level) for r in _significant(counts, sizes[0], sizes[1], FEATURES)]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Features(features)
        for batch in batches:
            ids = pa.array([find(t) for t in batch.column(0).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([ids, *batch.columns[1:]], names=["found", "toxic", "weight"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        rows = [np.array(r, np.int64) for b in held for r in b.column(0).to_pylist()]
        y, weight = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in (1, 2))
        values, base = logistic(rows, y, weight, len(features))
        yield pa.RecordBatch.from_arrays(
            [pa.array([*range(len(features)), -1], pa.int32()), pa.array([*values.tolist(), base])], names=["feature", "value"]
        )

    ids = sample.mapInArrow(found, "found array<int>, toxic double, weight double")
    # one task, and in one order, so that sums are the same in every run
    solved = ids.repartition(1).sortWithinPartitions("found", "toxic", "weight").mapInArrow(fitted, "feature int, value double")
    values = {r.feature: r.value for r in solved.collect()}
    return Model(features, np.array([values[i] for i in range(len(features))]), values[-1])


def _sample(voted: DataFrame, docs: DataFrame, model: LabelModel, patterns: DataFrame) -> DataFrame:
    """(text, toxic, weight), toxic the posterior: at most about SAMPLE texts of either side of a posterior of one half.

    ``voted``: (key, votes, label); the keys' hashes pick the texts, equal rows of ``docs`` (key, text) count once.
    """

    def sides(batch: pa.RecordBatch) -> np.ndarray:
        _, weights = _weights(batch, model)
        n = weights.sum(axis=0)
        toxic = 2 * weights[0] <= n
        return np.array([n[~toxic].sum(), n[toxic].sum()]).reshape(2, 1, 1)

    sizes = _dense(_summed(patterns, sides), (2, 1, 1)).reshape(2)
    scale = 1 << 30
    shares = np.array([min(1.0, SAMPLE / n) if n else 1.0 for n in sizes])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            known = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
            posterior = np.where(np.isnan(known), model.posterior(unpack(batch.column(1), model.width)), known)
            share = np.where(posterior >= 0.5, shares[1], shares[0])
            stay = np.flatnonzero(batch.column(3).to_numpy() < (share * scale).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(stay)), pa.array(posterior[stay]), pa.array(1 / share[stay])],
                names=["key", "toxic", "weight"],
            )

    drawn = voted.where(F.col("draw") < int(shares.max() * scale)).select("key", "votes", "label", "draw")
    picked = drawn.mapInArrow(decide, "key long, toxic double, weight double")
    picked = picked.groupBy("key").agg(F.max("toxic").alias("toxic"), F.sum("weight").alias("weight"))
    texts = docs.join(F.broadcast(picked), "key")  # about 2 * SAMPLE rows of 24 bytes
    return texts.groupBy("key").agg(*(F.first(c).alias(c) for c in ("text", "toxic", "weight"))).drop("key")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of the texts ``docs`` (doc_id, text), of which ``labels`` (doc_id, toxic) marks some."""
    work = Workspace(docs.sparkSession, "toxicity")
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    known = small_side(work.save(known, "labels"), 16)
    texts = docs.select("doc_id", "text")
    labelled = texts.join(known, "doc_id")
    sizes = {r.label: r["count"] for r in labelled.groupBy("label").count().collect()}
    all_pos, all_neg = sizes.get(1, 0), sizes.get(0, 0)
    if not all_pos or not all_neg:
        share = (all_pos + 0.5) / (all_pos + all_neg + 1) if sizes else 0.0
        return Model([], np.zeros(0), float(np.log(max(share, 1e-6) / (1 - min(share, 1 - 1e-6)))))

    found = lexicon(labelled.select("text", F.col("label").alias("toxic"), F.lit(1).alias("weight")), all_pos, all_neg)
    voters = [(term, level) for term, level, *_ in found]
    width = len(voters) + len(PATTERNS)
    key = F.xxhash64("doc_id", "text")
    rows = texts.join(known, "doc_id", "left").select("text", "label", key.alias("key"), F.pmod(F.xxhash64(key), F.lit(1 << 30)).alias("draw"))
    voted = work.save(_votes(rows, voters, ["label", "key", "draw"]), "voted")
    patterns = work.save(voted.groupBy("votes", "label").agg(F.count("*").alias("n")), "patterns")
    # few vectors are distinct: as many tasks as they need, each of which sends one set of sums
    patterns = patterns.coalesce(1 + patterns.count() // PATTERN_ROWS)
    labels_ = label_model(patterns, width)
    model = fit(work.save(_sample(voted, texts.select(key.alias("key"), "text"), labels_, patterns), "sample"))
    model.voters, model.labels = voters, labels_
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row; 0 to 1, from the text alone."""
    linear = Model(model.features, model.weights, model.base)  # what scoring needs

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [linear.score_text(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return texts.mapInArrow(rows, "doc_id long, score double")
