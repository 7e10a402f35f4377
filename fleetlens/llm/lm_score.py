"""A hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class),
P(class | history) = Q(class | history) * f(previous word, class) / Z.

* Words are counted over all training texts.  The head of the vocabulary (at
  most ``HEAD`` words, none seen once only) is held in memory by every task;
  every other word, seen or not, is of the tail class.  The SINGLES most frequent
  words are classes of their own; the other head words are grouped by the
  single word most typical of the documents they occur in.
* Q is a maximum-entropy model over hashed features of the history: a bias, the previous word (an n-gram of its context id), the
  previous word together with the class of the one before (a longer n-gram),
  and that class alone (a skip feature).
* Training counts every (history, class) event of the corpus, which is the
  whole gradient's data, and then takes damped diagonal-Newton gradient steps;
  every step's gradient is computed by tasks over their share of the events
  and added up.  The events are bounded by the numbers of contexts and classes.
* Every word of the training texts, however rare, has weights of its own for
  the classes that follow it: f is one scaling step from Q, the classes met after
  the word over those Q expects there.  The OWN_WORDS most frequent words' weights
  are held in memory; those of all other words are made where the word's events
  meet the tokens that follow it in any text, joined by the word, so no number of
  words is too large.
* Within a class a word has its share of the class's tokens; the tail class
  keeps the Good-Turing share for the unseen word.
* Scoring goes over texts in numpy batches; only contexts that occur in a
  batch are computed.  Counts of tail words come by a join on the word, so the
  vocabulary need not fit in memory.

Words are told apart by 64-bit hashes.  Defined cases: a NULL or empty text is
its end token; a text without training texts gets base score 0 for every token
and the model's untrained shares; rows that repeat an id are scored one by one;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import Workspace, space_words, word_hashes

HEAD = 1 << 21  # words in memory: 8 bytes of hash, 8 of count and 2 of class each
CLASSES = 64
SINGLES = 31
TAIL = CLASSES - 1  # the last class
NO_SIGN = CLASSES - 2  # head words of documents without a single word
CONTEXTS = 256  # context ids of the previous word: the most frequent words, then one per class
OWN_CONTEXTS = CONTEXTS - CLASSES
ROWS = 1 << 12  # hashed feature rows of CLASSES weights
FEATURES = 4
OWN_WORDS = 1 << 17  # words whose followers are held in memory: 4 bytes a class each; all others are joined
PRIOR = 1.0  # events of each class a word is taken to have had as Q expects them
BLOCK = 1 << 14  # tokens joined at a time
CACHED = 1 << 10  # tokens whose probabilities stay in cache
STEPS = 25
RIDGE = 1.0
FLUSH = 1 << 21
END = b" "  # no word holds a blank


def token_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the text's tokens: its words and one end."""
    return word_hashes([*space_words(text), END])


@dataclass(frozen=True)
class Vocabulary:
    """The head, sorted by hash, and the totals.  ``rank`` 0 is the most frequent word."""

    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    contexts: np.ndarray
    slots: np.ndarray  # rank of the most frequent words, -1 for others
    tokens: int  # N
    types: int  # V
    tail_tokens: int
    tail_types: int
    once: int  # words seen once
    class_tokens: np.ndarray

    def find(self, words: np.ndarray) -> np.ndarray:
        """Place of each word in the head, -1 for the tail."""
        if not len(self.hashes):
            return np.full(len(words), -1, np.int32)
        different, back = np.unique(words, return_inverse=True)  # looked up once each, in order
        at = np.minimum(np.searchsorted(self.hashes, different), len(self.hashes) - 1)
        return np.where(self.hashes[at] == different, at, -1).astype(np.int32)[back]

    def unseen_share(self) -> float:
        return (self.once + 0.5) / (self.tail_tokens + self.once + 1.0)

    def possible(self) -> np.ndarray:
        """Classes that have words: those met in training, and the tail with its unseen word."""
        return (self.class_tokens > 0) | (np.arange(CLASSES) == TAIL)

    def history(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each token and its history number, for one text; before it stand end tokens."""
        end = self.find(word_hashes([END]))
        padded = np.r_[end, end, ids]
        classes = np.where(padded >= 0, self.classes[padded], TAIL) if len(self.classes) else np.full(len(padded), TAIL)
        contexts = np.where(padded >= 0, self.contexts[padded], OWN_CONTEXTS + TAIL) if len(self.classes) else classes + OWN_CONTEXTS
        return classes[2:].astype(np.int64), contexts[1:-1].astype(np.int64) * CLASSES + classes[:-2]

    def previous_slots(self, texts: list[np.ndarray]) -> np.ndarray:
        """Slot of the word before each token of the texts, -1 where none; before a text stands an end token."""
        if not len(self.slots):
            return np.full(sum(map(len, texts)), -1, np.int32)
        before = _shifted(texts, self.find(word_hashes([END]))[0])
        return np.where(before >= 0, self.slots[before], np.int32(-1))

    def previous_words(self, texts: list[np.ndarray], tails: list[bytes]) -> np.ndarray:
        """Hash of the word before each token."""
        ids = np.concatenate(texts)
        words = np.empty(len(ids), np.uint64)
        words[ids >= 0] = self.hashes[ids[ids >= 0]]
        words[ids < 0] = np.frombuffer(b"".join(tails), "<u8")
        return _shifted(np.split(words, np.cumsum([len(t) for t in texts])[:-1]), word_hashes([END])[0])


def _shifted(texts: list[np.ndarray], first) -> np.ndarray:
    """The texts' values one place later, ``first`` at the start of each (a text has one token at least)."""
    out = np.concatenate([np.array([first], texts[0].dtype), *texts])[:-1]
    out[np.cumsum([0, *(len(t) for t in texts[:-1])])] = first
    return out


@dataclass(frozen=True)
class Model:
    vocabulary: Vocabulary
    weights: np.ndarray  # ROWS x CLASSES
    factors: np.ndarray  # f of the words in slots, a row each; the others are joined
    logs: np.ndarray  # log10 Q of every history
    probabilities: np.ndarray  # Q of every history, in single precision

    def log_classes(self, histories: np.ndarray) -> np.ndarray:
        """log10 Q(class | history), a row per history."""
        return log_softmax(self.weights, histories, self.vocabulary.possible()) / np.log(10)


def feature_rows(histories: np.ndarray) -> np.ndarray:
    """The hashed weight rows (FEATURES each) of history numbers."""
    context, before = histories // CLASSES, histories % CLASSES
    codes = np.stack([np.zeros_like(context), context + 1, histories + (1 << 20), before + (1 << 40)], axis=1).astype(np.uint64)
    codes = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    codes = (codes ^ (codes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((codes >> np.uint64(40)) % np.uint64(ROWS)).astype(np.int64)


def log_softmax(weights: np.ndarray, histories: np.ndarray, possible: np.ndarray) -> np.ndarray:
    z = weights[feature_rows(histories)].sum(axis=1)
    z[:, ~possible] = -np.inf
    z -= z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(at, np.concatenate(counts)).astype(np.int64)


def _tally(batches: Iterator[pa.RecordBatch], keys_of, name: str) -> Iterator[pa.RecordBatch]:
    """(name, n) of one task: how often each key that ``keys_of(batch)`` gives occurs; memory bounded by FLUSH keys."""
    kept: tuple[np.ndarray, np.ndarray] | None = None
    held: list[np.ndarray] = []
    waiting = 0

    def fold() -> tuple[np.ndarray, np.ndarray]:
        new = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.int64), np.empty(0, np.int64))
        return new if kept is None else _merged([kept[0], new[0]], [kept[1], new[1]])

    def rows(found: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(found[0]), 100_000):
            part = slice(i, i + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(found[0][part]), pa.array(found[1][part])], names=[name, "n"])

    for batch in batches:
        keys = keys_of(batch)
        held.append(keys)
        waiting += len(keys)
        if waiting >= FLUSH:
            kept = fold()
            held, waiting = [], 0
            if len(kept[0]) >= FLUSH:
                yield from rows(kept)
                kept = None
    yield from rows(fold())


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) of a frame whose first column is the text."""

    def keys_of(batch: pa.RecordBatch) -> np.ndarray:
        found = [token_hashes(t) for t in batch.column(0).to_pylist()]
        return np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)

    partial = texts.mapInArrow(lambda b: _tally(b, keys_of, "word"), "word long, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def _head(counts: DataFrame, head: int) -> tuple[Vocabulary, int]:
    """The vocabulary without classes, and the least count of a head word (a power of two above one)."""
    bins = (
        counts.groupBy(F.floor(F.log2("n") + F.lit(1e-12)).cast("int").alias("bin"))
        .agg(F.count("*").alias("types"), F.sum("n").alias("tokens"))
        .collect()
    )
    by_bin = {r["bin"]: (r["types"], r["tokens"]) for r in bins}
    least = 1
    while least < 62 and sum(t for b, (t, _) in by_bin.items() if b >= least) > head:
        least += 1
    rows = counts.where(F.col("n") >= (1 << least)).toArrow()
    hashes, n = rows["word"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    order = np.argsort(hashes)
    hashes, n = hashes[order], n[order]
    total = sum(t for _, t in by_bin.values())
    types = sum(t for t, _ in by_bin.values())
    return (
        Vocabulary(
            hashes, n, np.empty(0, np.uint8), np.empty(0, np.uint16), np.empty(0, np.int32), total, types,
            total - int(n.sum()), types - len(n), by_bin.get(0, (0, 0))[0], np.zeros(CLASSES),
        ),
        1 << least,
    )


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str, text_col: str, train: Column) -> DataFrame:
    """(row, doc_id, train, ids, tail): per text its tokens' head places (-1 for tail words) and its tail words' hashes."""
    shared = docs.sparkSession.sparkContext.broadcast(replace(vocabulary, counts=np.empty(0)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = [token_hashes(t) for t in batch.column(2).to_pylist()]
            cuts = np.cumsum([len(t) for t in texts])[:-1]
            places = np.split(shared.value.find(np.concatenate(texts)), cuts)
            ids = [found.astype("<i4").tobytes() for found in places]
            tails = [words[found < 0].astype("<u8").tobytes() for words, found in zip(texts, places, strict=True)]
            row = pa.array(np.arange(number, number + batch.num_rows))
            number += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [row, batch.column(0), batch.column(1), pa.array(ids, pa.binary()), pa.array(tails, pa.binary())],
                names=["row", "doc_id", "train", "ids", "tail"],
            )

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), train.alias("train"), F.col(f"`{text_col}`").alias("text"))
    return texts.mapInArrow(rows, "row long, doc_id long, train boolean, ids binary, tail binary")


def _ids(value: bytes) -> np.ndarray:
    return np.frombuffer(value, "<i4")


def with_classes(vocabulary: Vocabulary, encoded: DataFrame, own_words: int = OWN_WORDS) -> Vocabulary:
    """Give the head words classes: frequent words their own, the others the sign of the texts they occur in."""
    size = len(vocabulary.hashes)
    by_count = np.lexsort((vocabulary.hashes, -vocabulary.counts))
    rank = np.empty(size, np.int64)
    rank[by_count] = np.arange(size)
    end = vocabulary.find(word_hashes([END]))[0]
    singles = np.full(size, -1)
    singles[by_count[:SINGLES]] = np.arange(min(SINGLES, size))
    shared = encoded.sparkSession.sparkContext.broadcast((singles, int(end)))

    def keys_of(batch: pa.RecordBatch) -> np.ndarray:
        single, stop = shared.value
        out = [np.empty(0, np.int64)]
        for value in batch.column(0).to_pylist():
            ids = _ids(value)
            ids = ids[ids >= 0]
            found = single[ids[ids != stop]]
            votes = np.bincount(found[found >= 0], minlength=1)
            sign = int(votes.argmax()) if votes.any() else SINGLES
            out.append(ids.astype(np.int64) * CLASSES + sign)
        return np.concatenate(out)

    partial = encoded.where("train").select("ids").mapInArrow(lambda b: _tally(b, keys_of, "key"), "key long, n long")
    best = (
        partial.groupBy("key").agg(F.sum("n").alias("n"))
        .groupBy(F.floor(F.col("key") / CLASSES).alias("word"))
        .agg(F.max(F.struct("n", F.pmod("key", F.lit(CLASSES)).alias("sign")))["sign"].alias("sign"))
        .toArrow()
    )
    classes = np.full(size, NO_SIGN, np.int64)
    sign = best["sign"].to_numpy()
    classes[best["word"].to_numpy()] = np.where(sign < SINGLES, SINGLES + sign, NO_SIGN)
    classes[singles >= 0] = singles[singles >= 0]
    contexts = np.where(rank < OWN_CONTEXTS, rank, OWN_CONTEXTS + classes)
    slots = np.where(rank < own_words, rank, -1).astype(np.int32)
    tokens = np.bincount(classes, vocabulary.counts, minlength=CLASSES).astype(np.float64)
    tokens[TAIL] = vocabulary.tail_tokens
    return replace(
        vocabulary, classes=classes.astype(np.uint8), contexts=contexts.astype(np.uint16), slots=slots, class_tokens=tokens
    )


def _events(encoded: DataFrame, shared) -> DataFrame:
    """(history, classes): over all training texts, how often each class followed each history (a vector per history)."""

    def keys_of(batch: pa.RecordBatch) -> np.ndarray:
        out = [np.empty(0, np.int64)]
        for value in batch.column(0).to_pylist():
            classes, histories = shared.value.history(_ids(value))
            out.append(histories * CLASSES + classes)
        return np.concatenate(out)

    partial = encoded.where("train").select("ids").mapInArrow(lambda b: _tally(b, keys_of, "key"), "key long, n long")
    counted = partial.groupBy("key").agg(F.sum("n").alias("n"))
    return counted.select(
        F.floor(F.col("key") / CLASSES).alias("history"), F.pmod("key", F.lit(CLASSES)).cast("int").alias("class"), "n"
    )


def _gradient(events: DataFrame, weights: np.ndarray, possible: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Observed less expected class counts, and expected ones, of every weight: the sum of the tasks' parts."""
    shared = events.sparkSession.sparkContext.broadcast(weights)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        observed = np.zeros((ROWS, CLASSES))
        expected = np.zeros((ROWS, CLASSES))
        for batch in batches:
            histories, at = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            n = batch.column(2).to_numpy()
            table = np.zeros((len(histories), CLASSES))
            np.add.at(table, (at, batch.column(1).to_numpy()), n)
            rows = feature_rows(histories)
            p = np.exp(log_softmax(shared.value, histories, possible)) * table.sum(axis=1, keepdims=True)
            for f in range(FEATURES):
                np.add.at(observed, rows[:, f], table)
                np.add.at(expected, rows[:, f], p)
        used = np.flatnonzero(expected.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array([r.tobytes() for r in observed[used]], pa.binary()), pa.array([r.tobytes() for r in expected[used]], pa.binary())],
            names=["row", "observed", "expected"],
        )

    found = events.mapInArrow(part, "row long, observed binary, expected binary").toArrow()
    shared.unpersist()
    sums = []
    for name in ("observed", "expected"):
        total = np.zeros((ROWS, CLASSES))
        if len(found):
            np.add.at(total, found["row"].to_numpy(), np.frombuffer(b"".join(found[name].to_pylist())).reshape(-1, CLASSES))
        sums.append(total)
    return sums[0] - sums[1], sums[1]


def fit_weights(events: DataFrame, possible: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Weights after ``steps`` distributed gradient updates, each scaled by the diagonal of the curvature and 1 / FEATURES."""
    weights = np.zeros((ROWS, CLASSES))
    for _ in range(steps):
        gradient, expected = _gradient(events, weights, possible)
        step = (gradient - RIDGE * weights) / (FEATURES * (expected + RIDGE))
        weights += np.clip(step, -1.0, 1.0)
    return weights


def scaled(met: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """f of words by the classes met after them and those Q expects there; 1 for a word without events."""
    return (met + PRIOR) / (expected + PRIOR)


def log_followers(
    probabilities: np.ndarray, factors: np.ndarray, histories: np.ndarray, which: np.ndarray, classes: np.ndarray
) -> np.ndarray:
    """What ``factors``, of which ``which`` names a token's row, add to log10 Q(class | history) of each token."""
    total = np.empty(len(histories), np.float32)
    for i in range(0, len(histories), CACHED):
        part = slice(i, i + CACHED)
        np.einsum("ij,ij->i", probabilities[histories[part]], factors[which[part]], out=total[part])
    return np.log10(factors[which, classes].astype(np.float64)) - np.log10(total)


def _own_factors(encoded: DataFrame, shared, probabilities: np.ndarray, own_words: int) -> np.ndarray:
    """f of the words in slots, a row each.

    Tasks count, per slot, the classes that followed and the classes before; a
    slot's counts are added up in one task, at most 2 * CLASSES of them from each
    counting task, and the factors alone, ``own_words`` rows, are gathered.
    """
    width = 2 * CLASSES
    contexts = np.zeros(own_words, np.int64)
    v = shared.value
    contexts[v.slots[v.slots >= 0]] = v.contexts[v.slots >= 0]
    given = encoded.sparkSession.sparkContext.broadcast((contexts, probabilities.reshape(CONTEXTS, CLASSES, CLASSES)))

    def keys_of(batch: pa.RecordBatch) -> np.ndarray:
        texts = [_ids(x) for x in batch.column(0).to_pylist()]
        if not texts:
            return np.empty(0, np.int64)
        slots = shared.value.previous_slots(texts).astype(np.int64)
        pairs = [shared.value.history(t) for t in texts]
        own = slots >= 0
        slots = slots[own] * width
        classes, before = (np.concatenate([p[i] for p in pairs])[own] for i in (0, 1))
        return np.concatenate([slots + classes, slots + CLASSES + before % CLASSES])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(own_words * width, np.int64)
        for batch in batches:
            np.add.at(total, batch.column(0).to_numpy(), batch.column(1).to_numpy())
        total = total.reshape(own_words, width)
        used = np.flatnonzero(total.any(axis=1))
        met, before = total[used, :CLASSES], total[used, CLASSES:]
        context, q = given.value
        expected = np.empty(met.shape)
        for c in np.unique(context[used]):
            these = context[used] == c
            expected[these] = before[these] @ q[c]
        rows = [r.tobytes() for r in scaled(met, expected).astype("<f4")]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(rows, pa.binary())], names=["slot", "f"])

    partial = encoded.where("train").select("ids").mapInArrow(lambda b: _tally(b, keys_of, "key"), "key long, n long")
    found = partial.repartition(F.floor(F.col("key") / width)).mapInArrow(part, "slot long, f binary").toArrow()
    out = np.ones((own_words, CLASSES), np.float32)
    if len(found):
        out[found["slot"].to_numpy()] = np.frombuffer(b"".join(found["f"].to_pylist()), "<f4").reshape(-1, CLASSES)
    return out


def _token_rows(encoded: DataFrame, shared) -> DataFrame:
    """(word, code, row) of the tokens after words without a slot, ``code`` being history and class.

    A training token is there twice: as an event of its word, with row -1, and as a token to score.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = shared.value.vocabulary
            texts = [_ids(x) for x in batch.column(2).to_pylist()]
            lengths = [len(t) for t in texts]
            rest = v.previous_slots(texts) < 0
            words = v.previous_words(texts, batch.column(3).to_pylist())[rest].view(np.int64)
            pairs = [v.history(t) for t in texts]
            code = (np.concatenate([h * CLASSES + c for c, h in pairs])[rest]).astype(np.int32)
            row = np.repeat(batch.column(0).to_numpy(), lengths)[rest]
            event = np.repeat(batch.column(1).to_numpy(zero_copy_only=False).astype(bool), lengths)[rest]
            columns = [np.concatenate([x, x[event]]) for x in (words, code)]
            columns.append(np.concatenate([row, np.full(int(event.sum()), -1)]))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["word", "code", "row"])

    return encoded.select("row", "train", "ids", "tail").mapInArrow(rows, "word long, code int, row long")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of the batches, BLOCK rows or a little more at a time."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= BLOCK:
            yield [np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(batch.num_columns)]
            held, count = [], 0
    if count:
        yield [np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(held[0].num_columns)]


def score_followers(encoded: DataFrame, shared) -> DataFrame:
    """(row, more): what f of a previous word without a slot adds to the log10 probability of a text's token.

    Tokens meet the events of their previous word in its partition, events first,
    so that a word of any number of tokens is held as one row of sums.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value.probabilities
        last, last_met, last_expected = None, np.zeros(CLASSES), np.zeros(CLASSES)
        for word, code, row in _chunks(batches):
            new = np.r_[True, word[1:] != word[:-1]]
            at = np.cumsum(new) - 1
            names = word[new]
            histories, classes = code // CLASSES, code % CLASSES
            event = row < 0
            of = at[event]
            met = np.bincount(of * CLASSES + classes[event], minlength=len(names) * CLASSES).reshape(-1, CLASSES).astype(np.float64)
            expected = np.zeros(met.shape)
            if len(of):
                starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                expected[of[starts]] = np.add.reduceat(q[histories[event]], starts, axis=0, dtype=np.float64)
            if last == names[0]:
                met[0] += last_met
                expected[0] += last_expected
            last, last_met, last_expected = names[-1], met[-1], expected[-1]
            asked = ~event
            h, c = histories[asked], classes[asked]
            more = log_followers(q, scaled(met, expected).astype(np.float32), h, at[asked], c)
            yield pa.RecordBatch.from_arrays([pa.array(row[asked]), pa.array(more)], names=["row", "more"])

    tokens = _token_rows(encoded, shared).repartition("word").sortWithinPartitions("word", "row")
    return tokens.mapInArrow(rows, "row long, more double")


def train(
    encoded: DataFrame, vocabulary: Vocabulary, work: Workspace, steps: int = STEPS, own_words: int = OWN_WORDS
) -> Model:
    vocabulary = with_classes(vocabulary, encoded, own_words)
    shared = encoded.sparkSession.sparkContext.broadcast(replace(vocabulary, counts=np.empty(0)))
    events = work.save(_events(encoded, shared).repartition("history"), "events")
    weights = fit_weights(events, vocabulary.possible(), steps)
    logs = log_softmax(weights, np.arange(CONTEXTS * CLASSES), vocabulary.possible())
    probabilities = np.exp(logs).astype(np.float32)
    return Model(vocabulary, weights, _own_factors(encoded, shared, probabilities, own_words), logs / np.log(10), probabilities)


def score_head(encoded: DataFrame, shared) -> DataFrame:
    """(row, doc_id, train, n_tokens, n_head, base, score): everything but what is joined by words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        v = m.vocabulary
        floor = np.log10(v.tokens + 0.5 * (v.types + 1))
        log_count = np.log10(v.counts + 0.5)
        with np.errstate(divide="ignore"):
            inside = np.log10(v.counts) - np.log10(v.class_tokens[v.classes]) if len(v.classes) else np.empty(0)
        for batch in batches:
            texts = [_ids(x) for x in batch.column(3).to_pylist()]
            if not texts:
                continue
            ids = np.concatenate(texts)
            pairs = [v.history(t) for t in texts]
            classes = np.concatenate([p[0] for p in pairs])
            histories = np.concatenate([p[1] for p in pairs])
            score = m.logs[histories, classes]
            slots = v.previous_slots(texts)
            own = slots >= 0
            score[own] += log_followers(m.probabilities, m.factors, histories[own], slots[own], classes[own])
            known = ids >= 0
            base = np.full(len(ids), -floor)
            base[known] += log_count[ids[known]]
            score[known] += inside[ids[known]]
            starts = np.r_[0, np.cumsum([len(t) for t in texts])[:-1]]
            columns = [np.add.reduceat(x, starts) for x in (known.astype(np.int64), base, score)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([len(t) for t in texts], pa.int64()), *map(pa.array, columns)],
                names=["row", "doc_id", "train", "n_tokens", "n_head", "base", "score"],
            )

    schema = "row long, doc_id long, train boolean, n_tokens long, n_head long, base double, score double"
    return encoded.select("row", "doc_id", "train", "ids").mapInArrow(rows, schema)


def tail_words(encoded: DataFrame) -> DataFrame:
    """(row, word, n) of the texts' tail words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(np.frombuffer(t, "<i8"), return_counts=True) for t in batch.column(1).to_pylist()]
            if found:
                row = np.repeat(batch.column(0).to_numpy(), [len(f[0]) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row), *(pa.array(np.concatenate([f[i] for f in found])) for i in (0, 1))], names=["row", "word", "n"]
                )

    return encoded.select("row", "tail").where(F.octet_length("tail") > 0).mapInArrow(rows, "row long, word long, n long")


def score_documents(
    docs: DataFrame,
    train_on: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    head: int = HEAD,
    steps: int = STEPS,
    own_words: int = OWN_WORDS,
) -> DataFrame:
    """Learn from the rows where ``train_on`` is true and score every row.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    work = Workspace(docs.sparkSession, "lm-score")
    counts = work.save(count_words(docs.where(train_on).select(F.col(f"`{text_col}`"))), "counts")
    vocabulary, least = _head(counts, head)
    encoded = work.save(encode(docs, vocabulary, id_col, text_col, train_on), "encoded")
    model = train(encoded, vocabulary, work, steps, own_words)
    v = model.vocabulary

    unseen = v.unseen_share()
    shared_mass = float(np.log10(1 - unseen) - np.log10(v.tail_tokens + 0.5 * v.tail_types)) if v.tail_types else 0.0
    tail = (
        tail_words(encoded)
        .join(counts.where(F.col("n") < least).withColumnRenamed("n", "c"), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("seen"),
            F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("base_part"),
            F.sum(
                F.col("n")
                * F.when(F.col("c").isNull(), F.lit(float(np.log10(unseen)))).otherwise(F.log10(F.col("c") + 0.5) + shared_mass)
            ).alias("score_part"),
        )
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    followers = score_followers(encoded, shared).groupBy("row").agg(F.sum("more").alias("more"))
    return (
        score_head(encoded, shared)
        .join(tail, "row", "left")
        .join(followers, "row", "left")
        .select(
            "doc_id",
            (~F.col("train")).alias("held_out"),
            "n_tokens",
            (F.col("n_head") + F.coalesce("seen", F.lit(0))).alias("n_known"),
            F.lit(v.tokens).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("base_part", F.lit(0.0))).alias("base_score"),
            (F.col("score") + F.coalesce("score_part", F.lit(0.0)) + F.coalesce("more", F.lit(0.0))).alias("score"),
        )
    )
