"""Benchmark decontamination over a distributed positional inverted index.

The index is a table of segments.  A segment holds whole documents (about
SEGMENT_WORDS words): its distinct terms, and per term the sorted positions in
the segment's word stream, plus where each document starts.  Segments are
built where the documents are read, so no posting is shuffled and a term that
every document holds is spread like the documents.  When the test vocabulary
is small enough to broadcast, postings of other terms (which cannot match) are
left out; else all are stored.

A phrase is found by taking, inside a segment, its rarest term's positions less
the term's offset as candidate starts, and intersecting them with the other
terms' offset-adjusted positions, the next rarest first.  A proximity query is
answered from its rarest term's positions likewise.  Test phrases travel to the
segments in blocks of a bounded size.

Terms are compared by 64-bit hashes.  Defined cases: NULL or wordless texts
have a row with zeros; a benchmark item of fewer than ``window`` words is one
phrase, an item without words is none; a NULL item id counts as the empty
string; rows that repeat a doc_id are judged row by row; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import BROADCAST_BYTES, Workspace, plain_words, word_hashes

WINDOW = 10
SEGMENT_WORDS = 1 << 20
SEGMENT_DOCS = 1 << 16
INDEX_SCHEMA = "segment long, doc_ids array<long>, doc_words binary, terms binary, starts binary, positions binary"


@dataclass(frozen=True)
class Phrases:
    """Test phrases of one block: distinct term rows by width, and the items each row belongs to."""

    terms: dict[int, np.ndarray]  # width -> (n, width) term hashes
    items: dict[int, list[list[str]]]  # width -> per row the item ids


@dataclass(frozen=True)
class Segment:
    number: int
    doc_ids: list[int | None]
    doc_starts: np.ndarray  # one more than documents
    terms: np.ndarray
    starts: np.ndarray
    positions: np.ndarray

    @staticmethod
    def read(row: tuple) -> Segment:
        number, ids, words, terms, starts, positions = row
        counts = np.frombuffer(words, "<i4").astype(np.int64)
        return Segment(
            number,
            ids,
            np.r_[0, np.cumsum(counts)],
            np.frombuffer(terms, "<u8"),
            np.frombuffer(starts, "<i4"),
            np.frombuffer(positions, "<i4"),
        )

    def slots(self, terms: np.ndarray) -> np.ndarray:
        """Index of each term in the segment's dictionary, -1 where it has none."""
        if not len(self.terms):
            return np.full(terms.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def postings(self, slot: int) -> np.ndarray:
        return self.positions[self.starts[slot] : self.starts[slot + 1]]

    def phrase(self, slots: np.ndarray) -> np.ndarray:
        """Starts of all occurrences of the phrase inside one document; rarest terms first."""
        order = np.argsort(self.starts[slots + 1] - self.starts[slots], kind="stable")
        found = self.postings(slots[order[0]]) - order[0]
        found = found[found >= 0]
        for i in order[1:]:
            if not len(found):
                return found
            other = self.postings(slots[i])
            at = np.minimum(np.searchsorted(other, found + i), len(other) - 1)
            found = found[other[at] == found + i]
        doc = np.searchsorted(self.doc_starts, found, side="right")
        return found[found + len(slots) <= self.doc_starts[doc]]

    def near(self, slots: np.ndarray, width: int) -> list[tuple[int, int]]:
        """(start, end) of the shortest stretches of at most ``width`` words of one document with every term.

        A stretch is reported when none inside it will do.  Only positions
        within ``width`` of the rarest term are looked at.
        """
        slots = np.unique(slots)
        sizes = self.starts[slots + 1] - self.starts[slots]
        rare = self.postings(slots[np.argmin(sizes)])
        events = []
        for k, s in enumerate(slots):
            p = self.postings(s)
            lo = np.searchsorted(rare, p - width + 1)
            events.append(np.c_[p, np.full(len(p), k)][(lo < len(rare)) & (rare[np.minimum(lo, len(rare) - 1)] <= p + width - 1)])
        merged = np.concatenate(events)
        merged = merged[np.argsort(merged[:, 0], kind="stable")]
        last = np.full(len(slots), -1, np.int64)
        out: list[tuple[int, int]] = []
        for p, k in merged:
            last[k] = p
            a = int(last.min())
            doc_start = self.doc_starts[np.searchsorted(self.doc_starts, p, side="right") - 1]
            if a >= doc_start and p - a < width and (not out or a > out[-1][0]):
                out.append((a, int(p) + 1))
        return out


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: dict[bytes, int] | None = None
) -> DataFrame:
    """The segments of ``docs``; with a vocabulary (word -> hash) only its terms have postings."""
    shared = None if vocabulary is None else docs.sparkSession.sparkContext.broadcast(vocabulary)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 20
        known = None if shared is None else shared.value
        ids: list[int | None] = []
        counts: list[int] = []
        streams: list[np.ndarray] = []
        total = 0

        def segment() -> pa.RecordBatch:
            stream = np.concatenate(streams)
            at = np.flatnonzero(stream)
            order = at[np.argsort(stream[at], kind="stable")]
            terms, starts = np.unique(stream[order], return_index=True)
            blobs = (
                np.array(counts, "<i4"),
                terms.astype("<u8"),
                np.r_[starts, len(order)].astype("<i4"),
                order.astype("<i4"),
            )
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([ids], pa.list_(pa.int64())), *(pa.array([b.tobytes()], pa.binary()) for b in blobs)],
                names=[x.split()[0] for x in INDEX_SCHEMA.split(", ")],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = plain_words(text)
                if known is None:
                    stream = word_hashes(words)
                else:
                    stream = np.fromiter(map(known.get, words, repeat(0)), np.uint64, len(words))
                ids.append(doc_id)
                counts.append(len(words))
                streams.append(stream)
                total += len(words)
                if total >= SEGMENT_WORDS or len(ids) >= SEGMENT_DOCS:
                    yield segment()
                    number += 1
                    ids, counts, streams, total = [], [], [], 0
        if ids:
            yield segment()

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return texts.mapInArrow(build, INDEX_SCHEMA)


def phrases_of(benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, words): every window of ``window`` consecutive words, a shorter item as a whole; distinct."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, out = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = plain_words(text)
                for i in range(max(1, len(words) - window + 1) if words else 0):
                    items.append(item)
                    out.append(words[i : i + window])
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(out, pa.list_(pa.binary()))], names=["item", "words"])

    items = benchmark.select(
        F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")).alias("item"), F.col(f"`{text_col}`").alias("text")
    )
    return items.mapInArrow(rows, "item string, words array<binary>").distinct()


def phrase_blocks(phrases: DataFrame, limit: int) -> Iterator[Phrases]:
    """The phrases in blocks of about ``limit`` bytes, one block on the driver at a time."""
    size = phrases.agg(F.sum(F.expr("aggregate(words, 64L, (n, w) -> n + 40 + length(w))"))).first()[0] or 0
    blocks = -(-size // limit)
    for b in range(blocks):
        part = phrases.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b).toArrow()
        rows: dict[tuple[bytes, ...], list[str]] = {}
        for item, words in zip(part["item"].to_pylist(), part["words"].to_pylist(), strict=True):
            rows.setdefault(tuple(words), []).append(item)
        terms: dict[int, list] = {}
        items: dict[int, list] = {}
        for words, of in rows.items():
            terms.setdefault(len(words), []).append(word_hashes(list(words)))
            items.setdefault(len(words), []).append(of)
        yield Phrases({w: np.array(t, np.uint64) for w, t in terms.items()}, items)


def vocabulary_of(phrases: DataFrame, limit: int) -> dict[bytes, int] | None:
    """Distinct words of the phrases with their hashes, or None when they pass ``limit`` bytes."""
    words = phrases.select(F.explode("words").alias("word")).distinct()
    size = words.agg(F.sum(F.length("word") + 120)).first()[0] or 0
    if size > limit:
        return None
    found = [r["word"] for r in words.collect()]
    found = [bytes(w) for w in found]
    return dict(zip(found, word_hashes(found).tolist(), strict=True))


def _per_segment(index: DataFrame, answer: Callable[[Segment], Iterator[dict]], schema: str) -> DataFrame:
    """Apply ``answer`` (segment -> columns of rows) to every segment."""
    kinds = pa.schema([(f.split(" ")[0], _ARROW[f.split(" ")[1]]) for f in schema.split(", ")])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = answer(Segment.read(tuple(c[i].as_py() for c in batch.columns)))
                yield pa.RecordBatch.from_pydict(found, schema=kinds)

    return index.mapInArrow(rows, schema)


_ARROW = {
    "long": pa.int64(),
    "string": pa.string(),
    "array<string>": pa.list_(pa.string()),
    "array<struct<a:int,b:int>>": pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])),
}


def find_phrases(index: DataFrame, phrases: Phrases) -> DataFrame:
    """(item, doc_id, word): every occurrence of every phrase, word being its first word's place in the document."""
    shared = index.sparkSession.sparkContext.broadcast(phrases)

    def answer(segment: Segment) -> dict:
        out: dict[str, list] = {"item": [], "doc_id": [], "word": []}
        for _, starts, items in _occurrences(segment, shared.value):
            doc = np.searchsorted(segment.doc_starts, starts, side="right") - 1
            for item in items:
                out["item"] += [item] * len(starts)
                out["doc_id"] += [segment.doc_ids[d] for d in doc]
                out["word"] += (starts - segment.doc_starts[doc]).tolist()
        return out

    return _per_segment(index, answer, "item string, doc_id long, word long")


def find_near(index: DataFrame, queries: dict[str, list[str]], width: int) -> DataFrame:
    """(query, doc_id, word, words): shortest stretches of at most ``width`` words that hold all the query's words."""
    hashed = {q: word_hashes([w for t in terms for w in plain_words(t)]) for q, terms in queries.items()}
    shared = index.sparkSession.sparkContext.broadcast(hashed)

    def answer(segment: Segment) -> dict:
        out: dict[str, list] = {"query": [], "doc_id": [], "word": [], "words": []}
        for query, terms in shared.value.items():
            slots = segment.slots(terms)
            if not len(slots) or (slots < 0).any():
                continue
            for a, b in segment.near(slots, width):
                doc = int(np.searchsorted(segment.doc_starts, a, side="right")) - 1
                out["query"].append(query)
                out["doc_id"].append(segment.doc_ids[doc])
                out["word"].append(a - int(segment.doc_starts[doc]))
                out["words"].append(b - a)
        return out

    return _per_segment(index, answer, "query string, doc_id long, word long, words long")


def _occurrences(segment: Segment, phrases: Phrases) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    """(width, starts, items) of every phrase that occurs in the segment."""
    for width, terms in phrases.terms.items():
        slots = segment.slots(terms)
        for i in np.flatnonzero((slots >= 0).all(axis=1)):
            starts = segment.phrase(slots[i])
            if len(starts):
                yield width, starts, phrases.items[width][i]


def _contamination_block(index: DataFrame, phrases: Phrases) -> DataFrame:
    """Per document (row number in the index): words, merged hit stretches and items of one block of phrases."""
    shared = index.sparkSession.sparkContext.broadcast(phrases)

    def answer(segment: Segment) -> dict:
        total = int(segment.doc_starts[-1])
        edge = np.zeros(total + 1, np.int64)
        items: list[set[str]] = [set() for _ in segment.doc_ids]
        for width, starts, of in _occurrences(segment, shared.value):
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + width, -1)
            for d in set((np.searchsorted(segment.doc_starts, starts, side="right") - 1).tolist()):
                items[d].update(of)
        hit = np.cumsum(edge[:-1]) > 0
        spans: list[list[dict]] = [[] for _ in segment.doc_ids]
        for d in [i for i, of in enumerate(items) if of]:
            inside = hit[segment.doc_starts[d] : segment.doc_starts[d + 1]]
            change = np.flatnonzero(np.diff(np.r_[False, inside, False]))
            spans[d] = [{"a": int(a), "b": int(b)} for a, b in change.reshape(-1, 2)]
        first = segment.number * SEGMENT_DOCS
        return {
            "row": list(range(first, first + len(segment.doc_ids))),
            "doc_id": segment.doc_ids,
            "n_words": np.diff(segment.doc_starts).tolist(),
            "spans": spans,
            "items": [sorted(of) for of in items],
        }

    return _per_segment(index, answer, "row long, doc_id long, n_words long, spans array<struct<a:int,b:int>>, items array<string>")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (sorted ids), spans (hit stretches of words, [a, b))."""
    work = Workspace(docs.sparkSession, "decontaminate")
    phrases = work.save(phrases_of(benchmark, window), "phrases")
    index = work.save(build_index(docs, id_col, text_col, vocabulary_of(phrases, block_bytes)), "index")
    parts = [_contamination_block(index, block) for block in phrase_blocks(phrases, block_bytes)]
    found = parts[0] if parts else _contamination_block(index, Phrases({}, {}))
    if len(parts) > 1:  # a document has one row from each block of phrases
        found = (
            reduce(DataFrame.unionByName, parts)
            .groupBy("row", "doc_id", "n_words")
            .agg(
                F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
                F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
            )
        )
    # stretches sorted by start: what each adds beyond the furthest end so far
    n_hit = F.expr(
        "aggregate(spans, named_struct('n', 0L, 'to', 0), (s, x) -> named_struct("
        "'n', s.n + greatest(0, x.b - greatest(x.a, s.to)), 'to', greatest(s.to, x.b)), s -> s.n)"
    )
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.array_sort("items").alias("items"), "spans")
