"""Cost-balanced packing of token ids into fixed-length sequences.

A document's ids are its BPE ids and one end id.  Attention over a piece of n
tokens costs ``LINEAR * n + QUADRATIC * n * n``.  Documents are packed in the
task that read and tokenised them, in blocks of about BLOCK_TOKENS tokens, so
no id is ever shuffled and a block's memory is bounded:

* sequences: as many of ``length`` tokens as the block fills, and the rest as
  sequences of power-of-two capacity, so nothing is padded;
* whole stretches of ``length`` tokens of long documents fill sequences of
  their own;
* the remaining pieces, longest (costliest) first, each go to the sequence of
  lowest cost so far with room for them; a piece no sequence has room for is
  cut over the sequences of lowest cost.

Defined cases: NULL and empty texts are one end id.  Rows that repeat a doc_id
are packed one by one.  Other columns are not read.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import ARROW_ROWS

LENGTH = 2048
END_ID = 1
LINEAR = 1.0
QUADRATIC = 1.0 / 1024  # a token attending to 1,024 others costs as much again as the rest of its work
BLOCK_TOKENS = 1 << 19
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, capacity long, cost double"


class WordPieces:
    """Ids of texts in the byte-level BPE vocabulary of ``byte_bpe_50k``.

    Texts that hold the name of a special token, which the tokenizer turns
    into one id, go through the ``tokenizers`` library; the others get the
    same ids from the same vocabulary as ranks, which takes a third of the time.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.plain = tiktoken.Encoding("byte_bpe_50k", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        with open(json_path, encoding="utf-8") as file:
            self.special = [t["content"] for t in json.load(file)["added_tokens"]]
        self.json_path = json_path

    @cached_property
    def full(self):
        """The ``tokenizers`` form, loaded only where a text needs it: it takes as much memory as all the rest."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.json_path)

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.plain.encode_ordinary(text), np.uint32)


@lru_cache(maxsize=2)
def word_pieces(json_path: str, ranks_path: str, pattern: str) -> WordPieces:
    """One tokenizer per Python worker."""
    return WordPieces(json_path, ranks_path, pattern)


def cost_of(n: int, linear: float = LINEAR, quadratic: float = QUADRATIC) -> float:
    return linear * n + quadratic * n * n


def capacities(total: int, length: int) -> list[int]:
    """Sequences that ``total`` tokens fill without padding: full ones, then powers of two, largest first."""
    rest = total % length
    return [length] * (total // length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(
    lengths: list[int], length: int = LENGTH, linear: float = LINEAR, quadratic: float = QUADRATIC
) -> tuple[list[tuple[int, int, int, int, int]], list[int], list[float]]:
    """Pieces (document, start, length, sequence, offset), and capacity and cost of each sequence.

    ``lengths`` are token counts of a block's documents, at least 1 each.
    """
    room = capacities(sum(lengths), length)
    full = list(room)
    cost = [0.0] * len(room)
    pieces: list[tuple[int, int, int, int, int]] = []

    def place(doc: int, start: int, n: int, seq: int) -> None:
        pieces.append((doc, start, n, seq, full[seq] - room[seq]))
        room[seq] -= n
        cost[seq] += cost_of(n, linear, quadratic)

    own = 0
    rest = []
    for doc, n in enumerate(lengths):
        start = 0
        while n - start >= length:
            place(doc, start, length, own)
            own += 1
            start += length
        if n > start:
            rest.append((n - start, doc, start))
    rest.sort(key=lambda r: (-r[0], r[1]))
    heap = [(cost[s], s) for s in range(own, len(room))]
    heapq.heapify(heap)
    for n, doc, start in rest:
        passed = []
        while heap:
            entry = heapq.heappop(heap)
            if room[entry[1]] >= n:
                break
            passed.append(entry)
        else:
            entry = None
        if entry is not None:
            place(doc, start, n, entry[1])
            if room[entry[1]]:
                heapq.heappush(heap, (cost[entry[1]], entry[1]))
        else:  # passed holds all sequences with room, cheapest first: cut the piece over them
            while n:
                seq = passed[0][1]
                take = min(n, room[seq])
                place(doc, start, take, seq)
                n, start = n - take, start + take
                if not room[seq]:
                    passed.pop(0)
                else:
                    passed[0] = (cost[seq], seq)
        for entry in passed:
            heapq.heappush(heap, entry)
    return pieces, full, cost


def pack_documents(
    docs: DataFrame,
    tokenizer: tuple[str, str, str],
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per piece (see SCHEMA); ``tokenizer`` is (json path, ranks path, split pattern) on every executor.

    sequence_id is unique over the result: the task's number, then its
    sequences in order.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_pieces(*tokenizer).ids
        sequence = TaskContext.get().partitionId() << 40
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        held = 0

        def block() -> Iterator[pa.RecordBatch]:
            pieces, full, cost = pack([len(t) for t in tokens], length, linear, quadratic)
            for i in range(0, len(pieces), 10_000):
                part = pieces[i : i + 10_000]
                doc, start, n, seq, offset = (list(c) for c in zip(*part, strict=True))
                crc = [zlib.crc32(tokens[d][s : s + k].astype("<u4").tobytes()) for d, s, k in zip(doc, start, n, strict=True)]
                columns = (
                    [ids[d] for d in doc], start, n, crc, [len(tokens[d]) for d in doc],
                    [sequence + s for s in seq], offset, [full[s] for s in seq],
                )
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in columns), pa.array([cost[s] for s in seq])],
                    names=[c.split()[0] for c in SCHEMA.split(", ")],
                )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                tokens.append(np.append(encode(text or ""), np.uint32(end_id)))
                held += len(tokens[-1])
                if held >= block_tokens:
                    yield from block()
                    sequence += len(capacities(held, length))
                    ids, tokens, held = [], [], 0
        if ids:
            yield from block()

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return texts.mapInArrow(rows, SCHEMA)
