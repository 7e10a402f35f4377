"""Fill-in-middle transformation by in-place block rotation.

A text is cut at two line ends into prefix, middle and suffix.  Its UTF-8 bytes
are laid out once in a bytearray, each part behind its sentinel,

    <P>prefix <M>middle <S>suffix

and the wanted order is one rotation away: psm exchanges the blocks of middle
and suffix, spm moves the block of the suffix before the other two.  A rotation
is three reversals in place (either block, then both), so besides the array
itself only two fixed-size buffers are held however long the text is.  The
inverse finds the sentinels, rotates back by the same three reversals and
deletes them, which gives the exact text again.

Lines, cuts and forms depend on the text, the id and the seed only, so a
retried task writes the same rows.

Defined cases: NULL is the empty text, and empty texts stay plain.  A text that
holds a sentinel stays plain, as its cuts could not be read back.  A NULL id
hashes as the empty string.  Rows that repeat an id are cut alike when their
texts are equal.  Other columns are not read, so they can have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fleetlens.llm.common import ARROW_ROWS

SEED = 7
RATE = 100  # of 100 texts so many are transformed
SPM_RATE = 50  # of 100 transformed texts so many put the suffix first
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
CHUNK = 1 << 16  # bytes exchanged at a time
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def reverse(array: np.ndarray, start: int, end: int) -> None:
    """Reverse array[start:end] in place, a chunk from either end at a time."""
    while end - start > 1:
        half = min(CHUNK, (end - start) // 2)
        left = array[start : start + half][::-1].copy()
        array[start : start + half] = array[end - half : end][::-1]
        array[end - half : end] = left
        start, end = start + half, end - half


def rotate(array: np.ndarray, start: int, middle: int, end: int) -> None:
    """Exchange the blocks array[start:middle] and array[middle:end] in place by three reversals."""
    reverse(array, start, middle)
    reverse(array, middle, end)
    reverse(array, start, end)


def line_ends(text: bytes) -> np.ndarray:
    """Byte positions after 0, 1, ... all lines of the text."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x0A) + 1
    last = ends[-1] if len(ends) else 0
    return np.concatenate([[0], ends, [len(text)] if last < len(text) else []]).astype(np.int64)


def code_points(text: np.ndarray) -> int:
    return int(np.count_nonzero((text & 0xC0) != 0x80))


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers below 2^32 that only the seed and the id decide."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(4)]


def forward(text: bytes, doc_id: int | None, seed: int, rate: int, spm_rate: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    ends = line_ends(text)
    n = len(ends) - 1
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate:
        return n, PLAIN, None, None, text
    first, second = (int(ends[i]) for i in sorted((h1 % (n + 1), h2 % (n + 1))))
    buffer = bytearray(text)
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):  # from the right: earlier cuts keep their place
        buffer[at:at] = sentinel
    array = np.frombuffer(buffer, np.uint8)
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    prefix_chars = code_points(array[len(PREFIX) : middle])
    middle_chars = code_points(array[middle + len(MIDDLE) : suffix])
    form = SPM if h4 % 100 < spm_rate else PSM
    rotate(array, 0 if form == SPM else middle, suffix, len(array))
    return n, form, prefix_chars, middle_chars, bytes(buffer)


def inverse(output: bytes, form: str) -> bytes:
    """The text that ``forward`` turned into ``output``."""
    if form == PLAIN:
        return output
    buffer = bytearray(output)
    prefix, suffix, middle = (buffer.index(s) for s in (PREFIX, SUFFIX, MIDDLE))
    array = np.frombuffer(buffer, np.uint8)
    if form == SPM:  # suffix, prefix, middle
        rotate(array, 0, prefix, len(array))
        first, second = middle - prefix, len(array) - prefix
    else:  # prefix, suffix, middle
        rotate(array, suffix, middle, len(array))
        first, second = suffix, suffix + len(array) - middle
    del array  # the bytearray can be cut again
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        if buffer[at : at + len(sentinel)] != sentinel:
            raise ValueError("not an output of this transformation")
        del buffer[at : at + len(sentinel)]
    return bytes(buffer)


def _bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 of a string column, NULL as nothing."""
    return (b"" if b is None else b for b in column.cast(pa.binary()).to_pylist())


def transform(
    docs: DataFrame,
    seed: int = SEED,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (lines), form, prefix_chars, middle_chars, output (see SCHEMA)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            done = [forward(t, i, seed, rate, spm_rate) for i, t in zip(ids, _bytes(batch.column(1)), strict=True)]
            n, form, prefix, middle, output = zip(*done, strict=True) if done else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.binary()).cast(pa.string()),
                ],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return texts.mapInArrow(rows, SCHEMA)


def restore(outputs: DataFrame, form_col: str = "form", output_col: str = "output") -> DataFrame:
    """``outputs`` with the column ``restored``: each row's text, from its form and output alone."""
    if "restored" in outputs.columns:
        raise ValueError("the frame has a column named restored")
    at = [outputs.columns.index(c) for c in (form_col, output_col)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms, texts = batch.column(at[0]).to_pylist(), _bytes(batch.column(at[1]))
            back = [inverse(t, f) for f, t in zip(forms, texts, strict=True)]
            yield batch.append_column("restored", pa.array(back, pa.binary()).cast(pa.string()))

    return outputs.mapInArrow(rows, StructType([*outputs.schema.fields, StructField("restored", StringType())]))
