"""Fill-in-middle: reversals, exact round trips, and the digests against slices of the text."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetlens.llm import fim


@given(st.binary(max_size=300), st.data())
@settings(max_examples=200, deadline=None)
def test_rotation_exchanges_blocks(data, draw):
    a, b, c = sorted(draw.draw(st.integers(0, len(data))) for _ in range(3))
    buffer = bytearray(data)
    fim.rotate(np.frombuffer(buffer, np.uint8), a, b, c)
    assert bytes(buffer) == data[:a] + data[b:c] + data[a:b] + data[c:]


def test_rotation_beyond_a_chunk():
    data = np.random.default_rng(1).integers(0, 256, 5 * fim.CHUNK + 77, np.uint8)
    turned = data.copy()
    fim.rotate(turned, 3, fim.CHUNK + 1, len(data) - 2)
    assert (turned == np.concatenate([data[:3], data[fim.CHUNK + 1 : -2], data[3 : fim.CHUNK + 1], data[-2:]])).all()


def sliced(doc_id, text, seed=7, rate=100, spm=50):
    """The contract, by slices of the text."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    form = "spm" if h4 % 100 < spm else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return n, form, len(p), len(m), out


TEXTS = [
    None, "", "\n", "a", "a\nb", "\n\n\n", "été\n中文\n\U0001f600\r\nx\n", "<P>", "x <S> y\nz", "<", "<P\n>", "a<\nM>b\n<S\n>",
    "line\n" * 50_000 + "end", "no end of line " * 9_000,
]


@given(st.integers(-5, 10**12), st.text(alphabet="ab\n<>PSMé\U0001f600", max_size=60))
@settings(max_examples=300, deadline=None)
def test_forward_equals_slices_and_inverse_restores(doc_id, text):
    *head, out = fim.forward(text.encode(), doc_id, 7, 100, 50)
    assert (*head, out.decode()) == sliced(doc_id, text)
    assert fim.inverse(out, head[1]) == text.encode()


def test_frames_equal_slices(spark):
    rows = [(i if i % 7 else None, t, "f", "o") for k in range(4) for i, t in enumerate(TEXTS, 100 * k)]
    rows += rows[:5]  # repeated rows, and columns named as those of the result
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, output string").repartition(3)
    got = fim.restore(fim.transform(docs))
    want = sorted((*map(str, (r[0], *sliced(r[0], r[1]), r[1] or "")),) for r in rows)
    assert sorted(tuple(map(str, r)) for r in got.collect()) == want
    forms = [r.form for r in fim.transform(docs, rate=0).collect()]
    assert set(forms) == {"plain"}
    assert {r.form for r in fim.transform(docs, spm_rate=0).collect()} == {"plain", "psm"}
    assert fim.restore(fim.transform(docs.limit(0))).collect() == []
    with pytest.raises(ValueError):
        fim.restore(got)
