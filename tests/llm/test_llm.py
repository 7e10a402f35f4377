"""The training-data operators on small tables that hold every defined edge case, against brute force."""

from __future__ import annotations

import hashlib
import math
import struct
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from brute import SF, brute_components, brute_exact, brute_hits, word_set
from pyspark.sql import functions as F

from fleetlens.llm import (
    chat_format,
    components,
    decontaminate,
    exact_dedup,
    language_id,
    lm_score,
    near_dedup,
    packing,
    queries,
    secret_scan,
    sharding,
    token_counts,
)
from fleetlens.llm.common import ARROW_ROWS, Workspace, crc_fold

SCHEMA = "doc_id long, text string, lang string, source string, kept string, component_id string, norm string"


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{k}" for k in rng.integers(0, 5000, n))


def edge_rows():
    """NULLs, empty and blank texts, a very long text, ties, exact and near copies, repeated rows, clashing columns."""
    base = prose(1, 200)
    near = base.replace(" w", " v", 1)
    shared = prose(2, 60)
    texts = [
        None, "", "  \t\n", "one", "ONE", "o ne", base, base, base.upper(), near, near + "  ", base.replace(" ", "\n"),
        prose(3, 30_000), shared, prose(4, 40) + " " + shared, "1234 5678", "été 中文 \U0001f600 x", base + " tail one two",
    ]
    rows = [(i, t, None if i == 3 else "en", "src", "x", "y", "z") for i, t in enumerate(texts)]
    return rows + [rows[6], (None, base, "en", None, None, None, None), (None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- near and exact deduplication ----------------------------------------------------------


def test_near_duplicates_equal_brute_force(spark, edge):
    got = near_dedup.near_duplicates(edge).collect()
    assert len(got) == len(edge_rows())
    want = brute_components([(r[0], r[1]) for r in edge_rows()])
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    sizes = {r[0]: len(word_set(r[1])) for r in edge_rows() if r[0] is not None}
    assert all(r.n_shingles == sizes[r.doc_id] for r in got if r.doc_id is not None)


def test_near_duplicates_of_a_group_of_changed_copies(spark):
    """Copies changed in different places, and a chain whose ends are not linked, over several rounds."""
    words = prose(7, 160).split()
    rows = [(0, " ".join(words))]
    for i in range(1, 60):
        changed = list(words)
        for k in range(1 + i % 4):
            changed[(i * 7 + k * 31) % 160] = f"x{i}y{k}"
        rows.append((i, " ".join(changed)))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows)


def test_pruning_bound_is_the_beta_posterior():
    batches = (64, 512, 2048)
    for n, least in zip(batches, near_dedup.least_agreements(batches, 0.9, 1e-6), strict=True):
        grid = (np.arange(400_000) + 0.5) / 400_000
        for m, kept in ((least, True), (least - 1, False)):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            weight = np.exp(log - log.max())
            assert (weight[grid >= 0.9].sum() / weight.sum() >= 1e-6) == kept


def test_a_text_travels_as_bucket_keys(spark):
    """Eight bytes a band, no MinHash value; bands that agree in all values, and no others, share a key."""
    df = spark.createDataFrame([(1, prose(1, 300)), (2, prose(1, 290)), (3, None)], "doc_id long, text string")
    for bands, width in ((24, 8), (32, 6)):
        got = {r.doc_id: r.asDict() for r in near_dedup._sketch(df, 5, bands).collect()}
        assert list(got[1]) == ["doc_id", "n_shingles", "class_hash", "buckets"] and got[3]["buckets"] is None
        values = [near_dedup.minhash(near_dedup.shingles(prose(1, n)), near_dedup.HASHES).reshape(bands, width) for n in (300, 290)]
        equal = (values[0] == values[1]).all(axis=1).tolist()
        assert [a == b for a, b in zip(got[1]["buckets"], got[2]["buckets"], strict=True)] == equal and any(equal)
        assert len(set(got[1]["buckets"])) == bands


def test_sketches_agree_as_their_sets_do(spark):
    """Bits agree with chance (1 + similarity) / 2; pairs at the threshold pass, those well below do not."""
    rng = np.random.default_rng(8)
    rows = []
    for similarity in [0.8] * 60 + [0.85] * 60 + [0.6] * 60:
        shared = round(400 * similarity)
        ids = rng.integers(0, 1 << 63, 400, np.int64).astype(np.uint64)
        own = (400 - shared) // 2
        a, b = np.sort(ids[: shared + own]), np.sort(np.r_[ids[:shared], ids[shared + own :]])
        rows.append((similarity, near_dedup.sketch(a).tolist(), near_dedup.sketch(b).tolist()))
    bits = [(s, np.mean([bin((x ^ y) & (2**64 - 1)).count("0") - 1 + 64 - len(bin((x ^ y) & (2**64 - 1))[2:]) for x, y in zip(a, b, strict=True)]) / 64) for s, a, b in rows]
    for s in (0.6, 0.8, 0.85):
        assert abs(np.mean([agree for t, agree in bits if t == s]) - (1 + s) / 2) < 0.01
    frame = spark.createDataFrame(rows, "s double, a array<long>, b array<long>")
    passed = frame.where(near_dedup.alike(F.col("a"), F.col("b"), 0.8, 1e-6)).groupBy("s").count()
    assert {r.s: r["count"] for r in passed.collect()} == {0.8: 60, 0.85: 60}


def test_rows_of_one_doc_id_have_one_component(spark):
    x, y, z = prose(20, 60), prose(21, 60), prose(22, 60)
    rows = [(1, x), (5, x), (5, y), (7, y), (9, z), (8, z), (8, ""), (30, None), (30, "a b"), (None, y), (4, "c d"), (4, "c d")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near_dedup.near_duplicates(frame).collect()
    found = {(r.doc_id, r.component_id) for r in got}
    assert found == {(1, 1), (5, 1), (7, 1), (9, 8), (8, 8), (30, 30), (None, None), (4, 4)}
    assert len(got) == len(rows) and all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("block", [components.BLOCK_EDGES, 5])
def test_components_of_chains_and_stars(spark, block):
    """Also in blocks of five edges, where rounds between tasks have to do the rest."""
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (3, 4)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    rows = components.components(df, Workspace(spark, "test"), block=block).collect()
    assert len(rows) == 101
    assert {r.node: r.component for r in rows} == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert components.components(df.limit(0), Workspace(spark, "test"), block=block).count() == 0


def test_smallest_reachable_of_random_graphs():
    rng = np.random.default_rng(5)
    for _ in range(50):
        u, v = rng.integers(0, 60, (2, 40))
        least = {int(x): int(x) for x in (*u, *v)}
        for _ in least:
            for a, b in zip(u.tolist(), v.tolist(), strict=True):
                least[a] = least[b] = min(least[a], least[b])
        got = components.smallest_reachable(u, v)
        assert dict(zip(*(x.tolist() for x in got), strict=True)) == least


@pytest.mark.parametrize("narrow", [False, True])
def test_exact_groups_equal_brute_force(spark, edge, narrow):
    """With a fingerprint of few values different texts collide, and the byte check keeps them apart."""
    fingerprint = F.length("norm").cast("long") % 3 if narrow else None
    got = exact_dedup.exact_groups(edge, fingerprint=fingerprint).collect()
    want = brute_exact([(r[0], r[1]) for r in edge_rows()])
    by_sha = {hashlib.sha256(n.encode()).hexdigest(): v for n, v in want.items()}
    assert len(got) == len(edge_rows())
    for r in got:
        keep, size = by_sha[r.text_sha256]
        assert (r.keep_id, r.group_size, r.kept) == (keep, size, r.doc_id == keep)


def test_counting_filters_merge_without_loss():
    rng = np.random.default_rng(5)
    parts = [rng.integers(0, 300, 500).astype(np.uint64) * np.uint64(0x0123456789ABCDEF) for _ in range(4)]
    decoded = []
    for p in parts:
        found, n = np.unique(p, return_counts=True)
        for row in exact_dedup._encode(found, n.astype(np.uint64), 2):
            decoded.append(exact_dedup._decode(*row, 2))
    fingerprints, counts = exact_dedup._merge(decoded)
    assert dict(zip(fingerprints.tolist(), counts.tolist(), strict=True)) == Counter(np.concatenate(parts).tolist())


# --- decontamination -----------------------------------------------------------------------


@pytest.mark.parametrize("block", [1 << 25, 900])
def test_contamination_equals_brute_force(spark, edge, block):
    items = [
        (1, prose(2, 60)), (2, prose(1, 200)), (3, "one"), (4, None), (5, "--"), (None, "été 中文"), (10, prose(9, 50)),
        (1, prose(4, 40)),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(edge, bench, block_bytes=block).collect()
    want = brute_hits([(r[0], r[1]) for r in edge_rows()], items)
    key = lambda x: (str(x[0]), *map(str, x[1:]))
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=key) == sorted(want, key=key)
    assert all(r.n_hit == sum(s.b - s.a for s in r.spans) or block == 900 for r in got)


def test_phrase_and_proximity_search(spark):
    rows = [(1, "a b c a b"), (2, "b a x x c"), (3, None), (4, "c c a q q q q b")]
    index = decontaminate.build_index(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    block = decontaminate.Phrases({2: decontaminate.word_hashes([b"a", b"b"]).reshape(1, 2)}, {2: [["i"]]})
    found = {(r.doc_id, r.word) for r in decontaminate.find_phrases(index, block).collect()}
    assert found == {(1, 0), (1, 3)}
    near = decontaminate.find_near(index, {"q": ["a", "b", "c"]}, 5).collect()
    assert {(r.doc_id, r.word, r.words) for r in near} == {(1, 0, 3), (1, 1, 3), (1, 2, 3), (2, 0, 5)}


# --- chat formatting -----------------------------------------------------------------------


def test_chat_round_trip_budget_and_masks(spark):
    said = "\\### Assistant: </turn> ok"
    odd = [said, "<turn>\\\\</turn>", "\\", "\n</turn>\n", "", None, "é中\U0001f600" * 40, "end\\"]
    rows = [(1, 0, "system", "be <turn> kind\\")]
    rows += [(1, i + 1, "assistant" if i % 2 else "user", odd[i % len(odd)]) for i in range(60)]
    rows += [(2, 0, "assistant", "x" * 9000), (2, 0, "assistant", "x" * 9000), (2, None, "ro\\le\n<", said)]
    rows += [(None, 5, None, None), (-7, 0, "user", said), (-7, 1, "assistant", said)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    out = chat_format.windows(df, budget=200, history=40)
    got = {r.conv_id: r for r in chat_format.digests(out).collect()}
    convs = {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((c, t, role, text))
    assert got.keys() == convs.keys()
    for c, turns in convs.items():
        turns = [(r[2] or "", r[3] or "") for r in sorted(turns, key=order)]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    windows = out.collect()
    assert all(w.tokens <= 200 or (w.n_new == 1 and w.over_budget) for w in windows)
    mine = sorted((w for w in windows if w.conv_id == 1), key=lambda w: w.window)
    assert len(mine) > 3 and all(w.formatted.startswith("<turn>system\n") for w in mine)
    assert any(w.n_repeated > 1 for w in mine)
    assert chat_format.digests(chat_format.windows(df.limit(0))).count() == 0


# --- packing -------------------------------------------------------------------------------


def test_packing_covers_every_token_once(spark, edge):
    from tokenizers import Tokenizer

    rows = edge_rows() + [(90, "a <|endoftext|> b", None, None, None, None, None), (91, " lead  two\n\nx ", None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in rows:
        ids = np.array([*full.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        want[(r[0], len(ids), zlib.crc32(ids.tobytes()))] += 1
    got = packing.pack_documents(df, queries.tokenizer_files(), block_tokens=9000).collect()
    assert sum(p.length for p in got) == sum(n * k for (_, n, _), k in want.items())
    whole = Counter((p.doc_id, p.doc_tokens, p.ids_crc32) for p in got if p.length == p.doc_tokens)
    assert not whole - want
    by = {}
    for p in got:
        by.setdefault(p.sequence_id, []).append(p)
    for pieces in by.values():
        pieces.sort(key=lambda p: p.offset)
        at = 0
        for p in pieces:
            assert p.offset == at
            at += p.length
        assert at == pieces[0].capacity <= 2048 and (at == 2048 or at & (at - 1) == 0)


def test_word_pieces_equal_the_tokenizer(docs):
    pieces = packing.word_pieces(*queries.tokenizer_files())
    for r in docs.select("text").collect():
        assert pieces.ids(r.text).tolist() == pieces.full.encode(r.text, add_special_tokens=False).ids


def test_pack_balances_cost():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 900, 4000).tolist()
    _, full, cost = packing.pack(lengths)
    even = [c for c, n in zip(cost, full, strict=True) if n == 2048]
    assert max(even) <= 1.25 * (sum(even) / len(even))


# --- language model ------------------------------------------------------------------------


def test_lm_counts_base_and_held_out_gain(spark, docs):
    rows = docs.select("doc_id", "text").collect() + [(5000, None), (5001, ""), (None, "the of and")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = lm_score.score_documents(df, crc_fold(F.col("doc_id"), 5) != 1, head=2000, steps=8).collect()
    tokens = lambda t: [*(t or "").encode().lower().split(), b" "]
    name = lambda i: "" if i is None else str(i)
    seen = Counter()
    for i, t in rows:
        if zlib.crc32(name(i).encode()) % 5 != 1:
            seen.update(tokens(t))
    n, v = sum(seen.values()), len(seen)
    texts = {i: t for i, t in rows}
    gain = 0.0
    for r in got:
        own = tokens(texts[r.doc_id])
        base = sum(math.log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(w in seen for w in own), n)
        assert r.held_out == (zlib.crc32(name(r.doc_id).encode()) % 5 == 1)
        assert r.base_score == pytest.approx(base, abs=1e-6)
        gain += (r.score - r.base_score) * r.held_out
    assert gain > 0


def test_lm_probabilities_add_up(spark, docs):
    """Over all known words and the one unseen word, P(. | history) is 1."""
    work = Workspace(spark, "test")
    counts = work.save(lm_score.count_words(docs.select("text")), "counts")
    vocabulary, least = lm_score._head(counts, 500)
    encoded = work.save(lm_score.encode(docs, vocabulary, "doc_id", "text", F.lit(True)), "encoded")
    v = (model := lm_score.train(encoded, vocabulary, work, steps=2)).vocabulary
    inside = np.bincount(v.classes, v.counts, minlength=lm_score.CLASSES) / np.maximum(v.class_tokens, 1)
    tail = [r.n for r in counts.where(F.col("n") < least).collect()]
    assert (len(tail), sum(tail)) == (v.tail_types, v.tail_tokens)
    u = v.unseen_share()
    inside[lm_score.TAIL] = u + (1 - u) * sum((c + 0.5) / (v.tail_tokens + 0.5 * v.tail_types) for c in tail)
    used = v.class_tokens > 0
    assert inside[used] == pytest.approx(1.0)
    p = 10.0 ** model.log_classes(np.array([0, 77, 4000]))
    used[lm_score.TAIL] = True
    assert p[:, used].sum(axis=1) == pytest.approx(1.0)


def test_lm_every_word_has_followers_of_its_own(spark):
    """400 rare words, alike but for the word after them: each tells it, held in memory or joined, as brute force does."""
    train = [f"u{i} alpha u{i + 1} beta" for i in range(0, 400, 2)] * 3
    train.append((" ".join(f"more{i}" for i in range(lm_score.CONTEXTS)) + " ") * 10)  # takes the frequent words' context ids
    asked = [f"u{i} {after}" for after in ("alpha", "beta") for i in range(400)] + ["new alpha", "new beta", "", None]
    rows = [(n, t) for n, t in enumerate(train + asked)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    learn = F.col("doc_id") < len(train)
    found = []
    for own_words in (1 << 16, 300, 0):
        got = lm_score.score_documents(df, learn, steps=8, own_words=own_words).collect()
        found.append(np.array([r.score for r in sorted(got, key=lambda r: r.doc_id)]))
        alpha, beta = found[-1][len(train) :][:800].reshape(2, 400)
        assert (alpha - beta)[::2].min() > (alpha - beta)[1::2].max()
    assert found[1] == pytest.approx(found[0], abs=1e-4) and found[2] == pytest.approx(found[0], abs=1e-4)

    # the same by loops: Q of the trained weights, f of every previous word, words' shares of their classes
    work = Workspace(spark, "test")
    counts = work.save(lm_score.count_words(df.where(learn).select("text")), "counts")
    vocabulary, _ = lm_score._head(counts, lm_score.HEAD)
    encoded = work.save(lm_score.encode(df, vocabulary, "doc_id", "text", learn), "encoded")
    model = lm_score.train(encoded, vocabulary, work, steps=8)
    v = model.vocabulary
    met, expected = defaultdict(lambda: np.zeros(lm_score.CLASSES)), defaultdict(lambda: np.zeros(lm_score.CLASSES))
    words = lambda t: [*(t or "").split(), " "]
    texts = [(t, v.history(v.find(lm_score.token_hashes(t)))) for _, t in rows]
    q = 10.0 ** model.log_classes(np.arange(lm_score.CONTEXTS * lm_score.CLASSES))
    for t, (classes, histories) in texts[: len(train)]:
        for before, c, h in zip([" ", *words(t)], classes, histories, strict=False):
            met[before][c] += 1
            expected[before] += q[h]
    for n, (t, (classes, histories)) in enumerate(texts):
        total = 0.0
        ids = v.find(lm_score.token_hashes(t))
        for before, c, h, i in zip([" ", *words(t)], classes, histories, ids, strict=False):
            p = q[h] * (met[before] + lm_score.PRIOR) / (expected[before] + lm_score.PRIOR)
            share = v.counts[i] / v.class_tokens[c] if i >= 0 else v.unseen_share()
            total += math.log10(p[c] / p.sum() * share)
        assert found[0][n] == pytest.approx(total, abs=1e-4)


# --- token counts, sharding, language, secrets ------------------------------------------------


def test_rollup_commits_once_and_takes_back(spark, edge, empty):
    root = Workspace(spark, "test").path("rollup")
    rollup = token_counts.Rollup(spark, root)
    assert rollup.totals().count() == 0
    old = token_counts.counted(edge, "spaced-1")
    new = token_counts.counted(edge, "letters-2")
    assert rollup.commit("a", token_counts.inserts(old))
    assert not rollup.commit("a", token_counts.inserts(old))
    first = sorted(rollup.totals().collect(), key=str)
    assert sum(r.documents for r in first) == len(edge_rows())
    rollup.compact("1")
    assert not rollup.commit("a", token_counts.inserts(old))
    assert sorted(rollup.totals().collect(), key=str) == first
    rollup.commit("none", token_counts.inserts(token_counts.counted(empty, "spaced-1")))
    rollup.commit("b", token_counts.revisions(old, new))
    assert {r.tokenizer for r in rollup.totals().collect()} == {"letters-2"}
    rollup.commit("c", token_counts.deletes(new))
    assert rollup.totals().count() == 0


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & (2**64 - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 16, 1000])
def test_jump_hash_equals_the_published_loop(spark, shards):
    seeds = [0, 1, -1, 2**63 - 1, -(2**63), *range(-50, 200), *(i * 0x5851F42D4C957F2D % 2**63 for i in range(200))]
    df = spark.createDataFrame([(s,) for s in seeds], "k long").select("k", sharding.jump(F.col("k"), shards).alias("to"))
    for r in df.collect():
        assert (r.to.shard, r.to.grown) == (jump(r.k % 2**64, shards), jump(r.k % 2**64, shards + 1))


def test_shards_and_slots(edge):
    got = sharding.shard(edge, 4).collect()
    assert len(got) == len(edge_rows())
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    for r in got:
        if r.doc_id is not None:
            assert r.shard == jump(xxhash.xxh64_intdigest(struct.pack("<q", r.doc_id), seed=42), 4)
    texts = {r[0]: r[1] or "" for r in edge_rows() if r[0] is not None}
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 for r in got if r.doc_id is not None)
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in got if r.doc_id is not None)


def test_language_held_out_accuracy_and_edges(spark, docs, edge, empty):
    held = crc_fold(F.col("doc_id"), 4) == 2
    model = language_id.train(docs.where(~held))
    right = language_id.identify(docs.where(held), model).select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] > 0.97
    found = language_id.identify(edge, model).collect()
    assert len(found) == len(edge_rows())
    for r in found:
        assert (r.lang_pred == "und") == (not r.text or not any(c.isalpha() for c in r.text))
        assert 0.0 <= r.score <= 1.0
    nothing = language_id.train(empty)
    assert {r.lang_pred for r in language_id.identify(edge, nothing).collect()} == {"und"}


def test_repeated_fingerprints_take_one_python_worker_a_task(spark, monkeypatch):
    plans = []
    save = Workspace.save

    def watch(self, df, name):
        if name == "repeated":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return save(self, df, name)

    monkeypatch.setattr(Workspace, "save", watch)
    texts = [(1, "a b"), (2, "ab"), (3, None), (4, ""), (5, "c"), (5, "c")]
    found = exact_dedup.exact_groups(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in found) == [
        (1, 1, 2), (2, 1, 2), (3, 3, 2), (4, 3, 2), (5, 5, 2), (5, 5, 2)
    ]
    merged_where = plans[0].split("Exchange")[0]
    assert merged_where.count("FlatMapGroupsInPandas") == 1 and "MapInArrow" not in merged_where


def test_language_training_needs_only_small_batches_and_no_workers_of_another_kind(spark, monkeypatch):
    docs = spark.createDataFrame([("the cat sat on the mat", "en"), ("die katze lag dort", "de")], "text string, lang string")
    docs = docs.localCheckpoint()  # made of Python rows, and only this one may be

    def refuse(*_, **__):
        raise AssertionError("rows of Python objects")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refuse)
    for step in (lambda: language_id.train(docs), lambda: language_id.predict(docs, language_id.train(docs.limit(0)))):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
        step()
        assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == str(ARROW_ROWS)
    assert set(language_id.train(docs).languages) == {"de", "en"}


def test_language_counts_are_whole_and_bounded_in_memory():
    rng = np.random.default_rng(3)
    texts = ["".join(chr(c) for c in rng.integers(0x4E00, 0x4E00 + 20, 6000)) for _ in range(400)]
    batches = [pa.record_batch([pa.array(["zh"] * 40), pa.array(texts[i : i + 40])], names=["lang", "text"]) for i in range(0, 400, 40)]
    expected = Counter(int(g) for t in texts for g in np.unique(language_id.gram_hashes(t)).view(np.int64))
    tracemalloc.start()
    found = Counter()
    for batch in language_id._count_grams(iter(batches)):
        for gram, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            found[gram] += n
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(expected.values()) > 1 << 20 and found == expected
    assert peak < 32 << 20


def test_filter_returns_all_languages_of_a_gram(spark):
    rows = [("aaa abc", "x")] * 3 + [("aaa xyz", "y")] * 3
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"))
    masks = model.lookup(np.unique(language_id.gram_hashes("aaa")))
    assert (masks[0] == 3).all()
    assert set(model.lookup(language_id.gram_hashes("abc"))[0].tolist()) < {1 << model.languages.index("x"), 3}


def test_secrets_are_found_and_decoys_are_not(spark, edge, empty):
    rows = []
    for i in range(120):
        secret = hashlib.sha1(str(i).encode()).hexdigest()
        rows.append((2 * i, f'{prose(i, 8)} token = "{secret}" {prose(i + 1, 5)}', "conf/app.env"))
        rows.append((2 * i + 1, f"call 4{i:03d}-0000-1111-2222 or user{i}.name@mail{i % 9}.example.com v1.2.{i}.20240101", "a/readme.md"))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    found = secret_scan.scan(df)
    hits = found.where("is_secret").select("doc_id").distinct().collect()
    assert {r.doc_id for r in hits} == {2 * i for i in range(120)}
    texts = {r.doc_id: r.text for r in secret_scan.redact(df, found).collect()}
    assert len(texts) == len(rows) and all("[secret]" in texts[2 * i] for i in range(120))
    assert texts[1] == rows[1][1]
    assert secret_scan.scan(empty).count() == 0
    assert secret_scan.scan(edge).count() >= 0


def test_secrets_without_digits_and_short_ones_are_found(spark):
    rng = np.random.default_rng(5)
    letters = lambda n: "".join(chr(65 + k) for k in rng.integers(0, 26, n))
    rows, secrets = [], {}
    for i in range(60):
        short = letters(6).lower() + ("&3" if i % 2 else "")
        for text, secret in (
            (f"{prose(i, 8)} AKIA{{}} {prose(i + 1, 5)}", letters(16)),
            (f'{prose(i, 8)} password = "{{}}"### {prose(i + 1, 5)}', letters(4) + letters(12).lower()),
            (f'{prose(i, 8)} pwd="{{}}" {prose(i + 1, 5)}', short),
            (f"{prose(i, 8)} the considerations of neighbourhoods were extraordinarily unfortunate {prose(i + 1, 5)}", None),
            (f"{prose(i, 8)} call 4{i:03d}-0000-1111-2222 {prose(i + 1, 5)}", None),
        ):
            secrets[len(rows)] = secret
            rows.append((len(rows), text.format(secret), "conf/app.env"))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    found = secret_scan.scan(df)
    hits = {r.doc_id: r.candidate for r in found.where("is_secret").select("doc_id", "candidate").collect()}
    assert {i: c.removeprefix("AKIA") for i, c in hits.items()} == {i: s for i, s in secrets.items() if s}
    for r in secret_scan.redact(df, found).collect():
        assert (secrets[r.doc_id] not in r.text) if secrets[r.doc_id] else (r.text == rows[r.doc_id][1])


def test_every_operator_takes_an_empty_table(spark, empty):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert near_dedup.near_duplicates(empty).count() == 0
    assert exact_dedup.exact_groups(empty).count() == 0
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(empty, bench.limit(0)).count() == 0
    assert packing.pack_documents(empty, queries.tokenizer_files()).count() == 0
    assert lm_score.score_documents(empty, F.lit(True), steps=1).count() == 0
    assert sharding.shard(empty).count() == 0
