"""MinHash near-deduplication with sequential Bayesian verification.

Steps, each written to the shared folder:

1. A document's set is its distinct five-word shingles (64-bit hashes).  Texts
   with equal sets form one class and go on as one representative, so copies
   cost nothing further.
2. Texts get ``HASHES`` MinHash values, cut in bands of as many values as the
   threshold allows (``banding``); each band is hashed to a bucket key where the
   values are made, and the keys alone are kept.  Only representatives that share a bucket go on.
3. A candidate's core is its set less the shingles no other candidate has.  An
   intersection is within both cores, so sizes and cores alone rule out most
   pairs of texts that were changed in different places.
4. Rounds over the buckets.  Members of a bucket are ordered by their share
   outside the core (the original of a group of changed copies comes first).
   A round takes the first members of every bucket as hubs, one at first, then
   more, pairs each with the members after it that are in other components and
   that cores and sketches allow, and lets the hubs go.  A bucket is done when
   one component is left in it.  Two members are paired only in the least
   bucket they share, so every pair of a bucket is tested once, ruled out or
   already in one component, while a group of mutual copies costs a pair per
   member.
5. A candidate's sketch is one bit of each of SKETCH further MinHash values.
   Two sketches agree in a bit with probability (1 + similarity) / 2, so with a
   uniform prior the posterior chance of a similarity of at least the threshold
   is a binomial tail.  The join that pairs members compares sketches batch by
   batch and drops a pair as soon as that chance falls below ``miss``: pairs
   that are merely alike never become rows.
6. Survivors are confirmed on their full sets; components follow from the
   confirmed links.

What banding can miss: a pair at the threshold shares no band with probability
BAND_MISS at most, less at higher similarity: (1 - 0.85**8)**24 = 0.0005 at 0.85,
(1 - 0.8**6)**32 = 0.00006 at 0.8.  The costly case is texts
that share most of their shingles pairwise and yet are not linked: they stay in
different components and the sketches of all pairs that share a bucket are compared.

Defined cases: a text with fewer words than a shingle is one shingle; NULL or
wordless texts have an empty set and are linked with nothing, not even each
other.  Rows that repeat a doc_id are one document with the union of links, and
have one component_id.
Rows with a NULL doc_id are their own component.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from fleetlens.llm.common import Workspace, small_side, space_words, word_hashes
from fleetlens.llm.components import components

WORDS = 5
LINK = (85, 100)  # linked when 100 * intersection >= 85 * union
HASHES = 192  # MinHash values, shared out to the bands
BAND_MISS = 1e-3  # chance that a pair at the threshold shares no band
SKETCH = 2048  # bits of a candidate's sketch
BATCHES = (512, 1024, 2048)  # bits compared before each decision
MISS = 1e-6  # posterior chance below which a pair is dropped
FIRST_HUBS = 1
NEXT_HUBS = 256
MORE_HUBS = 16  # from then on so many times as many each round
MAX_ROUNDS = 20
HUB_BYTES = 64 + SKETCH // 8  # width of a hub's row, and 8 for each band


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams."""
    words = space_words(text)
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    width = min(size, len(h))
    n = len(h) - width + 1
    out = np.full(n, width, np.uint64)  # shorter texts never meet full shingles
    for i in range(width):
        out = (out ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


@lru_cache(maxsize=4)
def _multipliers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    odd = rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd[:, None], rng.integers(0, 1 << 32, n, dtype=np.uint32)[:, None]


def minhash(found: np.ndarray, n: int, seed: int = 20250101) -> np.ndarray:
    """n MinHash values (32 bits) of a shingle set, computed in blocks that stay in cache."""
    mul, plus = _multipliers(n, seed)
    low = (found ^ (found >> np.uint64(32))).astype(np.uint32)
    best = np.full(n, 0xFFFFFFFF, np.uint32)
    step = max(1, 196_608 // n)
    for i in range(0, len(low), step):
        mixed = low[None, i : i + step] * mul + plus
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        np.minimum(best, mixed.min(axis=1), out=best)
    return best


def sketch(found: np.ndarray) -> np.ndarray:
    """One bit of each of SKETCH MinHash values, none of which bands use, as signed longs."""
    # values are minima, their high bits mostly zero: the lowest bit is as good as a coin
    return np.packbits(minhash(found, SKETCH, seed=20250102) & 1).view("<i8")


def banding(threshold: float) -> tuple[int, int]:
    """(bands, rows): the longest bands of HASHES values in which a pair at the threshold is missed with BAND_MISS at most."""
    for rows in range(HASHES, 0, -1):
        if HASHES % rows == 0 and (1 - threshold**rows) ** (HASHES // rows) <= BAND_MISS:
            return HASHES // rows, rows
    raise ValueError(f"{HASHES} MinHash values are too few for a threshold of {threshold}")


@lru_cache(maxsize=8)
def least_agreements(batches: tuple[int, ...], chance: float, miss: float) -> tuple[int, ...]:
    """For each n of ``batches``: the fewest agreements of n with P(chance of agreeing >= ``chance``) >= miss.

    Under a uniform prior the posterior after m of n is Beta(m + 1, n - m + 1)
    and its upper tail at t equals P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in batches:
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            ways = lgamma(n + 2) - lgamma(m + 1) - lgamma(n + 2 - m)
            tail += exp(ways + m * log(chance) + (n + 1 - m) * log(1 - chance))
        out.append(m)
    return tuple(out)


def alike(left: Column, right: Column, threshold: float, miss: float) -> Column:
    """Whether no batch of two sketches' bits decides against a similarity of ``threshold``; later batches only if needed."""
    out = F.lit(True)
    for n, least in reversed(list(zip(BATCHES, least_agreements(BATCHES, (1 + threshold) / 2, miss), strict=True))):
        # a loop over the longs, not a sum spelt out: methods of that size are not compiled by the JVM
        words = F.zip_with(F.slice(left, 1, n // 64), F.slice(right, 1, n // 64), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
        differ = F.aggregate(words, F.lit(0), lambda total, x: total + x)
        out = F.when(differ <= n - least, out).otherwise(False)
    return out


def band_keys(values: np.ndarray, n_bands: int) -> np.ndarray:
    """The bucket keys of MinHash values, as signed longs: each hashes its band's number and values."""
    bands = values.astype(np.uint64).reshape(n_bands, -1)
    keys = np.arange(1, n_bands + 1, dtype=np.uint64)
    for i in range(bands.shape[1]):
        keys = (keys ^ bands[:, i]) * np.uint64(0xD6E8FEB86659FD93)
        keys ^= keys >> np.uint64(32)
    return keys.view(np.int64)


def _sketch(texts: DataFrame, size: int, n_bands: int) -> DataFrame:
    """(doc_id, n_shingles, class_hash, buckets) of (doc_id, text); no buckets for an empty set."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, classes, buckets = [], [], []
            for text in batch.column(1).to_pylist():
                found = shingles(text, size)
                counts.append(len(found))
                classes.append(xxhash.xxh128_digest(found.tobytes()) if len(found) else None)
                buckets.append(band_keys(minhash(found, HASHES), n_bands) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(classes, pa.binary()), pa.array(buckets, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "class_hash", "buckets"],
            )

    return texts.mapInArrow(rows, "doc_id long, n_shingles long, class_hash binary, buckets array<long>")


def _candidates(texts: DataFrame, size: int) -> DataFrame:
    """(node, cls, found, sketch) of (doc_id, text)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t, size) for t in batch.column(1).to_pylist()]
            classes = [xxhash.xxh64(xxhash.xxh128_digest(f.tobytes()), seed=42).intdigest() for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.array(classes, np.uint64).view(np.int64)),  # as xxhash64 of class_hash in SQL
                    pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64())),
                    pa.array([sketch(f) for f in found], pa.list_(pa.int64())),
                ],
                names=["node", "cls", "found", "sketch"],
            )

    return texts.mapInArrow(rows, "node long, cls long, found array<long>, sketch array<long>")


def _confirm(pairs: DataFrame, link: tuple[int, int]) -> DataFrame:
    """(a, b) of the pairs whose full sets fa, fb reach the threshold."""
    num, den = link

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stay = []
            for i in range(batch.num_rows):
                a, b = (batch.column(c)[i].values.to_numpy() for c in (2, 3))
                union = len(np.union1d(a, b))
                if den * (len(a) + len(b) - union) >= num * union:
                    stay.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(stay, pa.int64())) for i in (0, 1)], names=["a", "b"])

    return pairs.select("a", "b", "fa", "fb").mapInArrow(rows, "a long, b long")


def _hubs(members: DataFrame, hubs: int) -> DataFrame:
    """The first ``hubs`` members of every bucket by (outside, node, cls).

    ``members``: (bucket, outside, node, cls, n, core, component, buckets, sketch),
    ``buckets`` being all that a member shares with others, one a band at most.  Hubs
    are found with partial results: the first of each of 64 salts, then the first
    of those, so that no group of any size is ranked in one task.
    """
    if hubs == 1:
        first = F.min(F.struct("outside", "node", "cls", "n", "core", "component", "buckets", "sketch")).alias("h")
        return members.groupBy("bucket").agg(first).select("bucket", "h.*")
    salted = members.withColumn("salt", F.pmod(F.xxhash64("cls"), F.lit(64)))
    return _smallest(_smallest(salted, ["bucket", "salt"], hubs).drop("salt"), ["bucket"], hubs)


def _hub_pairs(members: DataFrame, hubs: DataFrame, link: tuple[int, int], bands: int, miss: float) -> DataFrame:
    """Pairs (a < b) of the hubs with later members of other components, as far as sketches allow."""
    num, den = link
    hub = hubs.select(*(F.col(c).alias(f"hub_{c}") for c in members.columns))
    later = F.struct("outside", "node", "cls") > F.struct("hub_outside", "hub_node", "hub_cls")
    possible = (num + den) * F.least("core", "hub_core") >= num * (F.col("n") + F.col("hub_n"))
    least_shared = F.array_min(F.array_intersect("buckets", "hub_buckets")) == F.col("bucket")
    # the dearer a test, the later: CASE keeps this order
    wanted = F.when(
        later & (F.col("component") != F.col("hub_component")) & possible,
        F.when(least_shared, alike(F.col("sketch"), F.col("hub_sketch"), num / den, miss)).otherwise(False),
    ).otherwise(False)
    met = members.join(small_side(hub, HUB_BYTES + 8 * bands), (F.col("bucket") == F.col("hub_bucket")) & wanted)
    return met.select(F.least("node", "hub_node").alias("a"), F.greatest("node", "hub_node").alias("b"))


def _after_hubs(members: DataFrame, hubs: DataFrame) -> DataFrame:
    """The members that were no hubs: those after the last hub of their bucket."""
    last = hubs.groupBy("bucket").agg(F.max(F.struct("outside", "node", "cls")).alias("last"))
    after = members.join(small_side(last, 48), "bucket").where(F.struct("outside", "node", "cls") > F.col("last"))
    return after.drop("last")


def _smallest(members: DataFrame, keys: list[str], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("outside", "node", "cls"))
    return members.withColumn("rank", rank).where(F.col("rank") <= n).drop("rank")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = WORDS,
    link: tuple[int, int] = LINK,
    miss: float = MISS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    work = Workspace(docs.sparkSession, "near-dedup")
    num, den = link
    bands, _ = banding(num / den)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    sketches = work.save(_sketch(texts, size, bands), "sketches")
    classes = sketches.where("class_hash is not null and doc_id is not null").groupBy("class_hash")
    nodes = work.save(
        classes.agg(F.min(F.struct("doc_id", "n_shingles", "buckets")).alias("r")).select(
            "class_hash",
            F.xxhash64("class_hash").alias("cls"),
            F.col("r.doc_id").alias("node"),
            F.col("r.n_shingles").alias("n"),
            "r.buckets",
        ),
        "nodes",
    )

    # a class is once in a bucket; only (bucket, cls) travels, the rest of a class joins those that share one
    keys = nodes.select(F.explode("buckets").alias("bucket"), "cls")
    shared = keys.groupBy("bucket").agg(F.count("*").alias("classes")).where("classes > 1").select("bucket")
    shared = work.save(shared, "shared")
    sharing = work.save(keys.join(shared, "bucket").join(nodes.select("cls", "node", "n"), "cls"), "sharing")
    work.drop("shared")
    needed = small_side(work.save(sharing.select(F.col("node").alias("doc_id")).distinct(), "needed"), 16)
    candidates = work.save(_candidates(texts.join(needed, "doc_id", "left_semi"), size), "candidates")
    sketches_of = candidates.groupBy("cls").agg(F.first("sketch").alias("sketch"))  # equal sets, equal sketches
    alone = (
        candidates.select("cls", F.explode("found").alias("shingle"))
        .groupBy("shingle")
        .agg(F.min("cls").alias("cls"), F.max("cls").alias("other"))
        .where("cls = other")
        .groupBy("cls")
        .agg(F.count("*").alias("alone"))
    )
    cores = small_side(work.save(alone, "alone"), 24)
    outside = F.coalesce("alone", F.lit(0))
    shares = (
        sharing.groupBy("node", "cls", "n")
        .agg(F.collect_set("bucket").alias("buckets"))
        .join(cores, "cls", "left")
        .join(sketches_of, "cls")
        .select(
            (outside / F.col("n")).alias("outside"),
            "node",
            "cls",
            "n",
            (F.col("n") - outside).alias("core"),
            F.col("node").alias("component"),
            "buckets",
            "sketch",
        )
        .where(den * F.col("core") >= num * F.col("n"))  # else no set is near enough to it
    )
    members = work.save(shares.select(F.explode("buckets").alias("bucket"), "*"), "members-0")
    work.drop("sharing")

    sets = candidates.select("node", "found")  # as large as the texts: never broadcast
    # rows that repeat a doc_id are one document: its texts' classes are linked from the start
    repeats = (
        sketches.where("doc_id is not null").groupBy("doc_id")
        .agg(F.min("class_hash").alias("lo"), F.max("class_hash").alias("hi"), F.count("*").alias("rows"), F.count("class_hash").alias("sets"))
        .where("lo <> hi or (sets > 0 and sets < rows)").select("doc_id")
    )
    repeated = small_side(work.save(repeats, "repeats"), 16)
    of_repeated = sketches.join(repeated, "doc_id", "left_semi").join(nodes.select("class_hash", "node"), "class_hash")
    first_node = F.min("node").over(Window.partitionBy("doc_id"))  # the texts of one doc_id, without copies
    twins = work.save(of_repeated.select("doc_id", "node").distinct().select("doc_id", "node", first_node.alias("least")), "twins")
    links = twins.select(F.col("least").alias("a"), F.col("node").alias("b"))
    joined = None
    hubs = FIRST_HUBS
    for i in range(1, MAX_ROUNDS + 1):
        picked = work.save(_hubs(members, hubs), f"hubs-{i}")
        pairs = work.save(_hub_pairs(members, picked, link, bands, miss), f"pairs-{i}")
        both = pairs.join(sets.toDF("a", "fa"), "a").join(sets.toDF("b", "fb"), "b")
        found = work.save(_confirm(both, link), f"links-{i}")
        links = links.unionByName(found)
        joined = work.save(components(links, work, f"cc-{i}").toDF("node", "joined"), f"components-{i}")

        # buckets left: those whose members that were no hubs are in more than one component
        component = F.coalesce("joined", "component").alias("component")
        marked = (
            _after_hubs(members, picked)
            .join(small_side(joined, 24), "node", "left")
            .select("bucket", "outside", "node", "cls", "n", "core", component, "buckets", "sketch")
        )
        marked = work.save(marked, f"marked-{i}")
        open_ = (
            marked.groupBy("bucket")
            .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
            .where("lo <> hi")
            .select("bucket")
        )
        members = work.save(marked.join(open_, "bucket", "left_semi"), f"members-{i}")
        work.drop(f"hubs-{i}", f"pairs-{i}", f"marked-{i}", f"members-{i - 1}")
        if members.isEmpty():
            break
        hubs = NEXT_HUBS if hubs == FIRST_HUBS else hubs * MORE_HUBS
    else:
        raise RuntimeError(f"buckets were still open after {MAX_ROUNDS} rounds")

    # a document's component: of its class's representative, through the class; a repeated doc_id's empty texts have none
    of_class = nodes.join(small_side(joined, 24), "node", "left").select(
        "class_hash", F.coalesce("joined", "node").alias("component_id")
    )
    of_twin = (
        twins.groupBy("doc_id").agg(F.min("least").alias("node")).join(small_side(joined, 24), "node", "left")
        .select("doc_id", F.coalesce("joined", "node").alias("twin"))
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "twin", "doc_id"))
    return (
        sketches.select("doc_id", "n_shingles", "class_hash")
        .join(of_class, "class_hash", "left")
        .join(small_side(work.save(of_twin, "of-twin"), 24), "doc_id", "left")
        .select(
            "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
        )
    )
