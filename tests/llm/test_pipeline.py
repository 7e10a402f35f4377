"""The pipeline's stages against brute-force versions, on the smallest tables."""

from __future__ import annotations

from brute import SF, brute_components, brute_exact, brute_hits, word_set

from fleetlens.llm import packing, queries


def test_pipeline_keeps_what_brute_force_keeps(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    staged = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        staged = stage(spark, staged, SF)
        assert staged.columns == columns, name
    rows = [(r.doc_id, r.text) for r in docs.collect()]  # all of them are prose of the four languages
    keepers = {keep for keep, _ in brute_exact(rows).values()}
    rows = [r for r in rows if r[0] in keepers]
    near = brute_components(rows, corpus_pipeline.NEAR_LINK)
    rows = [r for r in rows if near[r[0]] == r[0]]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {doc for doc, _, n_hit, _ in brute_hits(rows, items) if not n_hit}
    assert {r.doc_id for r in staged.select("doc_id").collect()} == clean
    pieces = corpus_pipeline.run(spark, SF).collect()
    encode = packing.word_pieces(*queries.tokenizer_files()).ids
    texts = dict(rows)
    assert {p.doc_id for p in pieces} == clean
    assert sum(p.length for p in pieces) == sum(len(encode(texts[d])) + 1 for d in clean)


def test_language_stage_rejects_only_what_is_no_prose(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = spark.createDataFrame(
        [(-1, None, None, None, 0), (-2, "123 456", "en", "s", 7), (-3, "zqxj qzxk", None, "s", 9)], docs.schema
    )
    kept = corpus_pipeline.language_stage(spark, docs.unionByName(junk), SF)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert ids == {r.doc_id for r in docs.select("doc_id").collect()}


def test_near_stage_drops_pairs_from_080_on(spark):
    """Pairs of similarity 0.79 to 0.85: of those from 0.80 on one document stays, banding missing none of them."""
    import corpus_pipeline

    rows, want = [], set()
    for k in range(300):
        words = [f"a{k}x{i}" for i in range(104)]
        # 104 words are 100 shingles; every cut at the end takes one of them away
        left = len(words) - 15 - k % 7
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:left]))]
        a, b = word_set(rows[-2][1]), word_set(rows[-1][1])
        want |= {2 * k} | ({2 * k + 1} if 100 * len(a & b) < 80 * len(a | b) else set())
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.doc_id for r in corpus_pipeline.near_stage(spark, docs, SF).collect()} == want


# --- rows that stages must not confuse ------------------------------------------------------

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, decided string, key string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", 1, "r", "d", "k") for i, t in rows], SCHEMA).repartition(3)


def kept(df):
    assert df.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_exact_stage_judges_rows(spark):
    import corpus_pipeline

    rows = [
        (1, "a b"), (2, "a b"), (2, "only here"), (9, "same"), (9, "same"), (None, "twin"), (None, "twin"), (5, None), (4, ""),
        (6, "x" * 100_000), (3, "x " * 100_000),
    ]
    got = kept(corpus_pipeline.exact_stage(spark, frame(spark, rows), SF))
    want = [(1, "a b"), (2, "only here"), (9, "same"), (None, "twin"), (4, ""), (3, "x " * 100_000)]
    assert got == sorted(want, key=str)
    assert kept(corpus_pipeline.exact_stage(spark, frame(spark, []), SF)) == []


def test_near_stage_judges_rows(spark):
    import corpus_pipeline

    base = [f"w{i}" for i in range(60)]
    near = " ".join([*base[:-2], "tail", "end"])
    base = " ".join(base)
    rows = [
        (7, base), (3, near), (3, "a text of its own that is nobody else's"), (None, base), (5, None), (4, ""), (None, ""),
        (8, "c d"), (8, "c d"), (2, " ".join(f"v{i}" for i in range(30_000))),
    ]
    got = kept(corpus_pipeline.near_stage(spark, frame(spark, rows), SF))
    want = [(None, base), rows[2], (5, None), (4, ""), (None, ""), (8, "c d"), rows[-1]]  # NULL ids are smallest
    assert got == sorted(want, key=str)
    assert kept(corpus_pipeline.near_stage(spark, frame(spark, []), SF)) == []


def test_decontamination_stage_judges_rows(spark):
    import corpus_pipeline

    passage = next(
        r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect() if len(r.text.split()) > 12
    )
    rows = [(1, "before " + passage + " after"), (1, "clean"), (None, passage), (None, None), (2, ""), (3, "long " * 40_000)]
    got = kept(corpus_pipeline.decontamination_stage(spark, frame(spark, rows), SF))
    assert got == sorted([(1, "clean"), (None, None), (2, ""), rows[-1]], key=str)
    assert kept(corpus_pipeline.decontamination_stage(spark, frame(spark, []), SF)) == []


def test_language_and_packing_stages_on_edge_rows(spark):
    import corpus_pipeline

    prose = spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null").limit(40).collect()
    rows = [(r.doc_id, r.text, r.lang, "s", 1, "r", "d", "k") for r in prose]
    odd = [(None, prose[0].text, "en"), (-1, None, "en"), (-2, "", None), (-3, "12 34", "en"), (-1, prose[1].text * 50, None)]
    rows += [(i, t, lang, "s", 1, "r", "d", "k") for i, t, lang in odd]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    stay = kept(corpus_pipeline.language_stage(spark, docs, SF))
    assert stay == sorted([(r[0], r[1]) for r in rows if r[1] and r[1] != "12 34"], key=str)
    pieces = corpus_pipeline.packing_stage(spark, docs, SF).collect()
    encode = packing.word_pieces(*queries.tokenizer_files()).ids
    assert sum(p.length for p in pieces) == sum(len(encode(r[1] or "")) + 1 for r in rows)
    assert corpus_pipeline.packing_stage(spark, docs.limit(0), SF).collect() == []
    assert kept(corpus_pipeline.language_stage(spark, docs.limit(0), SF)) == []


def test_rows_of_files_are_numbered_without_a_copy(spark, scratch):
    import corpus_pipeline

    frame(spark, [(i % 3, f"text {i}") for i in range(50)]).write.parquet(f"{scratch}/docs")
    docs = spark.read.parquet(f"{scratch}/docs")
    keyed, key = corpus_pipeline._keyed(spark, docs)
    assert key == "row_" and keyed.columns == [*docs.columns, key]
    first = {r[key]: r.text for r in keyed.collect()}
    assert len(first) == 50
    assert {r[key]: r.text for r in keyed.select("text", key).repartition(5).collect()} == first
    assert any(f.startswith(f"file:{scratch}") or f.startswith(f"file://{scratch}") for f in keyed.inputFiles())
