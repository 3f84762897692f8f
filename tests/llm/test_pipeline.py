"""The pipeline on the awkward corpus: any column names, nulls, empty and long texts, repeated rows, an empty table."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpus_fixtures import corpus

NAMES = ["_sid", "_head", "_class", "_kept", "_did", "_sign", "_copied", "_row_did", "_row_sign", "__SID", "a.b", "sid", "did", "head", "links", "row"]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    fields = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)
    data = [(i, t, lang, s, len(t or ""), *(["x"] * len(NAMES))) for i, t, lang, s in corpus()]
    spark.createDataFrame(data, fields).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], fields).write.parquet(f"{folder}/empty/documents.parquet")
    return folder


def test_stages_keep_columns_and_never_add_rows(spark, table):
    docs = spark.read.parquet(f"{table}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: set() for r in docs.select("doc_id").collect()}
    for r in docs.select("doc_id", "text").collect():
        texts[r.doc_id].add(r.text)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.keep(stage(spark, docs, table), "test-pipeline")
        assert after.columns == columns
        got = after.select("doc_id", "text", F.col("`a.b`").alias("ab")).collect()
        assert 0 < len(got) <= docs.count() and all(r.ab == "x" for r in got)
        if name != "substring_dedup":
            assert all(r.text in texts[r.doc_id] for r in got)
        docs = after
    assert {r.doc_id for r in corpus_pipeline.run(spark, table).select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_empty_table(spark, table):
    assert corpus_pipeline.run(spark, f"{table}/empty").count() == 0


def test_near_copies_and_passages_are_gone_afterwards(spark, table):
    """Brute force over what each stage was given: one text per class of similar texts, no repeated 50-word window."""
    from fleetlens.llm import jaccard, substrings

    docs = spark.read.parquet(f"{table}/documents.parquet").where("doc_id is not null")
    kept = [r.text or "" for r in jaccard.one_of_each(docs).collect()]

    def grams(t):
        w = t.encode().split()
        return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    sets = [g for g in map(grams, kept) if g]
    assert all(5 * len(a & b) < 4 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    given = {r.doc_id: (r.text or "").encode().split() for r in docs.dropDuplicates(["doc_id"]).collect()}
    seen: set = set()
    want = {}
    for i in sorted(given):
        w = given[i]
        windows = [tuple(w[k:k + 50]) for k in range(len(w) - 49)]
        gone = {p for k, x in enumerate(windows) if x in seen for p in range(k, k + 50)}
        seen |= set(windows)
        want[i] = [x for p, x in enumerate(w) if p not in gone]
    got = {r.doc_id: (r.text or "").encode().split() for r in substrings.without_redundant(docs.dropDuplicates(["doc_id"])).collect()}
    assert got == {i: w for i, w in want.items() if w or not given[i]}
