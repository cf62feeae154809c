"""The pipeline against its operators' brute force, on a small table."""

import importlib

import pytest

corpus_pipeline = importlib.import_module("corpus_pipeline")


@pytest.fixture
def folder(spark, tmp_path, prose):
    rows = [(k, t, "en", "s", len(t or "")) for k, t in prose]
    rows.append((900, "Words before it. " + "where did the old man who lived by the sea keep the boat that he built himself " + "and then some more words follow", "en", "s", 1))
    rows = [(*r, "x", None, 7) for r in rows]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, "
                                "n_words long, component_id long").repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "where did the old man who lived by the sea keep the boat that he built himself")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages(spark, folder):
    from tests.llm import test_jaccard, test_quality, test_substrings
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "repeated_passages", "decontamination", "tokens"]

    passed = stages["quality_rules"](spark, docs, folder)
    assert passed.columns == columns
    rows = [(r.doc_id, r.text) for r in passed.collect()]
    assert rows
    assert all(test_quality.measured(t)[0] >= 20 for _, t in rows)

    one = stages["near_duplicates"](spark, passed, folder)
    assert one.columns == columns
    want = {least for _, _, least in test_jaccard.brute_force(rows, 5, 80)}
    kept = sorted(r.doc_id for r in one.filter("doc_id is not null").collect())
    assert kept == sorted(want)

    rows = [(r.doc_id, r.text) for r in one.collect()]
    cut = stages["repeated_passages"](spark, one, folder)
    assert cut.columns == columns
    want = sorted(((k, t) for k, _, _, t in test_substrings.brute_force(rows, 35)), key=repr)
    assert sorted(((r.doc_id, r.text) for r in cut.collect()), key=repr) == want
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    clean = stages["decontamination"](spark, cut, folder)
    assert clean.columns == columns
    assert {r.doc_id for r in cut.collect()} - {r.doc_id for r in clean.collect()} == {900}

    tokens = stages["tokens"](spark, clean, folder)
    assert tokens.count() == clean.count()
    assert corpus_pipeline.run(spark, folder).exceptAll(tokens).isEmpty()


def test_near_duplicates_by_five_words(spark):
    from tests.llm import test_jaccard
    words = [f"w{k}" for k in range(106)]
    changed = list(words)
    changed[50] = changed[70] = "new"
    cut = words[:86]  # 82 of 102 runs of five words, 83 of 103 of four
    rows = [(1, " ".join(words)), (2, " ".join(cut)), (3, " ".join(changed)), (4, " ".join(words[60:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "").collect()}
    assert kept == {least for _, _, least in test_jaccard.brute_force(rows, 5, 80)} == {1, 4}
    assert {least for _, _, least in test_jaccard.brute_force(rows, 4, 85)} == {1, 2, 4}
