"""Toxicity fitted from labels, on held-out texts in an invented language."""

import importlib
import random

from keelson.llm import toxicity

corpus_pipeline = importlib.import_module("corpus_pipeline")
MARKS = ("grobnak", "wexlif", "tumpor")


def written(rng, toxic, n=60):
    words = ["".join(rng.choice("abdeiklmnorstu") for _ in range(rng.randint(2, 7))) for _ in range(n)]
    for _ in range(3 if toxic else 0):  # inflected forms of words no list holds
        words[rng.randrange(n)] = rng.choice(MARKS) + rng.choice(["", "en", "ix", ","])
    return " ".join(words)


def table(spark, folder, rng):
    rows = [(k, written(rng, k % 3 == 0), "xx" if k < 400 else None, "s", 1) for k in range(420)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(k, 1, int(k % 3 == 0)) for k in range(200)] + [(k, 1, None) for k in range(200, 210)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_toxic_texts_in_any_language_leave_the_pipeline(spark, tmp_path):
    docs = table(spark, str(tmp_path), random.Random(3))
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, str(tmp_path)).collect()}
    held_out = range(210, 400)
    assert sum(k % 3 == 0 and k not in kept for k in held_out) >= 0.9 * sum(k % 3 == 0 for k in held_out)
    assert sum(k % 3 != 0 and k in kept for k in held_out) >= 0.97 * sum(k % 3 != 0 for k in held_out)
    assert kept >= set(range(400, 420))


def test_no_labels_no_model(spark, tmp_path):
    docs = table(spark, str(tmp_path), random.Random(4))
    labels = spark.read.parquet(f"{tmp_path}/labels.parquet")
    assert toxicity.fit(docs, labels.limit(0)).languages == {}
    assert toxicity.fit(docs, labels.filter("toxic = 0")).languages == {}
