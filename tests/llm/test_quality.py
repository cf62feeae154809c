"""The ledger against brute force, and policies over it."""

import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keelson.llm import frames, quality, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    covered = {j for k in range(len(w) - 7) if seen[tuple(w[k:k + 8])] > 1 for j in range(k, k + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_measurements(rows_of, prose):
    rows = [*prose, (700, "x y\nx y\n x y\n\n\n#a <b>"), (701, "one two three four five six seven eight " * 4)]
    found = quality.ledger(rows_of(rows)).select("key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(((k, *measured(t)) for k, t in rows), key=repr)


def test_policies_and_ablations(rows_of):
    plain = "the river ran past a mill and over the weir into a wide green valley where sheep grazed all day long"
    rows = [(1, plain), (2, plain.upper()), (3, " ".join(f"{w}###" for w in plain.split())), (4, "too short"), (5, None),
            (6, plain + " you stupid idiot"), (7, " ".join(f"{w}!" for w in plain.upper().split()))]
    ledger = quality.ledger(rows_of(rows)).cache()
    kept = {f"{n}@{v}": {r.key for r in ledger.filter(quality.accepted(f"{n}@{v}")).collect()} for n, v in quality.POLICIES}
    assert kept == {"base@1": {1, 2, 3, 6, 7}, "form@1": {1, 6}, "full@1": {1}, "full@2": {1, 6}}
    assert quality.mask("full") == quality.mask("full@2")
    with pytest.raises(ValueError, match="no policy"):
        quality.mask("full@3")
    sole = {r.key: r.sole for r in ledger.select("key", quality.sole_failure("full@1").alias("sole")).collect()}
    assert sole == {1: None, 2: "capitals", 3: "symbols", 4: "few_words", 5: "few_words", 6: "insults", 7: None}
    found = {r.rule: (r.failing, r.only_here) for r in quality.ablations(ledger, "full@1").collect()}
    assert {r: n for r, (_, n) in found.items() if n} == {k: list(sole.values()).count(k) for k in {*sole.values()} - {None}}
    assert found["few_words"] == (2, 2)
    assert found["capitals"] == (2, 1)
    assert found["exclamations"] == (1, 0)
    assert found["insults"] == (1, 1)


def test_passing_keeps_whole_rows(rows_of, prose):
    docs = rows_of(prose)
    kept = quality.passing(docs, "base")
    assert kept.schema == docs.schema
    want = [(k, t) for k, t in prose if measured(t)[0] >= 20 and 100 * measured(t)[4] <= 30 * measured(t)[0]]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(rows_of):
    assert quality.ledger(rows_of([])).count() == 0
    assert quality.ablations(quality.ledger(rows_of([])), "full").agg(F.sum("failing")).first()[0] == 0


def test_measuring_needs_little_memory():
    """Arrays over the words are many times as large as the text, so little of it is measured at a time."""
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 10**6, 1000)) for _ in range(500)]
    known = np.sort(rng.integers(0, 2**63, 100).astype(np.uint64))
    model = toxicity.Model({"en": (known, np.zeros(102))})
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 500), pa.array([1] * 500, pa.int32()), pa.array(texts)], names=["lang", "toxic", "text"])
    for run in (lambda: quality._measure([batch.select(["lang", "text"])], model), lambda: toxicity._present([batch])):
        tracemalloc.start()
        for _ in run():
            pass
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 40 << 20, peak


def test_memory_goes_back_when_a_task_ends(monkeypatch):
    given = []
    monkeypatch.setattr(frames, "give_back", lambda: given.append(1))
    assert list(frames.tidy(lambda batches: (2 * b for b in batches))(iter([1, 2]))) == [2, 4]
    left = frames.tidy(lambda batches: (b for b in batches))(iter([1, 2]))
    next(left)
    left.close()
    assert len(given) == 2
