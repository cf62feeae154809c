"""Repeated passages against brute force."""

import re
from collections import Counter

import pytest

from keelson.llm import substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(rows, window):
    texts = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[k:k + window]) for w in texts for k in range(len(w) - window + 1))
    out = []
    for (key, _), w in zip(rows, texts, strict=True):
        gone = {j for k in range(len(w) - window + 1) if seen[tuple(w[k:k + window])] > 1 for j in range(k, k + window)}
        out.append((key, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("window", [35, 10, 3])
def test_equals_brute_force(rows_of, prose, window):
    rows = prose if window == 35 else [r for r in prose if r[0] not in (401, 402)]
    found = substrings.remove_repeats(rows_of(rows), window)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept"]
    assert order(map(tuple, found.collect())) == order(brute_force(rows, window))


def test_levels_double():
    assert substrings.levels(35) == [9, 18, 35]
    assert substrings.levels(100) == [7, 13, 25, 50, 100]


def test_empty_table(rows_of):
    assert substrings.remove_repeats(rows_of([])).count() == 0


def test_overlap_within_one_text(rows_of):
    rows = [(1, "a " * 40), (2, "a b c")]
    assert order(map(tuple, substrings.remove_repeats(rows_of(rows), 35).collect())) == order(brute_force(rows, 35))
