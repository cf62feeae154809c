"""Backoff scores against counting by hand."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from keelson.llm import lm_scores

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, order, cutoff=1):
    texts = [WORD.findall((t or "").translate(LOWER)) for _, t in rows]
    counts = [None] + [Counter(tuple(w[k:k + n]) for w in texts for k in range(len(w) - n + 1)) for n in range(1, order + 1)]
    total = sum(counts[1].values())

    def score(w, k, n):
        if n == 1:
            return math.log(counts[1][(w[k],)] / total)
        if k < n - 1:
            return score(w, k, n - 1)
        gram = tuple(w[k - n + 1:k + 1])
        if counts[n][gram] >= cutoff:
            return math.log(counts[n][gram] / counts[n - 1][gram[:-1]])
        return math.log(0.4) + score(w, k, n - 1)
    return [(key, len(w), sum(score(w, k, order) for k in range(len(w)))) for (key, _), w in zip(rows, texts, strict=True)]


@pytest.mark.parametrize(("order", "ngrams", "cutoff"), [
    (3, 2_000_000, 1), (3, 500, 1), (1, 500, 1), (2, 500, 1), (4, 3000, 1), (3, 3000, 2), (4, 3000, 3)])
def test_equals_brute_force(rows_of, prose, order, ngrams, cutoff, monkeypatch):
    """Two texts of 30,000 words are among the rows."""
    monkeypatch.setattr(lm_scores, "PART_NGRAMS", ngrams)
    rows = prose
    found = sorted(((r["key"], r["n_words"], r["log_score"])
                    for r in lm_scores.scores(rows_of(rows), order, cutoff=cutoff).collect()), key=repr)
    want = sorted(brute_force(rows, order, cutoff), key=repr)
    assert [f[:2] for f in found] == [w[:2] for w in want]
    by_key = lambda rows: sorted((str(k), round(s, 6)) for k, _, s in rows)
    assert by_key(found) == by_key(want)


def test_no_words(rows_of):
    found = lm_scores.scores(rows_of([(1, None), (2, " ")])).collect()
    assert sorted(map(tuple, found)) == [(1, 0, 0.0, None), (2, 0, 0.0, None)]
    assert lm_scores.scores(rows_of([])).count() == 0


@pytest.mark.parametrize("n", [0, 1, 100, 50_000])
@pytest.mark.parametrize("kind", [np.uint32, np.int32, np.uint64])
def test_packed_arrays_come_back(n, kind):
    values = np.minimum(np.random.default_rng(n).zipf(2.0, n), 2**31 - 1).astype(kind)
    assert np.array_equal(lm_scores.unpacked(lm_scores.packed(values), kind), values)


def test_packed_counts_take_less_than_the_shuffle_makes_of_them():
    counts = np.minimum(np.random.default_rng(4).zipf(2.0, 100_000), 2**31 - 1).astype(np.uint32)
    planes = np.ascontiguousarray(counts.view(np.uint8).reshape(-1, 4).T).tobytes()
    shuffled = pa.compress(lm_scores.packed(counts), codec="lz4", asbytes=True)
    assert len(shuffled) < 0.7 * len(pa.compress(planes, codec="lz4", asbytes=True))
