"""A toxicity score per language, fitted from labelled texts.

A text is described by how often its words begin with certain bytes: of each word, without
case of A-Z and outer punctuation, the first 4, 5, 6 and 8 bytes and the whole.  For
each language the beginnings that tell labelled toxic texts from the others best are
kept, and a logistic curve over the logarithms of their counts and of the number of words
gives the score.  Nothing is known beforehand of any language or word.

The sample is bounded: of each language and label about ``SAMPLE`` texts, drawn by a hash
of the key.  Their counts are added up by Spark; the driver sees the kept beginnings and
one short row for each text of the sample.

Defined results: a language with fewer than ``LEAST_TEXTS`` labelled texts of either kind,
or without telling beginnings, has no model; its texts, and those without a language,
have a null score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.frames import named, small_side, tidy
from keelson.llm.wordstream import Piece, lowered, mix, pieces, run_hashes
from keelson.session import materialize

#: Texts of a language and label that are drawn, and those needed for a model.
SAMPLE, LEAST_TEXTS = 2000, 20
#: Beginnings kept for a language, and how many deviations their shares lie apart at least.
KEPT, LEAST_Z = 100, 4.0
#: Bytes of a word's beginning; the last stands for the whole word.
LENGTHS = (4, 5, 6, 8, 1 << 20)
#: Text whose beginnings are counted at a time.
COUNTED_BYTES = 256 << 10
#: From this score on a text counts as toxic.
THRESHOLD = 0.5

_SOLID = np.zeros(256, bool)
for _part in (slice(48, 58), slice(65, 91), slice(97, 123), slice(0x80, 256)):
    _SOLID[_part] = True


@dataclass
class Model:
    """``languages``: ascending hashes of beginnings, and weights of them, the length and a constant."""

    languages: dict[str, tuple[np.ndarray, np.ndarray]]


def beginnings(piece: Piece):
    """``text, hash`` of the words' beginnings, one length after the other."""
    solid = np.flatnonzero(_SOLID[piece.data])
    left, right = np.searchsorted(solid, piece.starts), np.searchsorted(solid, piece.ends)
    some = np.flatnonzero(right > left)
    begin, end = solid[left[some]], solid[right[some] - 1] + 1
    text, data = piece.text_of_word()[some], lowered(piece.data)
    for k, length in enumerate(LENGTHS):
        whole = k == len(LENGTHS) - 1
        at = np.arange(len(some)) if whole else np.flatnonzero(end - begin >= length)
        yield text[at], mix(run_hashes(data, begin[at], np.minimum(end, begin + length)[at]) + np.uint64(k + 1))


def counted(piece: Piece, known: np.ndarray) -> np.ndarray:
    """How often each of the ascending ``known`` beginnings stands in each text."""
    out = np.zeros((piece.n_texts, len(known)))
    for text, hashes in beginnings(piece):
        place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        hit = known[place] == hashes
        np.add.at(out, (text[hit], place[hit]), 1)
    return out


def _values(counts: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    return np.column_stack([np.log1p(counts), np.log1p(n_words), np.ones(len(n_words))])


def _present(batches):
    """``lang, toxic, hash`` of each distinct beginning of a text."""
    for batch in batches:
        for piece in pieces(batch.column("text"), COUNTED_BYTES):
            for text, hashes in beginnings(piece):
                order = np.lexsort((hashes, text))
                text, hashes = text[order], hashes[order]
                new = np.ones(len(text), bool)
                new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
                rows = pa.array(text[new] + piece.row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang").take(rows), batch.column("toxic").take(rows), pa.array(hashes[new].view(np.int64))],
                    names=["lang", "toxic", "hash"])


def _weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps; all but the constant are drawn to zero."""
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], 1.0)
    ridge[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``lang, toxic, text`` of the drawn labelled texts."""
    keys = docs.select("doc_id", "lang").join(
        labels.filter("toxic IS NOT NULL").select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic")).distinct().hint("merge"), "doc_id")
    keys = materialize(keys.filter("lang IS NOT NULL AND doc_id IS NOT NULL"), "labelled")
    sizes = keys.groupBy("lang", "toxic").agg(F.count("*").alias("size"))
    drawn = keys.join(F.broadcast(sizes), ["lang", "toxic"]).filter(
        F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) * F.col("size") < F.lit(SAMPLE * 1_000_003))
    return docs.select("doc_id", "text").filter("text IS NOT NULL").join(
        small_side(drawn.select("doc_id", "lang", "toxic").distinct()), "doc_id").select("lang", "toxic", "text")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model for each language with enough labelled texts."""
    texts = materialize(sample(docs.select(*named(doc_id="doc_id", lang="lang", text="text")), labels), "toxicity-sample")
    sizes: dict[str, dict[int, int]] = {}
    for lang, toxic, n in texts.groupBy("lang", "toxic").count().collect():
        sizes.setdefault(lang, {})[toxic] = n
    sizes = {k: v for k, v in sizes.items() if min(v.get(0, 0), v.get(1, 0)) >= LEAST_TEXTS}
    if not sizes:
        return Model({})
    counts = texts.mapInArrow(tidy(_present), "lang string, toxic int, hash long").groupBy("lang", "hash").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    many = F.broadcast(texts.sparkSession.createDataFrame([(k, v[1], v[0]) for k, v in sizes.items()], "lang string, p long, n long"))
    share = (F.col("a") + F.col("b")) / (F.col("p") + F.col("n"))
    apart = (F.col("a") / F.col("p") - F.col("b") / F.col("n")) / F.sqrt(share * (1 - share) * (1 / F.col("p") + 1 / F.col("n")))
    told = counts.filter("a >= 3").join(many, "lang").select("lang", "hash", apart.alias("z")).filter(F.col("z") >= LEAST_Z)
    best: dict[str, np.ndarray] = {}
    for lang in sizes:
        rows = told.filter(F.col("lang") == lang).orderBy(F.desc("z"), "hash").limit(KEPT).collect()
        if rows:
            best[lang] = np.sort(np.array([r["hash"] for r in rows], np.int64).view(np.uint64))

    def described(batches):
        for batch in batches:
            for piece in pieces(batch.column("text"), COUNTED_BYTES):
                langs = batch.column("lang").slice(piece.row, piece.n_texts).to_pylist()
                kinds = batch.column("toxic").slice(piece.row, piece.n_texts)
                out = [None] * piece.n_texts
                for lang in set(langs) & best.keys():
                    values = _values(counted(piece, best[lang]), piece.n_words)
                    for k in range(piece.n_texts):
                        if langs[k] == lang:
                            out[k] = values[k].tolist()
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), kinds, pa.array(out, pa.list_(pa.float64()))],
                                                 names=["lang", "toxic", "x"])
    rows = texts.mapInArrow(tidy(described), "lang string, toxic int, x array<double>").filter("x IS NOT NULL").collect()
    languages = {}
    for lang, known in best.items():
        own = [r for r in rows if r["lang"] == lang]
        languages[lang] = (known, _weights(np.array([r["x"] for r in own]), np.array([r["toxic"] for r in own], float)))
    return Model(languages)


def scores_of(piece: Piece, langs: list[str | None], model: Model) -> np.ndarray:
    """The score of each text, NaN where its language has no model."""
    out = np.full(piece.n_texts, np.nan)
    if not model.languages:
        return out
    langs = np.array([x if x is not None else "" for x in langs], object)
    known = np.unique(np.concatenate([k for k, _ in model.languages.values()]))
    counts = counted(piece, known)
    for lang, (kept, weights) in model.languages.items():
        own = np.flatnonzero(langs == lang)
        values = _values(counts[np.ix_(own, np.searchsorted(known, kept))], piece.n_words[own])
        out[own] = 1 / (1 + np.exp(-np.clip(values @ weights, -30, 30)))
    return out
