"""Quality rules as a ledger of measurements and failure bits.

Every text is read once.  The ledger keeps what was measured and one bit per failed
rule; a policy is a named set of rules, so a new policy, or the question what a rule
alone would cost, needs the ledger only and never the texts.

Defined results: a null or empty text has no words, all measurements are 0, and only
the rule on too few words fails; repeated rows give repeated ledger rows; an empty table
gives an empty ledger, and ablations of zeros.  A text without a toxicity score does not
fail the rule on it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm import toxicity
from keelson.llm.frames import named, tidy
from keelson.llm.wordstream import Piece, lowered, mix, pieces, run_hashes, window_hashes

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_letters", "n_upper", "n_shouted", "n_insults")
#: Text that is measured at a time: its arrays are many times as large.
MEASURED_BYTES = toxicity.COUNTED_BYTES
#: Words of a repeated window.
WINDOW = 8
#: Words of abuse, counted without case and outer punctuation.
INSULTS = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")

#: Name and condition of each rule; its place is its bit.  Add at the end, never reorder.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
    ("few_letters", "2 * n_letters < word_chars"),
    ("capitals", "100 * n_upper > 40 * n_letters AND n_upper > 0"),
    ("exclamations", "100 * n_shouted > 20 * n_words"),
    ("insults", "n_insults >= 2"),
)
#: The rule on a measured score, whose bit follows those of ``RULES``; only with a model is it measured.
TOXIC = ("toxic", f"toxicity >= {toxicity.THRESHOLD}")
_FORM = ("few_words", "repeated_words", "symbols", "repeated_lines", "short_words", "long_words",
         "few_letters", "capitals", "exclamations")
#: Name and version of each policy: the rules whose failure rejects a document.  Versions
#: stay as they are, so that a stored ledger can be judged again as it was; a bare name
#: means the latest.  From its second version on, ``full`` leaves abuse to a fitted model
#: and no longer rejects by a list of words.
POLICIES: dict[tuple[str, int], tuple[str, ...]] = {
    ("base", 1): ("few_words", "repeated_words"),
    ("form", 1): _FORM,
    ("full", 1): (*_FORM, "insults"),
    ("full", 2): _FORM,
}


def bit(rule: str) -> int:
    return 1 << [name for name, _ in (*RULES, TOXIC)].index(rule)


def rules_of(policy: str) -> tuple[str, ...]:
    """The rules of a policy, ``name`` or ``name@version``."""
    name, _, version = policy.partition("@")
    versions = [v for n, v in POLICIES if n == name]
    if not versions or (version and int(version) not in versions):
        raise ValueError(f"no policy {policy!r}; there are {', '.join(f'{n}@{v}' for n, v in POLICIES)}")
    return POLICIES[name, int(version) if version else max(versions)]


def mask(policy: str) -> int:
    return sum(map(bit, rules_of(policy)))


def _table(*codes) -> np.ndarray:
    out = np.zeros(256, bool)
    for code in codes:
        out[code] = True
    return out


_SYMBOL = _table([ord(c) for c in "#*$%&|<>"])
_CAPITAL = _table(slice(65, 91))
_LETTER = _table(slice(65, 91), slice(97, 123), slice(0xC3, 0xF5))  # first bytes from U+00C0 on count as letters
_LATIN_CAPITAL = _table(slice(0x80, 0x97), slice(0x98, 0x9F))  # after 0xC3: U+00C0 to U+00DE but for the times sign
_SOLID = _table(slice(48, 58), slice(65, 91), slice(97, 123), slice(0x80, 256))


def _per_text(piece: Piece, hits: np.ndarray) -> np.ndarray:
    """How many places of ``hits`` (in order) lie in each text."""
    return np.diff(np.searchsorted(hits, piece.text_at))


def _insults(piece: Piece) -> np.ndarray:
    """Words that are an insult once outer punctuation is taken off."""
    lengths = {len(w) for w in INSULTS}
    first_bytes = _table([ord(w[0]) for w in INSULTS], [ord(w[0]) - 32 for w in INSULTS])
    solid = np.flatnonzero(_SOLID[piece.data])
    left = np.searchsorted(solid, piece.starts)
    right = np.searchsorted(solid, piece.ends)
    some = np.flatnonzero(right > left)
    begin, end = solid[left[some]], solid[right[some] - 1] + 1
    fit = first_bytes[piece.data[begin]] & np.isin(end - begin, list(lengths))
    some, begin, end = some[fit], begin[fit], end[fit]
    known = [run_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)]))[0] for w in INSULTS]
    return some[np.isin(run_hashes(lowered(piece.data), begin, end), np.array(known, np.uint64))]


def _repeated_words(piece: Piece) -> np.ndarray:
    """Per text, the words in windows found twice or more in the text."""
    windows = window_hashes(piece.word_hashes(), WINDOW)
    at = np.flatnonzero(piece.whole_windows(WINDOW)[:len(windows)])
    text = piece.text_of_word()[at]
    keys = mix(windows[at] + mix(text.astype(np.uint64) + np.uint64(1)))
    _, group, count = np.unique(keys, return_inverse=True, return_counts=True)
    hit = at[count[group] > 1]
    change = np.zeros(len(piece.starts) + 1, np.int64)
    change[hit] += 1
    change[hit + WINDOW] -= 1
    marked = np.concatenate([[0], np.cumsum(np.cumsum(change[:-1]) > 0)])
    return marked[piece.first[1:]] - marked[piece.first[:-1]]


def _lines(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Per text, the lines with a word, and those among them equal to an earlier one."""
    breaks = np.flatnonzero(piece.data == 10)
    begin = np.union1d(piece.text_at[:-1][np.diff(piece.text_at) > 0], breaks + 1)
    begin = begin[begin < len(piece.data)]
    end = np.append(begin[1:], len(piece.data))
    end = end - (piece.data[end - 1] == 10)
    full = np.searchsorted(piece.starts, end) > np.searchsorted(piece.starts, begin)
    begin, end = begin[full], end[full]
    text = np.searchsorted(piece.text_at, begin, "right") - 1
    keys = mix(run_hashes(piece.data, begin, end) + mix(text.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(keys, return_index=True)
    lines = np.bincount(text, minlength=piece.n_texts)
    return lines, lines - np.bincount(text[first], minlength=piece.n_texts)


def measure_piece(piece: Piece) -> dict[str, np.ndarray]:
    data = piece.data
    chars = (data & 0xC0) != 0x80
    chars_upto = np.concatenate([[0], np.cumsum(chars)])
    word_chars = np.concatenate([[0], np.cumsum(chars_upto[piece.ends] - chars_upto[piece.starts])])
    after_c3 = np.zeros(len(data), bool)
    after_c3[1:] = data[:-1] == 0xC3
    lines, repeated = _lines(piece)
    shouted = piece.starts[data[piece.ends - 1] == ord("!")]
    return {
        "n_words": piece.n_words,
        "word_chars": word_chars[piece.first[1:]] - word_chars[piece.first[:-1]],
        "n_symbols": _per_text(piece, np.flatnonzero(_SYMBOL[data])),
        "n_lines": lines,
        "n_dup_lines": repeated,
        "n_repeat_words": _repeated_words(piece),
        "n_letters": _per_text(piece, np.flatnonzero(_LETTER[data])),
        "n_upper": _per_text(piece, np.flatnonzero(_CAPITAL[data] | (after_c3 & _LATIN_CAPITAL[data]))),
        "n_shouted": _per_text(piece, shouted),
        "n_insults": _per_text(piece, piece.starts[_insults(piece)]),
    }


def _measure(batches, model: toxicity.Model | None = None):
    """Measures the last column; the others go along.  With a model the one before it names the language."""
    kinds = {m: pa.int64() for m in MEASURES} | ({} if model is None else {"toxicity": pa.float64()})
    for batch in batches:
        carried = batch.columns[:-1]
        for piece in pieces(batch.columns[-1], MEASURED_BYTES):
            found = measure_piece(piece)
            if model is not None:
                langs = carried[-1].slice(piece.row, piece.n_texts).to_pylist()
                found["toxicity"] = toxicity.scores_of(piece, langs, model)
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(piece.row, piece.n_texts) for c in carried),
                 *(pa.array(found[m], kind, from_pandas=True) for m, kind in kinds.items())],
                names=[*batch.schema.names[:-1], *kinds])


def _ledger(rows: DataFrame, model: toxicity.Model | None = None) -> DataFrame:
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    kinds += [f"{m} long" for m in MEASURES] + ([] if model is None else ["toxicity double"])
    measured = rows.mapInArrow(tidy(lambda batches: _measure(batches, model)), ", ".join(kinds))
    rules = RULES if model is None else (*RULES, TOXIC)
    bits = [F.when(F.expr(rule), F.lit(1 << k).cast("long")).otherwise(0) for k, (_, rule) in enumerate(rules)]
    failed = bits[0]
    for one in bits[1:]:
        failed = failed.bitwiseOR(one)
    return measured.withColumn("failed", failed)


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text", model: toxicity.Model | None = None,
           lang: str = "lang") -> DataFrame:
    """``key``, all measurements, and ``failed``: a bit for each rule that fails.

    With a model also ``lang`` and ``toxicity``, null where the language has no model.
    """
    wanted = {"key": key} | ({} if model is None else {"lang": lang}) | {"text": text}
    return _ledger(docs.select(*named(**wanted)), model)


def passing(docs: DataFrame, policy: str = "full", text: str = "text", model: toxicity.Model | None = None,
            lang: str = "lang") -> DataFrame:
    """The rows of ``docs``, whole, whose text passes a policy, and with a model is not toxic; nothing is shuffled."""
    inside = {f"carried_{k}": c for k, c in enumerate(docs.columns)}
    used = [] if model is None else [F.col(f"`{lang}`").alias("used_lang")]
    rows = docs.select(*named(**inside), *used, F.col(f"`{text}`").alias("text"))
    kept = accepted(policy)
    if model is not None:
        kept = kept & (F.col("failed").bitwiseAND(F.lit(bit("toxic"))) == 0)
    return _ledger(rows, model).filter(kept).select(*(F.col(k).alias(c) for k, c in inside.items()))


def accepted(policy: str) -> Column:
    """Whether a ledger row passes all rules of a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy))) == 0


def sole_failure(policy: str) -> Column:
    """The rule that alone rejects a ledger row: without it, the policy would accept the row."""
    own, out = F.col("failed").bitwiseAND(F.lit(mask(policy))), F.lit(None).cast("string")
    for rule in rules_of(policy):
        out = F.when(own == bit(rule), rule).otherwise(out)
    return out


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: documents that fail it, and those that only it rejects.

    One aggregate over the ledger; without the rule, ``only_here`` more documents stay.
    """
    own = F.col("failed").bitwiseAND(F.lit(mask(policy)))
    sums = [F.sum((own.bitwiseAND(F.lit(bit(r))) != 0).cast("long")).alias(f"{r}_all") for r in rules_of(policy)]
    sums += [F.sum((own == bit(r)).cast("long")).alias(f"{r}_only") for r in rules_of(policy)]
    return rows.agg(*sums).select(F.explode(F.array(*(
        F.struct(F.lit(r).alias("rule"), F.coalesce(F.col(f"{r}_all"), F.lit(0)).alias("failing"),
                 F.coalesce(F.col(f"{r}_only"), F.lit(0)).alias("only_here")) for r in rules_of(policy)))).alias("x")
    ).select("x.*")
