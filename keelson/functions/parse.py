"""Reading raw values.  A value that cannot be read becomes null, never a guess.

Each function takes and returns a ``Column``.  ``kind`` dispatch for whole
tables lives in ``keelson.operators.clean``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters stripped as blank space, boolean words, month names.
BLANKS = " \t\n\r\f\v\u00a0\u2003\u3000"
BLANK_RUN = f"[{BLANKS}]{{2,}}|[{BLANKS[1:]}]"
TRUE_WORDS = ("yes", "y", "1", "true", "t")
FALSE_WORDS = ("no", "n", "0", "false", "f")
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

ISO_DAY = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
US_DAY = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$"
NAMED_DAY = r"^([0-9]{1,2})-([a-z]{3})-([0-9]{4})$"
MARK = "\u0001"
NUMBER = r"^[+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?$"
INFINITE = r"^[+-]?(?i:inf|infinity)$"

# Shapes of values that need no rearranging, with nothing around them.  Most values of a column have one,
# and one match is then all it costs to read them; any other value takes the steps that accept it too.
PLAIN_MONEY = r"^-?[0-9]++(?:[.][0-9]++)?+\z"
PLAIN_ISO_DAY = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"
PLAIN_US_DAY = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z"
PLAIN_NAMED_DAY = r"^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}\z"
PLAIN_ZIPCODE = r"^[0-9]{5}\z"
PLAIN_WORDS = "^[!-~\u00a1-\u1fff]++(?: [!-~\u00a1-\u1fff]++)*+\\z"


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def is_missing(value: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Null, NaN, or text that holds nothing but blanks."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    if isinstance(dtype, T.StringType):
        return value.isNull() | (trimmed(value) == "")
    return value.isNull()


def blank_as_null(text: Column) -> Column:
    # A first character that is plainly no blank settles it without a trimmed copy.
    return F.when(F.ascii(text).between(33, 126) | (trimmed(text) != ""), text)


def whole_match(text: Column, pattern: str) -> Column:
    """The text if the pattern matches all of it, else empty text."""
    return F.regexp_extract(text, pattern, 0)


def money(text: Column) -> Column:
    bare = F.translate(text, "$," + BLANKS, "")
    return F.when(text.rlike(PLAIN_MONEY), text).when(bare.rlike(r"^-?[0-9]+(?:[.][0-9]+)?$"), bare).cast("double")


def boolean(text: Column) -> Column:
    meaning = F.create_map(*[
        F.lit(x) for words_, value in ((TRUE_WORDS, True), (FALSE_WORDS, False))
        for word in words_ for x in (word, value)
    ])
    return F.try_element_at(meaning, F.lower(trimmed(text)))


def day(text: Column) -> Column:
    """A date written as 2024-07-05, 07/05/2024 or 05-Jul-2024.

    The three shapes cannot be confused, so each is rearranged to year-month-day
    and read by one cast, which gives null for days the calendar does not have.
    A text with blanks around it, or of no shape at all, takes steps that each use
    the one before it once, which keeps the expression small when it is copied
    into filters.
    """
    slashed = F.concat_ws("-", F.substring_index(text, "/", -1), F.substring_index(text, "/", 1),
                          F.substring_index(F.substring_index(text, "/", 2), "/", -1))
    # No month of that name is month 0, which no calendar has.
    month = F.shiftright(F.instr(F.lit(" ".join(MONTHS)), F.lower(F.substring(text, -8, 3))) + 3, 2)
    named = F.concat_ws("-", F.substring(text, -4, 4), month.cast("string"), F.substring_index(text, "-", 1))
    plain = F.when(text.rlike(PLAIN_ISO_DAY), text).when(text.rlike(PLAIN_US_DAY), slashed).when(
        text.rlike(PLAIN_NAMED_DAY), named)
    ordered = F.regexp_replace(F.lower(trimmed(text)), US_DAY, "$3-$1-$2")
    ordered = F.regexp_replace(ordered, NAMED_DAY, f"$3-{MARK}$2-$1")
    for number_, name in enumerate(MONTHS, start=1):
        ordered = F.replace(ordered, F.lit(MARK + name), F.lit(str(number_)))
    return plain.otherwise(whole_match(ordered, ISO_DAY)).try_cast("date")


def zipcode(text: Column) -> Column:
    return F.when(text.rlike(PLAIN_ZIPCODE), text).otherwise(
        F.nullif(whole_match(trimmed(text), "^[0-9]{5}$"), F.lit("")))


def words(text: Column) -> Column:
    """Lower case, ``_`` and ``-`` as spaces, single spaces, no empty text."""
    parted = F.replace(F.replace(F.lower(text), F.lit("_"), F.lit(" ")), F.lit("-"), F.lit(" "))
    spaced = F.regexp_replace(parted, BLANK_RUN, " ")
    inner = trimmed(parted)
    return F.when(parted.rlike(PLAIN_WORDS), parted).when(inner.rlike(PLAIN_WORDS), inner).otherwise(
        F.nullif(trimmed(spaced), F.lit("")))


def number(text: Column) -> Column:
    """A plain or scientific number, else null.

    The shape is checked first because a bare cast also reads suffixed forms
    such as ``1d``.
    """
    raw = trimmed(text)
    return F.when(text.rlike(NUMBER), text).when(raw.rlike(f"{NUMBER}|{INFINITE}"), raw).try_cast("double")


def moment(text: Column) -> Column:
    """A timestamp from ISO text; offsets are converted, no offset means UTC.

    The session time zone must be UTC (see ``keelson.session``).
    """
    return trimmed(text).try_cast("timestamp")


def moment_day(text: Column) -> Column:
    return F.to_date(moment(text))


def clip(value: Column, low: float | None, high: float | None) -> Column:
    """Pulls a number into its bounds; null stays null and NaN becomes null."""
    readable = F.nanvl(value, F.lit(None).cast("double"))
    bounded = None
    for beyond, bound in ((lambda v, x: v < x, low), (lambda v, x: v > x, high)):
        if bound is not None:
            line = F.lit(float(bound))
            bounded = (F if bounded is None else bounded).when(beyond(readable, line), line)
    return readable if bounded is None else bounded.otherwise(readable)


def outside(value: Column, low: float | None, high: float | None) -> Column:
    """True where a readable number lies outside its bounds."""
    below = F.lit(False) if low is None else value < F.lit(float(low))
    above = F.lit(False) if high is None else (value > F.lit(float(high))) & ~F.isnan(value)
    return F.coalesce(below | above, F.lit(False))


def source_or_original(source: Column) -> Column:
    return F.coalesce(source, F.lit("original"))


HASH_BUCKETS = 10_000


def hash_share(key: Column) -> Column:
    """A fixed number in [0, 1) per key, the same on every run and machine."""
    head = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long")
    return (head % HASH_BUCKETS) / F.lit(float(HASH_BUCKETS))


def as_text(value: Column, dtype: T.DataType) -> Column:
    """A value the way raw data stores everything: as text, or null.

    Doubles from 1e7 up to 1e16 are written without an exponent, because
    ``money`` does not read exponents back.
    """
    if isinstance(dtype, T.BooleanType):
        return F.when(value, "True").when(~value, "False")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        double = value.cast("double")
        size = F.abs(double)
        plain = F.regexp_replace(double.try_cast("decimal(38,20)").cast("string"), "0+$", "")
        plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
        exponent = F.regexp_replace(double.cast("string"), r"[.]0E|E", "e")
        exponent = F.regexp_replace(exponent, r"e([0-9])", "e+$1")
        exponent = F.regexp_replace(exponent, r"e-([0-9])$", "e-0$1")
        needs_plain = ((size >= 1e7) & (size < 1e16)) | ((size < 1e-3) & (size >= 1e-4))
        needs_exponent = (size >= 1e16) | ((size < 1e-4) & (size > 0))
        return F.when(~F.isnan(double), F.when(needs_plain, plain)
                      .when(needs_exponent, exponent)
                      .otherwise(double.cast("string")))
    return value.cast("string")


def level(value: Column, warning: float, high: float) -> Column:
    """ok below ``warning``, high above ``high``; both lines count as warning."""
    return F.when(value > high, "high").when(value >= warning, "warning").otherwise("ok")
