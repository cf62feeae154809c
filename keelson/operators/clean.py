"""Column-wise cleaning.  These steps never drop a row, so batch training,
batch scoring and stream scoring can all share them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import parse
from keelson.spec import FEEDBACK, MOMENT_COLUMN, NUMBER_KINDS, SOURCE_COLUMN, TableSpec


def read_as(kind: str, value: Column, dtype: T.DataType) -> Column:
    """The expression that reads one column of the given kind.

    Text goes through the parsers; columns that already have a type are only
    converted.
    """
    is_text = isinstance(dtype, T.StringType)
    if kind == "money":
        if isinstance(dtype, T.BooleanType):
            return F.lit(None).cast("double")
        return parse.money(value) if is_text else value.cast("double")
    if kind == "boolean":
        if isinstance(dtype, T.BooleanType):
            return value
        if is_text:
            return parse.boolean(value)
        return F.when(value == 1, True).when(value == 0, False)
    if kind == "date":
        return parse.day(value) if is_text else F.to_date(value)
    if kind == "zipcode":
        if is_text:
            return parse.zipcode(value)
        if isinstance(dtype, T.BooleanType):
            return F.lit(None).cast("string")
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            value = F.when(value == F.floor(value), value).try_cast("bigint")
        return parse.zipcode(value.cast("string"))
    if kind == "categorical":
        return parse.words(value.cast("string"))
    if kind == "numeric":
        return parse.number(value) if is_text else value.cast("double")
    return value


def clean_table(
    df: DataFrame,
    spec: TableSpec,
    *,
    clip: bool = True,
    split_date: bool = True,
    numeric_booleans: bool = False,
) -> DataFrame:
    """Reads, clips and splits every catalog column of ``df``.

    Columns outside the catalog pass through; catalog columns that ``df`` does
    not have are skipped.  With ``split_date`` the date becomes year and month;
    ``numeric_booleans`` gives 1.0 / 0.0, the form drift statistics need.
    """
    return finish_columns(read_columns(df, spec), spec, clip=clip, split_date=split_date,
                          numeric_booleans=numeric_booleans)


def read_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Every catalog column read by the parser of its kind, nothing else changed."""
    return df.select(*[
        read_as(spec[f.name].kind, F.col(f.name), f.dataType).alias(f.name)
        if f.name in spec else F.col(f.name) for f in df.schema.fields
    ])


def finish_columns(read: DataFrame, spec: TableSpec, *, clip: bool = True,
                   split_date: bool = True, numeric_booleans: bool = False) -> DataFrame:
    """Clips and splits columns that are already read.

    A projection of its own on purpose: clipping names its input several times,
    and Spark only computes that input once if it is a column below.
    """
    columns: list[Column] = []
    for name in read.columns:
        value = F.col(name)
        if name in spec:
            column = spec[name]
            if clip and column.bounded:
                value = parse.clip(value, column.low, column.high)
            if numeric_booleans and column.kind == "boolean":
                value = value.cast("double")
            if split_date and name == spec.date_column:
                year, month = spec.date_parts
                columns += [F.year(value).alias(year), F.month(value).alias(month)]
                continue
        columns.append(value.alias(name))
    return read.select(*columns)


def clip_outliers(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Pulls bounded columns into their bounds; unreadable values become null."""
    bounded = [f for f in df.schema.fields if f.name in spec and spec[f.name].bounded]
    read = df.withColumns({
        f.name: read_as("numeric", F.col(f.name), f.dataType) for f in bounded})
    return read.withColumns({
        f.name: parse.clip(F.col(f.name), spec[f.name].low, spec[f.name].high)
        for f in bounded
    })


def date_features(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Replaces the date column by its year and month."""
    if spec.date_column not in df.columns:
        return df
    value = read_as("date", F.col(spec.date_column), df.schema[spec.date_column].dataType)
    year, month = spec.date_parts
    day = F.col(spec.date_column)
    return df.withColumn(spec.date_column, value).withColumns(
        {year: F.year(day), month: F.month(day)}).drop(spec.date_column)


def blanks_as_null(df: DataFrame) -> DataFrame:
    """Empty or blank text becomes null; other types stay."""
    return df.select(*[
        parse.blank_as_null(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def select_columns(
    df: DataFrame, columns: Sequence[str], types: dict[str, str] | None = None
) -> DataFrame:
    """Exactly these columns in this order; absent ones become null, extras go."""
    types = types or {}
    return df.select(*[
        F.col(c) if c in df.columns else F.lit(None).cast(types.get(c, "string")).alias(c)
        for c in columns
    ])


def feature_structs(cleaned: DataFrame, spec: TableSpec, task: str) -> DataFrame:
    """Cleaned features of a task as one numeric and one categorical struct."""
    numeric, categorical = spec.encoded_features(task)
    return cleaned.select(
        F.struct(*[F.col(c).cast("double").alias(c) for c in numeric]).alias("numeric"),
        F.struct(*categorical).alias("categorical"),
    )


def drop_bookkeeping(df: DataFrame) -> DataFrame:
    return df.drop(SOURCE_COLUMN, MOMENT_COLUMN)


def decode_json(df: DataFrame, text: str, columns: Iterable[str]) -> DataFrame:
    """Turns a JSON object column into text columns; absent keys become null."""
    kept = [c for c in df.columns if c != text]
    decoded = F.from_json(F.col(text), "map<string,string>")
    wide = df.select(*kept, decoded.alias("_record"))
    return wide.select(*kept, *[F.element_at("_record", F.lit(c)).alias(c) for c in columns])


def json_keys(df: DataFrame, text: str) -> DataFrame:
    """Every key the records of a JSON column carry, with how often."""
    keys = F.json_object_keys(F.col(text))
    return (
        df.select(F.explode(keys).alias("key"))
        .groupBy("key").agg(F.count(F.lit(1)).alias("n_records"))
    )


def record_source(df: DataFrame) -> Column:
    if SOURCE_COLUMN not in df.columns:
        return F.lit("original")
    return parse.source_or_original(F.col(SOURCE_COLUMN))


def event_day(df: DataFrame, spec: TableSpec) -> Column:
    """Listing day for original rows, prediction day for feedback rows."""
    return F.to_date(event_moment(df, spec))


def event_moment(df: DataFrame, spec: TableSpec) -> Column:
    """Where a row sits on the time axis, at the finest grain its source has.

    A feedback row in a table without the prediction time is an error, raised
    when such a row is met.
    """
    if spec.date_column in df.columns:
        listed = read_as("date", F.col(spec.date_column), df.schema[spec.date_column].dataType)
    else:
        listed = F.lit(None).cast("date")
    listed = listed.cast("timestamp")
    if SOURCE_COLUMN not in df.columns:
        return listed
    if MOMENT_COLUMN in df.columns:
        dtype = df.schema[MOMENT_COLUMN].dataType
        served = (
            parse.moment(F.col(MOMENT_COLUMN)) if isinstance(dtype, T.StringType)
            else F.col(MOMENT_COLUMN).cast("timestamp")
        )
    else:
        served = F.raise_error(f"feedback rows need a {MOMENT_COLUMN} column").cast("timestamp")
    return F.when(record_source(df) == FEEDBACK, served).otherwise(listed)


def task_label(df: DataFrame, spec: TableSpec, task: str) -> Column:
    """The label of a task; unreadable becomes null.

    Classification has no label column in raw data: it is derived from its
    source column, unless a readable observed label is already there.
    """
    spec.check_task(task)
    source = spec.target_sources[task]
    if source not in df.columns:
        raise KeyError(f"column {source!r} is needed to build the {task} label")
    dtype = df.schema[source].dataType
    if task == "regression":
        kind = spec[source].kind
        if kind not in NUMBER_KINDS:
            raise ValueError(f"cannot read a number from {source!r} of kind {kind!r}")
        return read_as(kind, F.col(source), dtype)
    value = read_as("categorical", F.col(source), dtype)
    known = value if spec[source].words is None else F.when(
        value.isin(*spec[source].words), value)
    derived = known.isin(*spec.positive_values)
    label = spec.target(task)
    if label in df.columns and label != source:
        given = read_as("boolean", F.col(label), df.schema[label].dataType)
        return F.coalesce(given, derived)
    return derived


def parse_label(df: DataFrame, spec: TableSpec, task: str) -> Column:
    """Reads an existing label column, with the parser of its kind."""
    label = spec.target(task)
    kind = spec[label].kind if label in spec else "boolean"
    return read_as(kind, F.col(label), df.schema[label].dataType)
