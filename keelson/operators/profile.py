"""Measuring tables: validation report, column profiles, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import parse
from keelson.operators import clean, ranking
from keelson.spec import NUMBER_KINDS, TableSpec

MAX_TARGET_MISSING = 0.5


def validation_row(df: DataFrame, spec: TableSpec) -> DataFrame:
    """All validation numbers of a table as one row.

    One pass over all columns, and one over the id alone: a distinct count in
    the first pass would carry every other partial result along per id.
    """
    present = [f for f in df.schema.fields if f.name in spec]
    parts, flags, numbers = [F.count(F.lit(1)).alias("row_count")], {}, {}
    for fld in present:
        column = spec[fld.name]
        value = F.col(fld.name)
        missing = value.isNull()
        if isinstance(fld.dataType, (T.DoubleType, T.FloatType)):
            missing = missing | F.isnan(value)
        flags[fld.name] = missing.cast("double").alias(f"{fld.name}:flag")
        parts.append(F.coalesce(F.avg(F.col(f"`{fld.name}:flag`")), F.lit(0.0))
                     .alias(f"{fld.name}:missing"))
        if column.bounded:
            # Read in the projection below, so each value is read once.
            numbers[fld.name] = clean.read_as("numeric", value, fld.dataType).alias(
                f"{fld.name}:number")
            parts.append(F.count_if(parse.outside(
                F.col(f"`{fld.name}:number`"), column.low, column.high))
                .alias(f"{fld.name}:outside"))
    measured = df.select(*flags.values(), *numbers.values()).agg(*parts)
    if spec.id_column not in df.columns:
        return measured
    # Missing ids form one group, so all but one of them count as duplicates.
    repeats = df.groupBy(spec.id_column).agg((F.count(F.lit(1)) - 1).alias("extra")).agg(
        F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicate_rows"))
    return side_by_side(measured, repeats)


def side_by_side(*rows: DataFrame) -> DataFrame:
    """Several one-row tables with different columns as one row."""
    stacked = rows[0]
    for row in rows[1:]:
        stacked = stacked.unionByName(row, allowMissingColumns=True)
    return stacked.agg(*[F.max(F.col(f"`{c}`")).alias(c) for c in stacked.columns])


def validation_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The same report with one row per column."""
    wide = validation_row(df, spec)
    structs = [
        F.struct(
            F.lit(c.name).alias("column"), F.lit(c.kind).alias("kind"),
            F.round(F.col(f"`{c.name}:missing`"), 6).alias("missing_rate"),
            (F.col(f"`{c.name}:outside`") if c.bounded else F.lit(0).cast("long"))
            .alias("out_of_bounds"),
        )
        for c in spec.columns if c.name in df.columns
    ]
    return wide.select(
        "row_count",
        *(["duplicate_rows"] if "duplicate_rows" in wide.columns else []),
        F.inline(F.array(*structs)),
    )


def validate(df: DataFrame, spec: TableSpec, task: str, *, blanks_missing: bool = True) -> dict:
    """The validation report with its ``fatal`` reasons.

    ``blanks_missing`` counts empty text as missing; without it only nulls
    count, which is what an all-text table never has.
    """
    return validate_tasks(df, spec, [task], blanks_missing=blanks_missing)[task]


def validate_tasks(df: DataFrame, spec: TableSpec, tasks: Sequence[str], *,
                   blanks_missing: bool = True) -> dict[str, dict]:
    """``validate`` for several tasks: they differ in their verdict only, so the table is measured once."""
    for task in tasks:
        spec.check_task(task)
    row = validation_row(clean.blanks_as_null(df) if blanks_missing else df, spec).first().asDict()
    return {task: _verdict(df, spec, task, row) for task in tasks}


def _verdict(df: DataFrame, spec: TableSpec, task: str, row: dict) -> dict:
    fatal = []
    absent = sorted(set(spec.names) - set(df.columns))
    if absent:
        fatal.append("absent columns: " + ", ".join(absent))
    if row["row_count"] == 0:
        fatal.append("no rows")
    source = spec.target_sources[task]
    missing = row.get(f"{source}:missing", 0.0)
    if missing > MAX_TARGET_MISSING:
        fatal.append(f"{source} is missing in {missing:.1%} of rows, "
                     f"more than {MAX_TARGET_MISSING:.0%}")
    return {
        "ok": not fatal, "fatal": fatal, "row_count": row["row_count"],
        "duplicate_rows": row.get("duplicate_rows", 0),
        "columns": {
            n: {"missing_rate": round(row[f"{n}:missing"], 6),
                "out_of_bounds": row.get(f"{n}:outside", 0)}
            for n in spec.names if n in df.columns
        },
    }


def numeric_columns(df: DataFrame, spec: TableSpec, columns: Sequence[str]) -> list[str]:
    """Columns profiled as numbers: by catalog kind, or by type if unlisted."""
    chosen = []
    for name in columns:
        if name not in df.columns:
            continue
        dtype = df.schema[name].dataType
        if spec[name].kind in NUMBER_KINDS if name in spec else isinstance(dtype, T.NumericType):
            chosen.append(name)
    return chosen


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing rate, moments, range and quartiles, one row per column.

    One aggregate covers all columns.  Quartiles are exact, by order
    statistics.
    """
    values = {
        c: F.nanvl(clean.read_as("numeric", F.col(c), df.schema[c].dataType)
                   if not isinstance(df.schema[c].dataType, T.BooleanType)
                   else F.col(c).cast("double"), F.lit(None).cast("double"))
        for c in columns
    }
    read = df.select(*[v.alias(c) for c, v in values.items()])
    total = F.count(F.lit(1))
    # Side by side, so that no row is copied for each column; no rows give no statistics.
    stats = read.agg(total.alias("_total"), F.array(*[F.struct(
        F.lit(c).alias("column"),
        F.when(total > 0, 1 - F.count(c) / total).alias("missing_rate"),
        F.count(c).alias("n"),
        F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"), F.max(c).alias("max"),
    ) for c in columns]).alias("_stats")).where("_total > 0").select(F.inline("_stats"))
    rows = df.sparkSession.createDataFrame(stats.collect(), stats.schema)
    counts = {r["column"]: r["n"] for r in rows.collect()}
    quartiles = ranking.linear_quantiles(read, list(columns), (0.25, 0.5, 0.75),
                                         {c: counts.get(c, 0) for c in columns})
    table = df.sparkSession.createDataFrame(
        [(c, *q) for c, q in quartiles.items()],
        "column string, p25 double, p50 double, p75 double",
    )
    # Both sides hold one row per profiled column.
    return rows.join(F.broadcast(table), "column", "left")


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 20) -> DataFrame:
    """Equal-width bins per column, the last one closed: (column, bin, low, high, n).

    A column holding one value gets bins around it, half a unit to each side.
    Only counts per (column, bin) are shuffled.
    """
    numbers = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    longs = numbers.unpivot([], list(columns), "column", "value").where("value is not null")
    ends = numbers.agg(F.array(*[F.struct(F.lit(c).alias("column"), F.min(c).alias("lo"), F.max(c).alias("hi"))
                                 for c in columns]).alias("ends")).select(F.inline("ends")).where("lo is not null")
    flat = F.col("lo") == F.col("hi")
    ends = ends.select("column",
                       F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                       F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    # One row per column: small whatever the data.
    placed = longs.join(F.broadcast(ends), "column").select(
        "column", "lo", "hi",
        F.least(F.width_bucket("value", "lo", "hi", F.lit(bins)), F.lit(bins)).alias("bin"),
    )
    counted = placed.groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))
    grid = ends.select("column", "lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return (
        grid.withColumn("bin", F.col("bin").cast("long"))
        .join(counted, ["column", "bin"], "left")
        .select(
            "column", (F.col("bin") - 1).cast("int").alias("bin"),
            (F.col("lo") + width * (F.col("bin") - 1)).alias("low"),
            F.when(F.col("bin") == bins, F.col("hi"))
            .otherwise(F.col("lo") + width * F.col("bin")).alias("high"),
            F.coalesce("n", F.lit(0).cast("long")).alias("n"),
        )
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) of every column as text, nulls kept, one shuffle for all."""
    longs = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value")
    return longs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def categorical_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, missing_rate, n_unique), one row per column."""
    return value_counts(df, columns).groupBy("column").agg(
        (F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
         / F.sum("n")).alias("missing_rate"),
        F.count("value").alias("n_unique"),
    )


def distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of each present value: (column, value, n, share)."""
    counts = value_counts(df, columns).where(F.col("value").isNotNull())
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    # Totals hold one row per column; a window here would gather a whole column
    # of distinct values in one task.
    return counts.join(F.broadcast(totals), "column").select(
        "column", "value", "n", (F.col("n") / F.col("total")).alias("share"))


def compute_profile(df: DataFrame, spec: TableSpec, columns: Sequence[str],
                    bins: int = 20) -> dict[str, DataFrame]:
    """The baseline profile of a table as long tables, by section."""
    numeric = numeric_columns(df, spec, columns)
    categorical = [c for c in columns if c in df.columns and c not in numeric]
    sections: dict[str, DataFrame] = {}
    if numeric:
        as_numbers = df.select(*[
            clean.read_as("numeric", F.col(c), df.schema[c].dataType).alias(c)
            if not isinstance(df.schema[c].dataType, T.BooleanType)
            else F.col(c).cast("double").alias(c) for c in numeric
        ])
        sections["numeric"] = numeric_profile(as_numbers, numeric)
        sections["histogram"] = histogram(as_numbers, numeric, bins)
    if categorical:
        sections["categorical"] = categorical_profile(df, categorical)
        sections["distribution"] = distribution(df, categorical)
    return sections


def rank_per_column(counts: DataFrame) -> DataFrame:
    """The most frequent value per column, smallest value first among equals."""
    order = Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("value"))
    return (
        counts.where(F.col("value").isNotNull())
        .withColumn("_nth", F.row_number().over(order)).where("_nth = 1")
        .select("column", F.col("value").alias("mode"), "n")
    )
