"""Reading monitoring summaries, run outcomes and model lineage tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions import parse
from keelson.operators.drift import HIGH, WARNING, severity_rank


def zoned_moment(text: Column) -> Column:
    """A timestamp only if the text states its offset; a guessed zone is no time."""
    return F.when(parse.trimmed(text).rlike(r"T.*([+-][0-9]{2}:?[0-9]{2}|Z)$"), parse.moment(text))


def latest(summaries: DataFrame, model: str = "model_name", at: str = "computed_at",
           run: str = "run_id") -> DataFrame:
    """The newest summary of every model, from one aggregate; of equal times the largest run id."""
    rest = [c for c in summaries.columns if c != model]
    newest = F.max_by(F.struct(*rest), F.struct(at, run)).alias("_row")
    return summaries.groupBy(model).agg(newest).select(model, "_row.*").select(*summaries.columns)


def newest_first(summaries: DataFrame, moment: Column, key: str, n: int) -> DataFrame:
    """The n newest summaries; unreadable times come last, the key breaks ties."""
    return summaries.orderBy(moment.desc_nulls_last(), F.col(key).desc()).limit(n)


def warning_streaks(parts: DataFrame, keys: Sequence[str], order: Sequence[str],
                    version: str = "model_version", level: str = "level") -> DataFrame:
    """Adds ``streak``: how many runs in a row ended at warning, per key.

    A run at another level counts 0; a new model version starts over.
    """
    runs = Window.partitionBy(*keys).orderBy(*order)
    broken = (F.col(level) != WARNING) | ~F.col(version).eqNullSafe(F.lag(version).over(runs))
    marked = parts.withColumn("_island", F.sum(F.coalesce(broken, F.lit(True)).cast("int")).over(
        runs.rowsBetween(Window.unboundedPreceding, 0)))
    island = Window.partitionBy(*keys, "_island").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0)
    return marked.withColumn(
        "streak", F.when(F.col(level) == WARNING,
                         F.count_if(F.col(level) == WARNING).over(island)).otherwise(0)
    ).drop("_island")


def changes(parts: DataFrame, keys: Sequence[str], order: Sequence[str], recent: int = 5,
            version: str = "model_version", level: str = "level") -> DataFrame:
    """Adds previous level, whether it got worse, comparability and recent high count.

    ``worse`` is null when either level was not measured.
    """
    runs = Window.partitionBy(*keys).orderBy(*order)
    before = F.lag(level).over(runs)
    return parts.withColumns({
        "previous_level": before,
        "changed": before.isNotNull() & (before != F.col(level)),
        "worse": severity_rank(F.col(level)) > severity_rank(before),
        "comparable": F.coalesce(F.lag(version).over(runs) == F.col(version), F.lit(True)),
        "recent_high": F.count_if(F.col(level) == HIGH).over(runs.rowsBetween(1 - recent, 0)),
    })


def run_outcomes(task_states: DataFrame, run: str = "run_id") -> DataFrame:
    """How each run ended, from the final state of its tasks.

    A failed deploy outranks any other failure, a failure outranks a block by
    the gates.
    """
    failed = F.col("state").isin("failed", "upstream_failed")
    deploy = F.bool_or((F.col("task") == "deploy") & (F.col("state") == "failed"))
    blocked = F.bool_or((F.col("task") == "stop_no_deploy") & (F.col("state") == "success"))
    status = (F.when(deploy, "smoke_test_failed").when(F.bool_or(failed), "failed")
              .when(blocked, "blocked").otherwise("success"))
    return task_states.groupBy(run).agg(status.alias("status"))


def live_ratios(summaries: DataFrame) -> DataFrame:
    """Adds the live over test rmse ratio and the auc drop, null where unmeasured."""
    return summaries.withColumns({
        "rmse_ratio": F.when(F.col("reference_rmse") > 0,
                             F.col("current_rmse") / F.nullif("reference_rmse", F.lit(0.0))),
        "auc_drop": F.col("reference_auc") - F.col("current_auc"),
    })


def alerts(streaks: DataFrame, outcomes: DataFrame, model: str = "model_name") -> DataFrame:
    """Alert rows: a part at high, a warning three runs in a row, a failed last run.

    ``streaks`` holds the newest run of each model and part, ``outcomes`` the
    last status per run name.
    """
    high = streaks.where(F.col("level") == HIGH).select(
        F.lit("level_high").alias("rule"), model, "part", F.col("level").alias("detail"))
    lasting = streaks.where(F.col("streak") > 2).select(
        F.lit("warning_persistent"), model, "part", F.col("streak").cast("string"))
    failed = outcomes.where(F.col("status").isin("failed", "smoke_test_failed")).select(
        F.lit("run_failed"), F.col(model), F.lit(None).cast("string"), "status")
    return high.union(lasting).union(failed)


def champion(versions: DataFrame, runs: DataFrame, alias: str = "champion") -> DataFrame:
    """Walks from the champion alias to its run: data id, dataset version, test scores.

    A champion whose run states no data id cannot be traced, which is an error.
    """
    found = versions.where(F.col("alias") == alias).join(runs, "run_id")
    untraced = F.raise_error(F.concat(F.lit("no data id on run "), F.col("run_id")))
    return found.withColumn("data_id", F.coalesce("data_id", untraced.cast("string")))


def ancestors(versions: DataFrame, version: str = "version", source: str = "source_version") -> DataFrame:
    """``version, ancestor, generation``: everything a version was built from, directly or not.

    ``versions`` holds a row for each version and source; the first versions have a null
    source.  A source that is not listed is an ancestor without ancestors of its own.  A
    version that is its own ancestor is an error.
    """
    edges = versions.select(F.col(version).cast("string").alias("version"), F.col(source).cast("string").alias("source")) \
        .where("version is not null and source is not null").distinct()
    # The path ends a branch that comes back to itself; without one it would not end.
    found = versions.sparkSession.sql("""
        WITH RECURSIVE up(version, ancestor, generation, path) MAX RECURSION LEVEL 10000 AS (
          SELECT version, source, 1, array(version, source) FROM {edges}
          UNION ALL
          SELECT up.version, e.source, up.generation + 1, concat(up.path, array(e.source))
          FROM up JOIN {edges} e ON e.version = up.ancestor
          WHERE NOT array_contains(slice(up.path, 1, size(up.path) - 1), up.ancestor))
        SELECT version, ancestor, min(generation) AS generation FROM up GROUP BY version, ancestor""", edges=edges)
    circle = F.raise_error(F.concat(F.lit("a version is its own ancestor: "), F.col("version"))).cast("string")
    return found.select(
        "version", F.when(F.col("ancestor") == F.col("version"), circle).otherwise(F.col("ancestor")).alias("ancestor"),
        "generation")
