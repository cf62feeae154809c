"""Turning confirmed outcomes into a new dataset version."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession

from keelson.operators import feedback, splits
from keelson.session import materialize
from keelson.sources import tables
from keelson.spec import TableSpec


def build_version(spark: SparkSession, root: str, matched: DataFrame, spec: TableSpec, *,
                  task: str, model_name: str, source_version: str, new_version: str,
                  start: datetime, end: datetime, columns: Sequence[str],
                  order: Sequence[Column]) -> dict:
    """Source rows plus the feedback rows of a period, stored as a new version.

    Refused when the name is taken or fewer than 500 records remain.  The
    feedback rows are stored once first: counting, cutting and merging must see
    the same rows.
    """
    if tables.dataset_exists(spark, root, new_version):
        raise tables.VersionExistsError(f"dataset version {new_version!r} already exists")
    fresh = materialize(feedback.records(matched, spec, task, columns, order), "feedback")
    n = fresh.count()
    if n < feedback.MIN_FEEDBACK:
        raise feedback.NotEnoughFeedbackError(
            f"{n} predictions have an outcome, {feedback.MIN_FEEDBACK} are needed")
    source_manifest = tables.ensure_manifest(spark, root, source_version, spec)
    source = tables.read_version(spark, root, source_version)
    merged = feedback.merge(source, fresh, spec.id_column)
    replaced = feedback.replaced_count(source, fresh, spec.id_column).first()[0]
    manifest = {
        "dataset_version": new_version, "created_at": datetime.now(UTC).isoformat(),
        "row_count": source.count() - replaced + n,
        "split_points": splits.feedback_rules(source_manifest["split_points"], fresh, n),
        "lineage": {
            "source_version": source_version, "task_type": task, "model_name": model_name,
            "period_start": start.isoformat(), "period_end": end.isoformat(),
            "feedback_records": str(n), "replaced_records": str(replaced),
        },
    }
    tables.publish_frame(merged, root, new_version, manifest)
    return manifest
