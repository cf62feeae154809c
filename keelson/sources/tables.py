"""Dataset versions and the copies made from them.

A version is a Parquet folder with a one-row JSON manifest beside it.  It is
written once; a taken name is refused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators import clean, profile, splits
from keelson.operators.rows import FILE_ORDER, with_file_order
from keelson.spec import ORIGINAL, TableSpec

RULE = T.StructType([
    T.StructField("t1", T.StringType()),
    T.StructField("t2", T.StringType()),
    T.StructField("undated_test_share", T.DoubleType()),
])
MANIFEST = T.StructType([
    T.StructField("dataset_version", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("split_points", T.MapType(T.StringType(), RULE)),
    T.StructField("lineage", T.MapType(T.StringType(), T.StringType())),
])


class VersionExistsError(ValueError):
    """The dataset version name is taken."""


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished output lies at ``path``."""
    return path_exists(spark, f"{path}/_SUCCESS")


def read_csv_text(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """A CSV with every column as text and "" for an empty cell."""
    raw = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"',
                         multiLine=multi_line, mode="PERMISSIVE")
    return raw.na.fill("")


def ingest_csv(spark: SparkSession, source: str, target: str, *, multi_line: bool = False) -> int:
    """Copies a CSV into all-text Parquet; returns the rows written.

    A header without rows writes nothing.
    """
    raw = read_csv_text(spark, source, multi_line=multi_line)
    if raw.isEmpty():
        return 0
    raw.write.mode("errorifexists").parquet(target)
    return spark.read.parquet(target).count()


def read_columns(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


def head(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows in file order of a Parquet scan.

    Rows are counted per file, which reads no column; only the files that hold
    the first ``n`` give rows, and each only as many as are still wanted.
    """
    if n < 1:
        raise ValueError(f"rows must be positive, got {n}")
    placed = with_file_order(df)
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    sizes = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    wanted = sizes.select("_file", (n - F.coalesce(F.sum("_rows").over(before), F.lit(0))).alias("_left")) \
        .where("_left > 0")
    found = placed.join(F.broadcast(wanted), "_file").where(F.col("_row") < F.col("_left"))
    return found.orderBy(*FILE_ORDER).select(*df.columns)


def head_and_total(df: DataFrame, n: int) -> tuple[DataFrame, int]:
    return head(df, n), df.count()


def rows_at(df: DataFrame, positions: DataFrame) -> DataFrame:
    """Rows whose (file, row) is listed in ``positions``."""
    placed = with_file_order(df)
    return placed.join(positions.select(*FILE_ORDER), list(FILE_ORDER), "left_semi").drop(*FILE_ORDER)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_document(df: DataFrame, path: str) -> None:
    """A one-row table as a JSON document."""
    df.coalesce(1).select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def manifest_frame(spark: SparkSession, manifest: dict) -> DataFrame:
    return spark.createDataFrame([manifest], MANIFEST)


def build_manifest(df: DataFrame, spec: TableSpec, version: str) -> dict:
    if spec.date_column not in df.columns:
        raise ValueError(f"a dataset version needs the column {spec.date_column}")
    return {
        "dataset_version": version, "created_at": datetime.now(UTC).isoformat(),
        "row_count": df.count(),
        "split_points": {ORIGINAL: splits.split_rule(df, spec)}, "lineage": None,
    }


def _paths(root: str, version: str) -> tuple[str, str]:
    return f"{root}/raw/{version}/data", f"{root}/raw/{version}/manifest"


def dataset_exists(spark: SparkSession, root: str, version: str) -> bool:
    """Data or manifest is enough: a half-written version still owns its name."""
    return any(path_exists(spark, p) for p in _paths(root, version))


def publish_frame(df: DataFrame, root: str, version: str, manifest: dict) -> None:
    spark = df.sparkSession
    if dataset_exists(spark, root, version):
        raise VersionExistsError(f"dataset version {version!r} already exists")
    data, document = _paths(root, version)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(data)
    write_document(manifest_frame(spark, manifest), document)


def publish_version(df: DataFrame, spec: TableSpec, root: str, version: str) -> dict:
    """Stores a raw table as a new version and fixes its split points."""
    if dataset_exists(df.sparkSession, root, version):
        raise VersionExistsError(f"dataset version {version!r} already exists")
    manifest = build_manifest(df, spec, version)
    publish_frame(df, root, version, manifest)
    return manifest


def read_version(spark: SparkSession, root: str, version: str) -> DataFrame:
    return spark.read.parquet(_paths(root, version)[0])


def read_manifest(spark: SparkSession, root: str, version: str) -> dict:
    return read_document(spark, _paths(root, version)[1], MANIFEST).first().asDict(recursive=True)


def ensure_manifest(spark: SparkSession, root: str, version: str, spec: TableSpec) -> dict:
    """The manifest, built once for a version stored without one."""
    document = _paths(root, version)[1]
    if not exists(spark, document):
        manifest = build_manifest(read_version(spark, root, version), spec, version)
        write_document(manifest_frame(spark, manifest), document)
    return read_manifest(spark, root, version)


def fingerprint(df: DataFrame) -> DataFrame:
    """One row that changes with the content of a table, whatever its row order.

    Every value enters as the MD5 of its text, so that other engines can check
    it: floating numbers by their bits, times in microseconds, lists by element.
    """
    parts = [F.coalesce(_mark(F.col(f"`{f.name}`"), f.dataType), F.lit("~")) for f in df.schema.fields]
    digest = F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.coalesce(F.sum(digest), F.lit(0)).cast("string").alias("content"))


def _mark(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.ArrayType):
        return F.array_join(F.transform(value, lambda x: _mark(x, kind.elementType)), ",", "~")
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return F.round(value.cast("double") * 1_000_000).cast("decimal(38,0)").cast("string")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(value.cast("timestamp")).cast("string")
    return F.md5(value.cast("string"))


def short_key(*parts: str) -> str:
    return hashlib.sha256("|".join(parts).encode()).hexdigest()[:16]


def working_copy_id(version: str, content: str) -> str:
    return short_key(version, content)


def data_id(copy_id: str, sample_rows: int | None, seed: int) -> str:
    return short_key(copy_id, "all" if sample_rows is None else str(sample_rows), str(seed))


def working_copy(spark: SparkSession, root: str, version: str) -> tuple[str, str]:
    """(id, path) of the copy a run reads; written once per content."""
    df = read_version(spark, root, version)
    mark = fingerprint(df).first()
    copy_id = working_copy_id(version, f"{mark['row_count']}:{mark['content']}")
    path = f"{root}/working/{copy_id}"
    if not exists(spark, path):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return copy_id, path


def prepared_sets(spark: SparkSession, root: str, key: str, task: str, build, *,
                  force: bool = False) -> tuple[DataFrame, DataFrame]:
    """Train and test tables of a (data id, task), built once.

    ``build`` returns the (train, test) pair; it is only called when the tables
    are absent or ``force`` is set.
    """
    paths = [f"{root}/prepared/{key}/{task}/{part}" for part in (splits.TRAIN, splits.TEST)]
    if force or not all(exists(spark, p) for p in paths):
        for df, path in zip(build(), paths, strict=True):
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(paths[0]), spark.read.parquet(paths[1])


def preview(df: DataFrame, spec: TableSpec, rows: int = 50) -> tuple[DataFrame, DataFrame, int]:
    """(the first raw rows, per-column stats of all rows, exact total)."""
    first, total = head_and_total(df, rows)
    return first, profile.validation_columns(clean.blanks_as_null(df), spec), total


