"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Settings the results and the speed of wide tables depend on.

    Times are UTC throughout.  One projection over a wide catalog can grow past
    the 8000 bytes of bytecode up to which the JVM compiles a method; with this
    limit Spark splits such code into compiled pieces instead.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def local_session(cores: str = "*", **settings: str) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("keelson")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    return _LOCAL_FOLDERS.setdefault(app, tempfile.mkdtemp(prefix="keelson-"))


def run_folder(spark: SparkSession) -> str:
    """Where one application keeps everything it stores between its steps."""
    return f"{shared_folder(spark)}/keelson/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def close(spark: SparkSession) -> bool:
    """Removes what the application stored between steps; to be called when its results are written.

    Results that were returned but not yet written may still read from there.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` once and reads it back: cuts lineage, survives lost executors.

    Used where later steps must all see the same physical layout, for example
    the partition number a row was range-sorted into.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deals rows out to all cores when a scan has fewer splits than cores.

    A small file with one row group is otherwise read, and everything computed
    from it, by a single task.  Larger scans are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
