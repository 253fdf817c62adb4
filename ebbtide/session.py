"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: tempfile.TemporaryDirectory | None = None


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and for the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ebbtide")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # Wide projections beyond what the JIT compiles run faster without fusion.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master without that setting falls back to a temporary folder, which is
    removed when the process ends. On a cluster the setting is required.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        if _local_folder is None:
            _local_folder = tempfile.TemporaryDirectory(prefix="ebbtide-")
        folder = _local_folder.name
    return f"{folder.rstrip('/')}/ebbtide/{spark.sparkContext.applicationId}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    The result survives the loss of any executor, cuts the lineage, and tells the planner
    its true size, so joins with it broadcast only when it really is small.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
