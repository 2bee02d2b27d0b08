"""Session and table access."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Largest driver-side list this library ever builds from a table it was told is small.
MAX_DRIVER_ROWS = 10_000


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "glossweave") -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session's ``spark.checkpoint.dir`` names it.

    Only where that is unset and all of Spark runs on this machine (tests, a laptop) a temporary
    folder is made, set, and removed when the process ends; a cluster without the setting is an error.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return named or current.get()
    if named:
        spark.sparkContext.setCheckpointDir(named)
        return named
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="glossweave-checkpoint-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.sparkContext.setCheckpointDir("file://" + os.path.abspath(path))
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise once in the shared folder; what is read later survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of its rows, counted on the way of whatever action reads it; no pass of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan as ``explain(mode)`` prints it."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def small_rows(df: DataFrame, most: int = MAX_DRIVER_ROWS) -> list | None:
    """The rows of a table that should be small, or None once it proves larger than ``most``."""
    rows = df.limit(most + 1).collect()
    return rows if len(rows) <= most else None
