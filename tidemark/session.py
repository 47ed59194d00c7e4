"""Session factory and the settings every plan of this package relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: ANSI stays on (bad casts raise, so every parse is a try_ variant); cp1252 needs the legacy charset list.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with this package's settings; `extra` uses `__` for dots in setting names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Sends this package to all executors, whose Python workers may not have it installed."""
    here = Path(__file__).resolve().parent
    folder = Path(tempfile.mkdtemp(prefix="tidemark-package-"))  # read by the driver alone, which serves it to the executors
    archive = folder / "tidemark.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(archive))


class NoSharedFolder(RuntimeError):
    """A cluster whose executors share no folder that the session knows of."""


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir (or TIDEMARK_SHARED).

    Where neither is set, a temporary folder serves a session whose executors are threads of the driver; on a cluster
    the driver's own folder would be lost to the executors, so that is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or os.environ.get("TIDEMARK_SHARED")
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` reliably in the shared folder, so that later reads survive a lost executor."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def passing_folder(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder; what is written there is deleted when the driver's JVM ends."""
    place = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return place


def written(df: DataFrame, name: str = "written") -> DataFrame:
    """Like `cut`, for wide or large frames: a table in the shared folder, of which later reads take the columns they need."""
    place = passing_folder(df.sparkSession, name)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)
