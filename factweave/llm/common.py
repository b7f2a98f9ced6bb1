"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the contracts: a maximal run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Select ``alias=name`` columns by position.

    Other columns of ``df`` may have any name, including names that differ from
    the wanted ones only in case or that this library uses internally.
    """
    names = df.columns
    missing = [name for name in columns.values() if name not in names]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {names}")
    by_position = df.toDF(*(f"_{i}" for i in range(len(names))))
    return by_position.select(*(F.col(f"_{names.index(name)}").alias(alias) for alias, name in columns.items()))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as the session names it.

    Only on one machine (a local master, as in tests) may it be unset; then a temporary folder is used.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (found or _own_dir()).rstrip("/")


@functools.cache
def _own_dir() -> str:
    folder = tempfile.mkdtemp(prefix="checkpoint-")
    atexit.register(shutil.rmtree, folder, True)
    return f"file://{folder}"


@functools.cache
def _stash_dir(spark: SparkSession, application: str, shared: str) -> str:
    """The application's own folder there, which goes when the application ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared}/stash-{application}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return path.toString()


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage, is computed once however often it is used, and
    survives lost executors because the files live in shared storage.
    """
    spark = df.sparkSession
    path = f"{_stash_dir(spark, spark.sparkContext.applicationId, shared_dir(spark))}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.cache
def _package(root: str) -> str:
    """A zip archive of this library."""
    folder = tempfile.mkdtemp(prefix="package-")
    atexit.register(shutil.rmtree, folder, True)
    path = os.path.join(folder, "factweave.zip")
    with zipfile.ZipFile(path, "w") as out:
        for where, _, files in os.walk(os.path.join(root, "factweave")):
            for file in files:
                if file.endswith(".py"):
                    out.write(os.path.join(where, file), os.path.relpath(os.path.join(where, file), root))
    return path


def ship_code(spark: SparkSession) -> None:
    """Send this library to the Python workers of all executors, once for each session."""
    context = spark.sparkContext
    if not any(name.endswith("factweave.zip") for name in context._python_includes):
        context.addPyFile(_package(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))))


def word_count(text):
    """Number of words of a text column; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
