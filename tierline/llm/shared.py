"""Folders and tables that the driver and every executor can reach.

Everything an operator keeps between two jobs goes below the folder the
cluster names in ``spark.checkpoint.dir``; that cuts the lineage and survives
a lost executor.  Files are written under a name no other attempt uses and
are valid only once a row naming them has been committed by Spark.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.session import checkpoint_dir


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in a new shared folder and read it back."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def veiled(docs: DataFrame, columns: list[str]) -> tuple[list[Column], list[Column]]:
    """Columns of ``docs`` under names that no operator uses (``own0``, …),
    and the way back to their own names."""
    return ([F.col(f"`{c}`").alias(f"own{i}") for i, c in enumerate(columns)],
            [F.col(f"own{i}").alias(c) for i, c in enumerate(columns)])


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per context, so that Python
    workers import it whatever their working folder is."""
    sc = spark.sparkContext
    if getattr(sc, "_tierline_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tierline-src-"), "tierline_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._tierline_shipped = True


def attempt_file(folder: str, suffix: str) -> str:
    """A file name for this task that no other attempt of it uses."""
    part = TaskContext.get().partitionId()
    return f"{folder}/part-{part:06d}-{uuid.uuid4().hex[:12]}{suffix}"


def open_output(uri: str):
    fs, path = pafs.FileSystem.from_uri(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    return fs.open_output_stream(path, compression=None)


def open_input(uri: str):
    fs, path = pafs.FileSystem.from_uri(uri)
    return fs.open_input_file(path)
