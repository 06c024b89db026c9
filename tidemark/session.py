"""Session settings the library relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Wide projections outgrow what the JIT compiles as one method (8000 bytes) and would run interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(app: str = "tidemark", **extra: str) -> SparkSession:
    """The running session, or a new one; the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster whose machines do not share that folder, submit the package
    with --py-files.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))


@lru_cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_folder(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables, as the cluster names it.

    Only a local session without the setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        return _local_folder()
    raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")


_scope: ContextVar[str | None] = ContextVar("scratch_scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written table inside the shared folder, or inside the scope that is open."""
    return f"{_scope.get() or f'{shared_folder(spark)}/tidemark'}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession):
    """Intermediate tables written inside are deleted at the end, also after a failure.

    For a step whose results are written elsewhere: what it returns lazily must not be read afterwards.
    """
    folder = f"{shared_folder(spark)}/tidemark/scope-{uuid.uuid4().hex}"
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def write_and_reread(df, name: str):
    """Cut the lineage of a table that later steps scan more than once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
