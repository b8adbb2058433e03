"""Session settings and shared scratch space."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Buckets and dates are UTC; everything else is left to the cluster's own settings.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
}


def build_session(app_name: str = "strata", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged tables; a local folder only for local sessions without one."""
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="strata-")
        spark.conf.set(CHECKPOINT_KEY, root)
    return f"{root.rstrip('/')}/strata"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the scratch root."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/{app}/{label}-{uuid.uuid4().hex}"


def stage(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write a frame to shared scratch and read it back.

    Cuts the lineage with data every executor can reach, so a lost executor costs a re-read and not a
    recomputation, and gives the planner the true size of the frame.
    """
    path = scratch_path(spark, label)
    if _staged:
        _staged[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Paths staged by the running jobs, the innermost last.
_staged: list[list[str]] = []


def freeing(spark: SparkSession, job: Callable):
    """Run a job and delete what it staged when it ends, well or not.

    If it returns a frame, the staged paths that the frame reads stay; a job around this one frees them in turn.
    """
    _staged.append([])
    result = None
    try:
        result = job()
        return result
    finally:
        paths = _staged.pop()
        read = result.inputFiles() if paths and isinstance(result, DataFrame) else []
        names = {path: f"/{path.rsplit('/', 1)[-1]}/" for path in paths}  # unique, and part of the path of every file below
        kept = [path for path in paths if any(names[path] in file for file in read)]
        if _staged:
            _staged[-1] += kept
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in set(paths) - set(kept):
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)


def frees_scratch(job: Callable) -> Callable:
    """A job of a session whose staged frames are freed when it ends, as `freeing` does."""

    @wraps(job)
    def run(spark: SparkSession, *args, **named):
        return freeing(spark, lambda: job(spark, *args, **named))

    return run


@contextmanager
def session_conf(spark: SparkSession, **settings: str):
    """Set `spark.sql.*` options (double underscores stand for dots) around one action."""
    wanted = {key.replace("__", "."): value for key, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
