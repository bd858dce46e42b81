"""Session set-up and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_staged: dict[str, list[str]] = {}  # by application


def local_session(name: str = "ebbline", cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the session comes from spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`; a fresh one for a session in one process only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="ebbline-")
    return _local_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; `release` deletes it."""
    path = f"{shared_dir(spark)}/ebbline/{name}-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession, since: int = 0) -> int:
    """Delete what this application has put into the shared folder, from the `since`-th path on; how many paths.

    For the end of a job, or between jobs of one session: results that still read those paths must be
    written out before.
    """
    paths = _staged.get(spark.sparkContext.applicationId, [])
    gone = paths[since:]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in gone:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
    del paths[since:]
    return len(gone)


def staged_paths(spark: SparkSession) -> int:
    """How many paths `release` would delete; a job notes it at its begin and releases from there."""
    return len(_staged.get(spark.sparkContext.applicationId, []))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once and read it back.

    Cuts lineage, survives lost executors, and gives later passes a columnar scan with known size,
    which `persist` would not. Used where a job makes several passes over the same rows.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
