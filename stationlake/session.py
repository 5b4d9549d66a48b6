"""Session construction and the shared folder used for written tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "stationlake") -> SparkSession:
    """Local session for tests and the bench; on a cluster use the cluster's builder."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SCRATCH: dict[int, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for written tables and checkpoints.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``
    (a cluster session without one is an error). Only a local session without
    one (tests) gets a scratch folder, registered as the checkpoint dir.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: configuration only
        pass
    if not current and sc is not None:
        jdir = sc._jsc.sc().getCheckpointDir()
        current = jdir.get() if jdir.isDefined() else None
    if not current:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: written tables and checkpoints "
                               "must survive the loss of an executor")
        current = _SCRATCH.get(id(spark)) or tempfile.mkdtemp(prefix="stationlake-ckpt-")
        _SCRATCH[id(spark)] = current
        try:
            spark.conf.set("spark.checkpoint.dir", current)
        except Exception:  # core settings may be read-only at runtime; the memo above still holds it
            pass
        if sc is not None:
            sc.setCheckpointDir(current)
    return current.rstrip("/")


_WRITTEN: list[str] = []


def table_path(spark: SparkSession, name: str) -> str:
    """A fresh location for one written table under the shared folder."""
    path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.append(path)
    return path


def written() -> list[str]:
    """The intermediate tables that this process has written and not deleted, oldest first."""
    return list(_WRITTEN)


def drop_tables(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete the intermediate tables that this process has written, or those of them in ``paths``; returns how many.

    A query's result reads its intermediate tables when it runs, so call this
    once the results are consumed (or written elsewhere).
    """
    jvm, n = spark._jvm, 0
    for place in written() if paths is None else [p for p in paths if p in _WRITTEN]:
        _WRITTEN.remove(place)
        path = jvm.org.apache.hadoop.fs.Path(place)
        n += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return n


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back.

    Cuts the lineage at a durable table: a lost executor recomputes from the
    written files, not from the raw scan.
    """
    spark = df.sparkSession
    path = table_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
