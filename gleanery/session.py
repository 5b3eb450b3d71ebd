"""Sessions and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings that any deployment of the engine wants; sizes are left to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

_written: list[tuple[SparkSession, str]] = []


def local_session(cpus: int = 8, name: str = "gleanery", **conf: str) -> SparkSession:
    """A single-machine session for tests and benches."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    settings = DEFAULTS | {"spark.sql.shuffle.partitions": str(cpus), "spark.driver.memory": "8g", "spark.driver.host": "127.0.0.1"} | conf
    session = builder.config(map=settings).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else (tests) a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="gleanery-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def drop_path(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def cut(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there, so a lost executor
    costs no recomputation, and the planner knows the table's true size."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/gleanery-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._gleanery_path = path
    return out


def uncut(df: DataFrame) -> None:
    """Delete what ``cut`` wrote for ``df``; the frame must not be read afterwards."""
    path = getattr(df, "_gleanery_path", None)
    if path:
        drop_path(df.sparkSession, path)


@atexit.register
def _sweep() -> None:
    for spark, path in _written:
        try:
            drop_path(spark, path)
        except Exception:  # noqa: BLE001  the JVM may be gone already
            return
