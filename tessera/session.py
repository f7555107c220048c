"""Session helpers: one place that builds a session and reads the tables.

On a cluster the session already exists and carries its own settings; the
helpers here only fill in what is unset (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "tessera") -> SparkSession:
    """Build (or reuse) a session with AQE on, UTC time, UI off."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; create a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only a local/test session without it gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    scratch = tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


_SCRATCH: list[list[str]] = []  # the written tables of every open ``scratch``


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the session's checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    if _SCRATCH:
        _SCRATCH[-1].extend(_files(out))
    return out


def _files(cut: DataFrame) -> list[str]:
    """The folder of a table of ``cut_lineage`` or ``packed_table``."""
    if "_packed" in cut.__dict__:
        return [cut.__dict__["_packed"]]
    plan = cut._jdf.queryExecution().analyzed()
    if plan.nodeName() != "LogicalRDD":
        return []
    file = plan.rdd().getCheckpointFile()
    return [file.get()] if file.isDefined() else []


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def packed_table(df: DataFrame) -> DataFrame:
    """``cut_lineage`` as a compressed Parquet table, for long tables of plain columns: a checkpoint keeps rows as
    they are in memory. The table has no partitioning or order."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/packed-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._packed = path
    return out


def forget(*cut: DataFrame) -> None:
    """Delete written tables that no later step reads; only those of an open ``scratch``."""
    for df in cut:
        for path in _files(df):
            for held in _SCRATCH:
                if path in held:
                    held.remove(path)
                    _delete(df.sparkSession, path)


def outlive(cut: DataFrame, every: bool = False) -> DataFrame:
    """A written table that the innermost ``scratch`` does not delete: the next one has it, or none with ``every``."""
    for path in _files(cut):
        for k in reversed(range(len(_SCRATCH))):
            if path in _SCRATCH[k]:
                _SCRATCH[k].remove(path)
                if k and not every:
                    _SCRATCH[k - 1].append(path)
                break
    return cut


@contextmanager
def settings(spark: SparkSession, **values):
    """Session settings (dots as __) that hold inside."""
    before = {k: spark.conf.get(k.replace("__", "."), None) for k in values}
    for k, v in values.items():
        spark.conf.set(k.replace("__", "."), str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k.replace("__", ".")) if v is None else spark.conf.set(k.replace("__", "."), v)


@contextmanager
def scratch(spark: SparkSession):
    """For steps whose tables only later steps inside read: what is written inside is deleted at the end, and a
    finished step's shuffle files are dropped at once instead of with the driver's next garbage collection. What is
    returned must be made of tables that ``outlive`` it."""
    _SCRATCH.append([])
    try:
        with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
            yield
    finally:
        for path in _SCRATCH.pop():
            _delete(spark, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {n: table(spark, sf_dir, n) for n in names}
