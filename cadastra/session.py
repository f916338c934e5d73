"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "cadastra", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benches; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="cadastra-warehouse-"))
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job here relies on."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local folder is lost together with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    # The setting can't be changed in a running session, so the folder is remembered here.
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="cadastra-")
    return _own_folders[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{os.urandom(8).hex()}"


def free_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of work that is done; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_scopes: list[Scratch] = []


class Scratch:
    """Written intermediates of one piece of work, deleted when it ends.

    Inside ``with Scratch(spark) as scratch`` every ``cut_lineage`` belongs to the
    scope; ``scratch.keep`` writes a result that outlives it.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        _scopes.append(self)
        return self

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        outer = _scopes[_scopes.index(self) - 1] if _scopes.index(self) else None
        if outer:
            outer.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_) -> None:
        _scopes.remove(self)
        for path in self.paths:
            target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written table survives the loss of any executor, and its statistics
    let the optimiser plan the following joins on real sizes.
    """
    path = scratch_path(df.sparkSession, name)
    if _scopes:
        _scopes[-1].paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
