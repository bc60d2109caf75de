"""Session helpers shared by tests, the bench and local runs."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | None = None, app: str = "voxloom", memory: str = "12g") -> SparkSession:
    """A local session with the settings the engine is tuned for; a cluster brings its own."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """One of the driver's tables; columns are pruned at the scan."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def spread(df: DataFrame) -> DataFrame:
    """Spreads a scan of fewer partitions than there are cores, so that Python work uses all of them; larger inputs are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shared_folder(spark: SparkSession, kind: str = "table") -> str:
    """A new folder below the one that the cluster names in spark.checkpoint.dir, to be deleted as the session ends; a local one only where that is unset and the master is local (tests)."""
    sc = spark.sparkContext
    set_ = sc._jsc.sc().getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None) or (set_.get() if set_.isDefined() else None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + os.path.join(tempfile.gettempdir(), "voxloom-shared")
        sc.setCheckpointDir(named)
    path = f"{named}/voxloom/{kind}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def written(df: DataFrame) -> DataFrame:
    """Cuts the lineage: writes df as a table into the shared folder and reads it again."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Makes the package importable in Python workers: it is sent along unless they find it already (installed, or on their path). Once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_voxloom_shipped", False):
        return

    def found(_: int) -> bool:
        import importlib.util

        return importlib.util.find_spec("voxloom") is not None

    if not sc.parallelize([0], 1).map(found).first():
        root = Path(__file__).parent
        path = os.path.join(tempfile.mkdtemp(), "voxloom.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(path)
    sc._voxloom_shipped = True
