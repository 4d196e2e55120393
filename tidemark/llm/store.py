"""Tables, and intermediate results that outlive lost executors.

Intermediate tables go to the folder that the cluster names in ``spark.checkpoint.dir``
as Parquet: columnar, compressed, readable by every executor, and with no lineage left
to recompute.  Only where the setting is absent (tests, a laptop) is a folder made here.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """This application's folder in the shared one; it goes when the application ends."""
    sc = spark.sparkContext
    got = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not got:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        got = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", got)
    path = f"{got.rstrip('/')}/tidemark/{sc.applicationId}"
    if getattr(sc, "_tidemark_dir", None) != path:
        fs, p = _file(spark, path)
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        sc._tidemark_dir = path
    return path


def _file(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def durable(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written to the shared folder and read back: evaluated once, lineage cut."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._tidemark_path = path
    return back


def discard(*tables: DataFrame) -> None:
    """Removes what ``durable`` wrote, once nothing reads it any more."""
    for df in tables:
        fs, p = _file(df.sparkSession, df._tidemark_path)
        fs.delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors, unless their Python finds it by path anyway."""
    sc, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    found = [Path(p or ".").resolve() for p in [*os.environ.get("PYTHONPATH", "").split(os.pathsep), "."]]
    if package.parent in found or getattr(sc, "_tidemark_shipped", False):
        return
    path = Path(tempfile.mkdtemp(prefix="tidemark-")).resolve() / "tidemark.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(path))
    sc._tidemark_shipped = True


def arrow_rows(spark: SparkSession, rows: int = 2000) -> None:
    """Before Python runs on the executors: ships the package, and bounds an Arrow batch by
    rows, so that very long texts don't add up in a worker."""
    ship(spark)
    spark.conf.set(ARROW_ROWS, str(rows))


def with_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """The named columns only, found whatever their letter case; extra columns go."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[df[f"`{have[n.lower()]}`"].alias(n) for n in names])


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or one like it that no column of ``df`` has."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name
