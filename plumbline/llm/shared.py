"""Tables that several jobs read, in the folder all executors share, and rows numbered without one ordering task."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SETTING = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}
_SHIPPED: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``. Unset is allowed only where the driver runs the tasks itself."""
    configured = spark.conf.get(SETTING, None)
    if not configured:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        configured = _LOCAL.setdefault("folder", tempfile.mkdtemp(prefix="plumbline-"))
    return f"{configured.rstrip('/')}/llm-{uuid.uuid4().hex}"


def importable(spark: SparkSession) -> None:
    """Lets the Python workers import this package: where it lies neither in the working folder nor on PYTHONPATH, as on a cluster
    that has not installed it, Spark hands it out."""
    context, root = spark.sparkContext, os.path.dirname(_PACKAGE)
    places = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if context.applicationId in _SHIPPED or any(os.path.realpath(p) == os.path.realpath(root) for p in places if p):
        return
    context.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), "package"), "zip", root, os.path.basename(_PACKAGE)))
    _SHIPPED.add(context.applicationId)


def staged(df: DataFrame) -> DataFrame:
    """The frame, written once as Parquet in the shared folder: an executor lost later costs no recomputation."""
    path = shared_folder(df.sparkSession)
    df.write.mode("errorifexists").parquet(path)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    return df.sparkSession.read.schema(schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scalar(df: DataFrame, column: Column):
    """One aggregate of a frame, on the driver."""
    return df.agg(column.alias("value")).first()["value"]


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Rows with a gapless number from 0 in the given order. The rows are dealt out by ranges and numbered within each;
    only the sizes of the ranges meet in one task. Rows equal in ``order`` are numbered in any order."""
    parts = staged(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows")) \
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return parts.withColumn("_own", own).join(sizes, "_range").withColumn(name, F.col("_before") + F.col("_own") - 1) \
        .drop("_range", "_own", "_before")
