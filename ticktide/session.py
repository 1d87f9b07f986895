"""Session set-up and the few places where code depends on where Spark runs."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Upper bound for a table that a lookup may broadcast. The bound is checked
# against Catalyst's own size estimate before any hint is given.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # The JVM compiles no method beyond 8000 bytes of code: such stages run operator
    # by operator, in methods that it does compile.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Session windows of a hot symbol are merged before a stream shuffles them.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def local_session(app: str = "ticktide", cores: str = "8", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        **SESSION_SETTINGS,
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "6g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Instants are stored in UTC; naive source timestamps are read as UTC."""
    for key, value in SESSION_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder every executor can reach.

    See `shared_root`; the path is not made.
    """
    return os.path.join(shared_root(spark), "ticktide", f"{purpose}-{uuid.uuid4().hex}")


def shared_root(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only where driver and executors are one process, and nothing is set, as in
    tests, a temporary folder of this machine takes its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "local")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="ticktide-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimised plan; no job is run."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
    except AttributeError:  # Spark Connect has no JVM handle
        return None
    return int(str(plan.stats().sizeInBytes()))


def local_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small fixed table as a LocalRelation, so its size is known to Catalyst."""
    schema = T.StructType.fromDDL(ddl)
    columns = list(zip(*rows)) or [()] * len(schema)
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(column, type=field.type) for column, field in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)
