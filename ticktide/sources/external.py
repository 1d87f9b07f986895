"""Kafka, Avro, JDBC and file endpoints chosen by configuration.

Kafka and Avro come from packages of the Spark project that a cluster adds to
its class path. Here their options are built and their absence is reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ticktide.streaming import commits, jobs

FILE_FORMATS = ("parquet", "json", "csv", "orc", "text")


def has_source(spark: SparkSession, name: str) -> bool:
    """Whether a data source of this name can be resolved in the session."""
    sources = spark._jvm.org.apache.spark.sql.execution.datasources.DataSource
    try:
        sources.lookupDataSource(name, spark._jsparkSession.sessionState().conf())
        return True
    except Exception:  # noqa: BLE001 - an unknown source is reported as a Java exception
        return False


def kafka_read_options(servers: str, topic: str, group: str | None = None,
                       offset_reset: str = "earliest") -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic,
               "startingOffsets": offset_reset, "includeHeaders": "true"}
    if group:
        options["kafka.group.id"] = group
    return options


def kafka_scan(spark: SparkSession, servers: str, topic: str, group: str | None = None,
               offset_reset: str = "earliest", streaming: bool = True) -> DataFrame:
    if not has_source(spark, "kafka"):
        raise RuntimeError("the Kafka source package is not on the class path")
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(
        **kafka_read_options(servers, topic, group, offset_reset)).load()


def read_input(spark: SparkSession, config: dict, streaming: bool = False) -> DataFrame:
    """Declared input kinds: kafka, file and s3 (a file path), database."""
    kind = config["type"]
    if kind == "kafka":
        return kafka_scan(spark, config["servers"], config["topic"], config.get("group_id"),
                          streaming=streaming)
    if kind in ("file", "s3"):
        fmt = config.get("format", "parquet")
        if fmt not in FILE_FORMATS:
            raise ValueError(f"file format {fmt!r} is not one of {FILE_FORMATS}")
        reader = spark.readStream if streaming else spark.read
        if "schema" in config:
            reader = reader.schema(config["schema"])
        return reader.format(fmt).options(**config.get("options", {})).load(config["path"])
    if kind == "database":
        return spark.read.format("jdbc").options(**config["options"]).load()
    raise ValueError(f"unsupported input type {kind!r}")


def write_output(df: DataFrame, config: dict) -> None:
    """Declared output kinds for batch frames: kafka, file and s3, console, db."""
    kind, mode = config["type"], config.get("mode", "append")
    if kind == "kafka":
        (df.select("topic", "key", "value", "headers").write.format("kafka")
         .option("kafka.bootstrap.servers", config["servers"])
         .option("includeHeaders", "true").save())
    elif kind in ("file", "s3"):
        df.write.format(config.get("format", "parquet")).mode(mode).save(config["path"])
    elif kind == "console":
        df.write.format("console").mode("append").options(**config.get("options", {})).save()
    elif kind == "db":
        df.write.format("jdbc").options(**config["options"]).mode(mode).save()
    else:
        raise ValueError(f"unsupported output type {kind!r}")


def write_stream(records: DataFrame, config: dict, checkpoint: str) -> StreamingQuery:
    """Declared output kinds of a stream; without ``interval`` it takes what is there and ends.

    ``file`` and ``s3``: the file sink, whose log tells which files count. ``console``:
    the first rows of each batch. ``batches``: folders that count from their commit on,
    read by `commits.committed`. ``table``: the latest row of each of ``keys`` by
    ``version``, read by `commits.compacted`; a batch that runs again changes nothing.
    ``kafka``: rows of the message envelope; the broker may get a row twice.
    """
    kind, options = config["type"], config.get("options", {})
    if kind == "table":
        handle = commits.compacted_table(config["path"], config["keys"], config["version"],
                                         config.get("buckets", 64))
        writer = records.writeStream.foreachBatch(handle)
    elif kind == "batches":
        writer = records.writeStream.foreachBatch(commits.committed_folder(config["path"]))
    elif kind in ("file", "s3"):
        fmt = config.get("format", "parquet")
        if fmt not in FILE_FORMATS:
            raise ValueError(f"file format {fmt!r} is not one of {FILE_FORMATS}")
        writer = records.writeStream.format(fmt).options(**options).option("path", config["path"])
    elif kind == "console":
        writer = records.writeStream.format("console").options(**options)
    elif kind == "kafka":
        if not has_source(records.sparkSession, "kafka"):
            raise RuntimeError("the Kafka sink package is not on the class path")
        writer = (records.select("topic", "key", "value", "headers").writeStream.format("kafka")
                  .option("kafka.bootstrap.servers", config["servers"]).option("includeHeaders", "true"))
    else:
        raise ValueError(f"unsupported output type {kind!r} for a stream")
    return jobs.started(writer.outputMode("append"), checkpoint, config.get("interval"))


def write_objects(df: DataFrame, path: str, fmt: str = "avro", mode: str = "errorifexists") -> None:
    """Object files in the format that the caller names; an absent package is an error."""
    if fmt not in FILE_FORMATS and not has_source(df.sparkSession, fmt):
        raise RuntimeError(f"the {fmt} package is not on the class path")
    df.write.format(fmt).mode(mode).save(path)


def decode_avro(payload: Column, schema_json: str) -> Column:
    from pyspark.sql.avro.functions import from_avro
    return from_avro(payload, schema_json, {"mode": "PERMISSIVE"})


def encode_avro(record: Column, schema_json: str) -> Column:
    from pyspark.sql.avro.functions import to_avro
    return to_avro(record, schema_json)


def latest_schemas(versions: DataFrame) -> DataFrame:
    """Newest schema per subject, from rows (subject, version, schema)."""
    return versions.groupBy("subject").agg(
        F.max("version").alias("version"), F.max_by("schema", "version").alias("schema"))


