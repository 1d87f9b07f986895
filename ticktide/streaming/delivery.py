"""Outcome per message: what a broker would refuse goes to a table of its own.

A Kafka sink fails the whole batch over one message that the broker refuses, and
fails it again after each restart. The rules of the protocol are checked before
sending: refused messages are kept with the reason, all others are sent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ticktide.streaming.commits import CommitLog, Handler, committed

LEGAL_TOPIC = r"^[A-Za-z0-9._-]{1,249}$"
MAX_BYTES = 1_048_576  # the producer's default for one request


def message_bytes(headers: bool = True) -> Column:
    """Bytes of key, value and headers of an envelope; what is missing has none."""
    def length(part: Column) -> Column:
        return F.coalesce(F.octet_length(part), F.lit(0)).cast("long")
    size = length(F.col("key")) + length(F.col("value"))
    if not headers:
        return size
    return size + F.aggregate(
        F.coalesce("headers", F.array()), F.lit(0).cast("long"),
        lambda total, h: total + length(h["key"]) + length(h["value"]))


def refusal(messages: DataFrame, max_bytes: int = MAX_BYTES, compacted: bool = False) -> Column:
    """Why a message cannot be delivered, null where it can.

    ``messages`` has the layout of `tables.envelope`; headers may be absent. A null
    value is a deletion mark, which needs a key. A compacted topic needs keys always.
    """
    topic, key = F.col("topic"), F.col("key")
    nothing = F.col("value").isNull()
    reason = (F.when(topic.isNull(), "no topic")
              .when(~topic.rlike(LEGAL_TOPIC) | topic.isin(".", ".."), "illegal topic name")
              .when(key.isNull() & (F.lit(compacted) | nothing), "no key"))
    if "headers" in messages.columns:
        reason = reason.when(F.exists(F.coalesce("headers", F.array()), lambda h: h["key"].isNull()),
                             "header without a key")
    return reason.when(message_bytes("headers" in messages.columns) > max_bytes, "message too large")


def delivered(send: Handler, path: str, max_bytes: int = MAX_BYTES, compacted: bool = False) -> Handler:
    """A batch sink that sends what can be delivered and keeps the rest below ``path``.

    ``send`` writes a batch so that writing it again under the same id changes
    nothing. The batch counts after both writes, by one entry of the log, which
    also holds the two numbers. They are counted from the batch, not by the writes:
    a sender that has the batch already writes nothing. When sending fails the
    batch is not committed and runs again whole.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        log = CommitLog(batch.sparkSession, path)
        if batch_id in log.batches():
            return
        marked = batch.withColumn("refusal", refusal(batch, max_bytes, compacted)).persist()
        try:
            (marked.where(F.col("refusal").isNotNull())
             .write.mode("overwrite").parquet(f"{log.data}/batch={batch_id}"))
            send(marked.where(F.col("refusal").isNull()).drop("refusal"), batch_id)
            messages, refused = marked.agg(F.count("*"), F.count("refusal")).first()
        finally:
            marked.unpersist()
        log.commit(batch_id, {"delivered": messages - refused, "refused": refused})

    return handle


def undelivered(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The refused messages of all finished batches, with the reason in ``refusal``."""
    return committed(spark, path, T.StructType([*schema.fields, T.StructField("refusal", T.StringType())]))


def outcomes(spark: SparkSession, path: str) -> list[dict]:
    """Messages sent and refused by finished batch, in order."""
    log = CommitLog(spark, path)
    return [{"batch": b, **log.read(b)} for b in log.batches()]
