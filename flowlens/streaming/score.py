"""Event stream in, prediction stream and quarantine out.

Stateless per micro-batch. Delivery: each batch fills its own folder and then writes its commit record (see `commits`), by
which readers go: a batch cut off half way is not seen, and a batch that is replayed after its record is left as it is (exactly once in
the tables); a Kafka sink is at-least-once. Batch numbers start anew with each checkpoint, so the folder also names the
checkpoint's query id. Records keep how many rows a batch gave each output, observed while they were written, and how long it took.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..sources.events import check_events, flatten_events, parse_messages, rejected_messages
from ..sources.kafka import KafkaTarget, publish
from .commits import batch_folder, commit_batch, is_committed, read_committed, records

Scorer = Callable[[DataFrame], DataFrame]
Step = Callable[[DataFrame], DataFrame]

MESSAGE_SCHEMA = "key string, value string"
POSITION_SCHEMA = "topic string, partition int, offset long, time timestamp"


def file_messages(spark: SparkSession, path: str, files_per_batch: int | None = None, positions: bool = False) -> DataFrame:
    """(key, value) messages from Parquet files in a folder, with their positions if the files have them; new files as they arrive."""
    reader = spark.readStream.schema(f"{MESSAGE_SCHEMA}, {POSITION_SCHEMA}" if positions else MESSAGE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def text_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON-lines files as messages without a key."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).select(F.lit(None).cast("string").alias("key"), "value")


def predictions(flows: DataFrame, score: Scorer, model: dict[str, str]) -> DataFrame:
    """(key, value): the prediction as JSON under the key of its input."""
    scored = score(flows)
    about = F.struct(*[F.lit(v).alias(k) for k, v in model.items()])
    fields = [F.col("prediction")]
    if "probabilities" in scored.columns:
        fields.append(F.col("probabilities"))
    return scored.select("key", F.to_json(F.struct(*fields, about.alias("model"))).alias("value"))


def deliver(
    batch: DataFrame,
    batch_id: int,
    outputs: dict[str, Step],
    topics: Sequence[tuple[KafkaTarget, Step]] = (),
    run: str = "batch",
    parse: Step = parse_messages,
) -> None:
    """Decode once, then write what each step makes of the batch below its own folder, or to its topic."""
    spark = batch.sparkSession
    waiting = {p: s for p, s in outputs.items() if not is_committed(records(spark, p), run, batch_id)}
    if not waiting and not topics:
        return
    began = time.perf_counter()
    parsed = parse(batch).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for target, step in topics:
            publish(step(parsed), target)
        for path, step in waiting.items():
            seen = Observation()
            rows = step(parsed).observe(seen, F.count(F.lit(1)).alias("rows"))
            rows.write.mode("overwrite").parquet(batch_folder(path, run, batch_id))
            commit_batch(spark, path, run, batch_id, seen.get["rows"], 1000 * (time.perf_counter() - began))
    finally:
        parsed.unpersist()


def batch_stream(
    messages: DataFrame,
    outputs: dict[str, Step],
    checkpoint: str,
    topics: Sequence[tuple[KafkaTarget, Step]] = (),
    parse: Step = parse_messages,
) -> DataStreamWriter:
    """A configured writer; start it with the trigger of your choice."""
    runs: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not runs:
            runs.append(query_id(batch.sparkSession, checkpoint))
        deliver(batch, batch_id, outputs, topics, runs[0], parse)

    return messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark writes into a checkpoint when it is made; restarts keep it."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def decode_stream(messages: DataFrame, output: str, quarantine: str, checkpoint: str) -> DataStreamWriter:
    """Flow rows to `output`, undecodable messages to `quarantine`."""
    return batch_stream(messages, {output: flatten_events, quarantine: rejected_messages}, checkpoint)


def scoring_stream(
    messages: DataFrame, score: Scorer, output: str, quarantine: str, checkpoint: str, model: dict[str, str],
    checked: bool = False,
) -> DataStreamWriter:
    """JSON predictions to `output`, undecodable messages to `quarantine`; `checked`: those that break a rule or have no
    readable time as well."""
    outputs = {
        output: lambda parsed: predictions(flatten_events(parsed), score, model),
        quarantine: rejected_messages,
    }
    return batch_stream(messages, outputs, checkpoint, parse=parse_and_check if checked else parse_messages)


def parse_and_check(messages: DataFrame) -> DataFrame:
    return check_events(parse_messages(messages))


def topic_scoring_stream(
    messages: DataFrame, score: Scorer, sink: KafkaTarget, quarantine: str, checkpoint: str, model: dict[str, str]
) -> DataStreamWriter:
    """JSON predictions to a topic, undecodable messages to `quarantine`."""
    answers = (sink, lambda parsed: predictions(flatten_events(parsed), score, model))
    return batch_stream(messages, {quarantine: rejected_messages}, checkpoint, [answers])


def run_available(writer: DataStreamWriter) -> None:
    """Process what is there, then stop: progress stays in the checkpoint."""
    writer.trigger(availableNow=True).start().awaitTermination()


def run_continuously(writer: DataStreamWriter, interval: str = "1 second") -> StreamingQuery:
    """Keep polling; `stop()` on the result ends it after the running batch."""
    return writer.trigger(processingTime=interval).start()


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What a stream has delivered so far: complete batches alone."""
    return read_committed(spark, path, schema)
