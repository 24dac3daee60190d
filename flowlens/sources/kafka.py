"""Kafka options in one place.

The connector package must be on the class path of the cluster; no broker is available to the tests, so
only the option maps are tested.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class KafkaTarget:
    servers: str
    topic: str
    username: str | None = None
    password: str | None = None
    protocol: str = "SASL_PLAINTEXT"
    mechanism: str = "SCRAM-SHA-512"

    #: PEM file of the authority that signed the brokers' certificates, on every node.
    ca_file: str | None = None

    def security(self) -> dict[str, str]:
        trust = {"kafka.ssl.truststore.type": "PEM", "kafka.ssl.truststore.location": self.ca_file} if self.ca_file else {}
        if not (self.username and self.password):
            return {"kafka.security.protocol": "SSL" if trust else "PLAINTEXT", **trust}
        login = (
            "org.apache.kafka.common.security.scram.ScramLoginModule"
            if self.mechanism.startswith("SCRAM")
            else "org.apache.kafka.common.security.plain.PlainLoginModule"
        )
        return {
            "kafka.security.protocol": self.protocol,
            "kafka.sasl.mechanism": self.mechanism,
            "kafka.sasl.jaas.config": (
                f'{login} required username="{self.username}" password="{self.password}";'
            ),
            **trust,
        }


#: Messages of a micro-batch: the first one is not the whole topic.
MAX_OFFSETS = 5_000_000


def source_options(
    target: KafkaTarget, min_partitions: int | None = None, max_offsets: int = MAX_OFFSETS
) -> dict[str, str]:
    """Earliest offset, committed messages only, bounded batches. Progress lives in the stream checkpoint."""
    options = {
        "maxOffsetsPerTrigger": str(max_offsets),
        "kafka.bootstrap.servers": target.servers,
        "subscribe": target.topic,
        "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed",
        "failOnDataLoss": "true",
        **target.security(),
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def sink_options(target: KafkaTarget) -> dict[str, str]:
    """Acknowledged by all replicas, idempotent producer: at-least-once end to end."""
    return {
        "kafka.bootstrap.servers": target.servers,
        "topic": target.topic,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
        "kafka.compression.type": "gzip",
        "kafka.linger.ms": "5",
        **target.security(),
    }


def kafka_messages(spark: SparkSession, target: KafkaTarget, min_partitions: int | None = None) -> DataFrame:
    """(key, value, topic, partition, offset, time) of a topic as a stream; one task per topic partition, or at least `min_partitions`."""
    topic = spark.readStream.format("kafka").options(**source_options(target, min_partitions)).load()
    texts = [F.col(c).cast("string").alias(c) for c in ("key", "value")]
    return topic.select(*texts, "topic", "partition", "offset", F.col("timestamp").alias("time"))


def publish(messages: DataFrame, target: KafkaTarget) -> None:
    """Publish a batch of (key, value) rows."""
    messages.write.format("kafka").options(**sink_options(target)).save()
