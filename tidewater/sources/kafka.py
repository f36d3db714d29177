"""Kafka stream source options.

The ``spark-sql-kafka`` package must be on the classpath to run these; the
option builders are pure Python and are unit-tested on their own.
Secrets are never printed or logged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Fixed values of the reference's consumer: TLS + SASL, start at the latest
# offsets, fetch at most 1 MiB per partition per request.
SECURITY_PROTOCOL = "SASL_SSL"
STARTING_OFFSETS = "latest"
MAX_PARTITION_FETCH_BYTES = 1024 * 1024
PLAIN_LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"


@dataclass(frozen=True)
class PlainAuth:
    username: str
    password: str

    def __repr__(self) -> str:  # never show the password
        return f"PlainAuth(username={self.username!r}, password=***)"


@dataclass(frozen=True)
class SaslModuleAuth:
    """Any other SASL login module, e.g. a cloud resource-principal module.

    ``options`` are rendered as ``key="value"`` pairs of the JAAS entry.
    """

    mechanism: str
    login_module: str
    options: tuple[tuple[str, str], ...] = ()


def _jaas(module: str, options: list[tuple[str, str]]) -> str:
    parts = [module, "required"]
    for key, value in options:
        escaped = value.replace("\\", "\\\\").replace('"', '\\"')
        parts.append(f'{key}="{escaped}"')
    return " ".join(parts) + ";"


def kafka_auth_options(auth: PlainAuth | SaslModuleAuth) -> dict[str, str]:
    if isinstance(auth, PlainAuth):
        return {
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": _jaas(
                PLAIN_LOGIN_MODULE,
                [("username", auth.username), ("password", auth.password)],
            ),
        }
    if isinstance(auth, SaslModuleAuth):
        return {
            "kafka.sasl.mechanism": auth.mechanism,
            "kafka.sasl.jaas.config": _jaas(auth.login_module, list(auth.options)),
        }
    raise TypeError(f"unsupported auth: {type(auth).__name__}")


def kafka_source_options(
    bootstrap_servers: str,
    topics: str,
    auth: PlainAuth | SaslModuleAuth | None = None,
    starting_offsets: str = STARTING_OFFSETS,
    max_partition_fetch_bytes: int = MAX_PARTITION_FETCH_BYTES,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options for ``spark.readStream.format("kafka")``.

    ``min_partitions`` splits large offset ranges of one topic partition over
    several tasks: messages keyed by one time key all land in one (hot) topic
    partition, which would otherwise be read by a single task.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topics,
        "startingOffsets": starting_offsets,
        "kafka.max.partition.fetch.bytes": str(max_partition_fetch_bytes),
    }
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        opts["minPartitions"] = str(min_partitions)
    if auth is not None:
        opts["kafka.security.protocol"] = SECURITY_PROTOCOL
        opts.update(kafka_auth_options(auth))
    return opts


KAFKA_PACKAGE_HINT = (
    "the Kafka source needs the spark-sql-kafka package on the classpath "
    "(spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_<scala>:<spark>)"
)


def read_kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Streaming envelope (key, value, topic, partition, offset, timestamp, ...)."""
    try:
        return spark.readStream.format("kafka").options(**options).load()
    except Exception as exc:
        if "kafka" in str(exc).lower() and "data source" in str(exc).lower():
            raise RuntimeError(KAFKA_PACKAGE_HINT) from exc
        raise
