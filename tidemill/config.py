"""Declarations that drive the pipeline: topics and their windowed aggregation jobs.

A new data source is a new :class:`TopicConfig`; no layer code changes. A table
is either a catalog name (``db.table``) or a location (anything containing a
slash).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql.types import StructType

#: The source columns that the deduplicated layer keeps.
CARRIED_COLUMNS = ("kafka_timestamp", "ingested_at")
PROCESSED_COLUMN = "processed_timestamp"
WINDOW_COLUMNS = ("window_start", "window_end")
TABLE_FORMATS = ("parquet", "delta")
#: Buckets of a silver table unless declared otherwise. The files keep the number for good; declare
#: more where a table is to outgrow this many tasks.
SILVER_BUCKETS = 16

_SOURCE_FIELDS = (
    StructType()
    .add("partition", "integer")
    .add("offset", "long")
    .add("kafka_timestamp", "timestamp")
    .add("ingested_at", "timestamp")
    .fields
)


class ConfigError(ValueError):
    """A topic or job declaration that cannot work."""


def is_location(table: str) -> bool:
    """Locations contain a slash, catalog names do not."""
    return "/" in table


@dataclass(frozen=True)
class GoldJob:
    """One windowed aggregate: optional filter, grouping columns, alias -> SQL aggregate."""

    name: str
    aggs: Mapping[str, str]
    group_by: tuple[str, ...] = ()
    filter: str | None = None
    table: str = ""
    checkpoint: str = ""
    #: Partitions of the state, fixed by the first run; None: the session's shuffle partitions.
    state_partitions: int | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "group_by", tuple(self.group_by))
        if self.state_partitions is not None and self.state_partitions < 1:
            raise ConfigError(f"job {self.name}: state partitions must be positive")
        if not self.aggs:
            raise ConfigError(f"job {self.name}: no aggregates")
        outputs = [*WINDOW_COLUMNS, *self.group_by, *self.aggs]
        if len(set(outputs)) != len(outputs):
            raise ConfigError(f"job {self.name}: output columns repeat: {outputs}")

    @property
    def output_columns(self) -> list[str]:
        return [*WINDOW_COLUMNS, *self.group_by, *self.aggs]


@dataclass(frozen=True)
class TopicConfig:
    """One topic and the tables it flows through."""

    name: str
    kafka_topic: str
    schema_subject: str
    payload_schema: StructType
    message_key: str
    gold_jobs: tuple[GoldJob, ...] = ()
    dedup_keys: tuple[str, ...] = ("event_id",)
    topic_partitions: int = 1
    silver_columns: tuple[str, ...] = ()
    table_format: str = "parquet"
    #: Buckets of a file-based silver table by its dedup keys; 0: none.
    silver_buckets: int = SILVER_BUCKETS
    #: Shuffle partitions of a merge into a table without buckets; None: the session's.
    merge_partitions: int | None = None
    bronze_table: str = ""
    silver_table: str = ""
    quarantine_table: str = ""
    bronze_checkpoint: str = ""
    silver_checkpoint: str = ""

    def __post_init__(self) -> None:
        object.__setattr__(self, "dedup_keys", tuple(self.dedup_keys))
        object.__setattr__(self, "gold_jobs", tuple(self.gold_jobs))
        columns = tuple(self.silver_columns) or (*self.payload_schema.names, *CARRIED_COLUMNS)
        object.__setattr__(self, "silver_columns", columns)
        self._validate()

    @property
    def bronze_schema(self) -> StructType:
        return StructType([*self.payload_schema.fields, *_SOURCE_FIELDS])

    @property
    def silver_schema(self) -> StructType:
        bronze = self.bronze_schema
        columns = [bronze[c] for c in self.silver_columns]
        return StructType(columns).add(PROCESSED_COLUMN, "timestamp")

    def job(self, name: str) -> GoldJob:
        for job in self.gold_jobs:
            if job.name == name:
                return job
        raise KeyError(name)

    def at(self, root: str, table_format: str = "parquet") -> TopicConfig:
        """The same topic with every table and checkpoint placed under ``root``."""
        root = root.rstrip("/")
        marks = f"{root}/checkpoints"
        return replace(
            self,
            table_format=table_format,
            bronze_table=f"{root}/bronze/{self.name}",
            silver_table=f"{root}/silver/{self.name}",
            quarantine_table=f"{root}/quarantine/{self.name}",
            bronze_checkpoint=f"{marks}/bronze_{self.name}",
            silver_checkpoint=f"{marks}/silver_{self.name}",
            gold_jobs=tuple(
                replace(j, table=f"{root}/gold/{j.name}", checkpoint=f"{marks}/gold_{j.name}")
                for j in self.gold_jobs
            ),
        )

    def in_catalog(
        self, namespace: str, checkpoint_root: str, table_format: str = "parquet"
    ) -> TopicConfig:
        """The same topic with tables named in the catalog, checkpoints under a folder."""
        marks = checkpoint_root.rstrip("/")
        return replace(
            self,
            table_format=table_format,
            bronze_table=f"{namespace}.bronze_{self.name}",
            silver_table=f"{namespace}.silver_{self.name}",
            quarantine_table=f"{namespace}.quarantine_{self.name}",
            bronze_checkpoint=f"{marks}/bronze_{self.name}",
            silver_checkpoint=f"{marks}/silver_{self.name}",
            gold_jobs=tuple(
                replace(
                    j, table=f"{namespace}.gold_{j.name}", checkpoint=f"{marks}/gold_{j.name}"
                )
                for j in self.gold_jobs
            ),
        )

    def _validate(self) -> None:
        unknown = set(self.silver_columns) - set(self.bronze_schema.names)
        if unknown:
            raise ConfigError(f"topic {self.name}: bronze has no columns {sorted(unknown)}")
        bronze, silver = set(self.bronze_schema.names), set(self.silver_schema.names)
        if len(bronze) != len(self.bronze_schema.names):
            raise ConfigError(f"topic {self.name}: payload repeats a column or a source column")
        if not self.dedup_keys or not set(self.dedup_keys) <= set(self.silver_columns):
            raise ConfigError(f"topic {self.name}: dedup keys must be silver columns")
        if self.message_key not in self.payload_schema.names:
            raise ConfigError(f"topic {self.name}: message key is not a payload column")
        if "timestamp_ms" not in self.silver_columns:
            raise ConfigError(f"topic {self.name}: silver needs timestamp_ms for event time")
        if self.silver_buckets < 0:
            raise ConfigError(f"topic {self.name}: silver buckets cannot be negative")
        if self.table_format not in TABLE_FORMATS:
            raise ConfigError(f"topic {self.name}: table format {self.table_format!r}")
        for job in self.gold_jobs:
            if not set(job.group_by) <= silver:
                raise ConfigError(f"job {job.name}: groups by a column silver does not have")
        for label, values in (
            ("job names", [j.name for j in self.gold_jobs]),
            ("tables", [self.bronze_table, self.silver_table, *(j.table for j in self.gold_jobs)]),
            (
                "checkpoints",
                [
                    self.bronze_checkpoint,
                    self.silver_checkpoint,
                    *(j.checkpoint for j in self.gold_jobs),
                ],
            ),
        ):
            used = [v for v in values if v]
            if len(set(used)) != len(used):
                raise ConfigError(f"topic {self.name}: {label} repeat")


def topic_from_mapping(
    name: str, entry: Mapping, payload_schema: StructType, message_key: str
) -> TopicConfig:
    """Read a topic from a plain nested mapping (dict, parsed JSON or YAML).

    Expected keys: ``kafka_topic``, ``schema_subject``, ``bronze_table``,
    ``silver_table``, ``dedup_keys``, ``silver_columns``, ``bronze_checkpoint``,
    ``silver_checkpoint`` and ``gold_jobs``; each job has ``name``,
    ``gold_table``, ``checkpoint``, ``group_by``, ``aggs`` and perhaps ``filter`` and
    ``state_partitions``; ``merge_partitions``, ``silver_buckets`` and ``table_format`` are optional.
    """
    jobs = tuple(
        GoldJob(
            name=j["name"],
            aggs=dict(j["aggs"]),
            group_by=tuple(j["group_by"]),
            filter=j.get("filter"),
            table=j["gold_table"],
            checkpoint=j["checkpoint"],
            state_partitions=j.get("state_partitions"),
        )
        for j in entry["gold_jobs"]
    )
    return TopicConfig(
        name=name,
        kafka_topic=entry["kafka_topic"],
        schema_subject=entry["schema_subject"],
        payload_schema=payload_schema,
        message_key=message_key,
        gold_jobs=jobs,
        dedup_keys=tuple(entry["dedup_keys"]),
        silver_columns=tuple(entry["silver_columns"]),
        table_format=entry.get("table_format", "parquet"),
        merge_partitions=entry.get("merge_partitions"),
        silver_buckets=entry.get("silver_buckets", SILVER_BUCKETS),
        bronze_table=entry["bronze_table"],
        silver_table=entry["silver_table"],
        bronze_checkpoint=entry["bronze_checkpoint"],
        silver_checkpoint=entry["silver_checkpoint"],
    )
