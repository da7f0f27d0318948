"""Connection settings, read once from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class StreamConfig:
    """Where a replay writes to and a loader reads from."""

    base_path: str = "hdfs://namenode:8020"
    kafka_bootstrap: str = "localhost:9092"
    kafka_topic: str = "chartevents_stream"
    kafka_group: str = "chartevents-loader"
    kafka_offset_reset: str = "latest"
    kafka_checkpoint: str | None = None
    rows_per_second: int = 2
    pg_host: str = "localhost"
    pg_port: int = 5432
    pg_db: str = "database"
    pg_user: str = "username"
    pg_password: str = "password"
    pg_table: str = "chartevents_stream"

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> StreamConfig:
        env = os.environ if env is None else env
        return cls(
            base_path=env.get("HDFS_PATH", cls.base_path),
            kafka_bootstrap=env.get("KAFKA_BOOTSTRAP", cls.kafka_bootstrap),
            kafka_topic=env.get("KAFKA_TOPIC", cls.kafka_topic),
            kafka_group=env.get("KAFKA_GROUP_ID", cls.kafka_group),
            kafka_offset_reset=env.get("KAFKA_AUTO_OFFSET_RESET", cls.kafka_offset_reset),
            kafka_checkpoint=env.get("KAFKA_CHECKPOINT", cls.kafka_checkpoint),
            rows_per_second=int(env.get("ROWS_PER_SECOND", cls.rows_per_second)),
            pg_host=env.get("PG_HOST", cls.pg_host),
            pg_port=int(env.get("PG_PORT", cls.pg_port)),
            pg_db=env.get("PG_DB", cls.pg_db),
            pg_user=env.get("PG_USER", cls.pg_user),
            pg_password=env.get("PG_PASS", cls.pg_password),
            pg_table=env.get("PG_TABLE", cls.pg_table),
        )

    @property
    def tables(self) -> str:
        """Folder of the Parquet tables."""
        return f"{self.base_path.rstrip('/')}/data"

    @property
    def jdbc_url(self) -> str:
        return f"jdbc:postgresql://{self.pg_host}:{self.pg_port}/{self.pg_db}"
