"""Settings of a remodelling run."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

# Fixed value: the largest document a collection takes.
DOCUMENT_LIMIT_BYTES = 16 * 1024 * 1024

# Documents per batch where a loader inserts batch by batch.
BATCH_SIZE = 5000


@dataclass(frozen=True)
class SourceConfig:
    """Where the tables come from: a Parquet folder, or a database over JDBC."""

    parquet_path: str | None = None
    use_jdbc: bool = False
    jdbc_url: str | None = None
    jdbc_user: str | None = None
    jdbc_password: str | None = None
    jdbc_driver: str = "com.mysql.cj.jdbc.Driver"
    jdbc_options: Mapping[str, str] = field(default_factory=dict)
    keys_per_stride: int = 300_000

    # Names of the variables, and the driver and cursor setting of a connection.
    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> "SourceConfig":
        return cls(
            parquet_path=env.get("TPCH_PARQUET_PATH"),
            use_jdbc=env.get("TPCH_USE_JDBC", "false").lower() == "true",
            jdbc_url=env.get("TPCH_JDBC_URL"),
            jdbc_user=env.get("TPCH_JDBC_USER"),
            jdbc_password=env.get("TPCH_JDBC_PASSWORD"),
            jdbc_driver=env.get("TPCH_JDBC_DRIVER", cls.jdbc_driver),
        )

    def connection(self) -> dict[str, str]:
        """JDBC connection options; a missing credential is an error."""
        if not (self.jdbc_url and self.jdbc_user and self.jdbc_password):
            raise ValueError("a JDBC source needs a url, a user and a password")
        joiner = "&" if "?" in self.jdbc_url else "?"
        return {
            "url": f"{self.jdbc_url}{joiner}useCursorFetch=true",
            "user": self.jdbc_user,
            "password": self.jdbc_password,
            "driver": self.jdbc_driver,
            **self.jdbc_options,
        }


@dataclass(frozen=True)
class PipelineConfig:
    """Folders, formats and sizes of a run. All folders must be shared by the executors."""

    source: SourceConfig
    staging_path: str
    documents_path: str
    wide_path: str
    document_format: str = "parquet"
    wide_format: str = "parquet"
    document_connector: Mapping[str, str] | None = None
    wide_connector: Mapping[str, str] | None = None
    truncate_wide: bool = True
    partitions: int | None = None
    wide_buckets: int | None = None
    input_bytes: int | None = None
    batch_size: int | None = None
    document_limit: int = DOCUMENT_LIMIT_BYTES
