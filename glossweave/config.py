"""Where data lies: session settings, else environment variables, else defaults."""

from __future__ import annotations

import os
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Config:
    """``glossweave.data.path`` (GLOSSWEAVE_DATA_PATH), ``.cache.dir``, ``.pages.dir``, ``.remote.url``."""

    data_path: str | None
    cache_dir: str
    pages_dir: str
    remote_url: str | None

    @classmethod
    def of(cls, spark: SparkSession | None = None) -> "Config":
        def value(name: str, default: str | None) -> str | None:
            set_to = spark.conf.get(f"glossweave.{name}", None) if spark is not None else None
            return set_to or os.environ.get("GLOSSWEAVE_" + name.upper().replace(".", "_")) or default

        home = Path.home() / ".cache" / "glossweave"
        return cls(value("data.path", None), value("cache.dir", str(home)), value("pages.dir", str(home / "pages")), value("remote.url", None))
