"""Declared sources (S9): a YAML file lists database queries and files,
each with a name and a raw-zone target.

Shape::

    rdbms:
      type: postgres
      host: db.example
      port: 5432
      database: shop
      username: reader
      sources:
        - {name: customers_from_db, query: "SELECT * FROM customers",
           target: raw/rdbms/customers/customers_from_db.csv}
    files:
      - {name: customers_from_csv, source_type: csv,
         path: input/customers.csv, target: raw/csv/customers/customers_from_csv.csv}
"""

from __future__ import annotations

from dataclasses import dataclass, field

import yaml
from pyspark.sql import SparkSession

from sparkmart.sources.jdbc import postgres_url


@dataclass
class SourceSpec:
    name: str
    source_type: str  # rdbms | csv | xlsx | parquet
    target: str
    path: str | None = None
    query: str | None = None
    jdbc_url: str | None = None
    jdbc_user: str | None = None
    options: dict = field(default_factory=dict)


def parse_sources(cfg: dict) -> list[SourceSpec]:
    """Database sources first, then files, each in listed order."""
    specs: list[SourceSpec] = []
    rdbms = cfg.get("rdbms") or {}
    if rdbms:
        url = rdbms.get("url") or postgres_url(rdbms["host"], rdbms["port"], rdbms["database"])
        for s in rdbms.get("sources", []):
            specs.append(
                SourceSpec(
                    name=s["name"], source_type="rdbms", target=s["target"], query=s["query"],
                    jdbc_url=url, jdbc_user=rdbms.get("username"),
                    options={k: v for k, v in s.items() if k not in ("name", "query", "target")},
                )
            )
    for s in cfg.get("files", []) or []:
        specs.append(
            SourceSpec(name=s["name"], source_type=s["source_type"], target=s["target"], path=s["path"])
        )
    return specs


def load_sources(path: str, spark: SparkSession | None = None) -> list[SourceSpec]:
    """The sources that the file at ``path`` declares: a local file, or with
    ``spark`` one (or a folder with one) in any store that Spark reads."""
    if spark is not None:
        rows = spark.read.text(path, wholetext=True).collect()
        return parse_sources(yaml.safe_load("\n".join(r["value"] for r in rows)) or {})
    with open(path, encoding="utf-8") as fh:
        return parse_sources(yaml.safe_load(fh) or {})


@dataclass
class StorageSpec:
    """Where the raw zone lives: ``endpoint`` (S3-compatible), ``bucket``, ``secure``."""
    bucket: str
    endpoint: str | None = None
    secure: bool = False

    @property
    def base_uri(self) -> str:
        return f"s3a://{self.bucket}"


def load_storage(path: str) -> StorageSpec:
    """Storage settings file: ``endpoint``, ``bucket``, ``secure`` (keys
    are passed to the session separately, never stored in the file)."""
    with open(path, encoding="utf-8") as fh:
        cfg = yaml.safe_load(fh) or {}
    return StorageSpec(bucket=cfg["bucket"], endpoint=cfg.get("endpoint"),
                       secure=bool(cfg.get("secure", False)))
