"""Versions of the warehouse tables.

A load stages every table in a folder of its own, ``versions/<run>/<table>``, good and rejected rows apart.
Readers see nothing of it until ``publish``: one small file, ``versions/published-<run>.json``, names the folder of
each table, and is the commit. Tables that a load leaves out keep the folder they had. A load that fails
leaves the former tables as they are; folders that the last snapshots do not name are removed by the next
publish.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from ..session import delete_path, join_location, list_names, read_text, write_text

GOOD, REJECTED_PART = "good", "rejected"


@dataclass
class TableVersion:
    """What is known of a staged table: its folder below the database's, and what the write counted."""

    table: str
    folder: str
    rows: int = 0
    rejected: int = 0
    # (check name, column, bad rows) of the gates before the load.
    gates: list[tuple[str, str, int]] = field(default_factory=list)
    # Fingerprints of the inputs it was made of, if known.
    inputs: dict[str, str] | None = None


@dataclass
class Snapshot:
    run: str
    tables: dict[str, TableVersion]
    # Rows and fingerprint of each source.
    sources: dict[str, dict] = field(default_factory=dict)


def new_run() -> str:
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def db_location(spark: SparkSession, db: str) -> str:
    if spark.catalog.databaseExists(db):
        return spark.catalog.getDatabase(db).locationUri
    return join_location(spark.conf.get("spark.sql.warehouse.dir"), f"{db}.db")


def _published(spark: SparkSession, location: str) -> list[str]:
    names = list_names(spark, join_location(location, "versions"))
    return [n for n in names if n.startswith("published-") and n.endswith(".json")]


def _read(spark: SparkSession, location: str, name: str) -> Snapshot:
    raw = json.loads(read_text(spark, join_location(location, "versions", name)))
    tables = {t: TableVersion(**{**v, "gates": [tuple(g) for g in v["gates"]]}) for t, v in raw["tables"].items()}
    return Snapshot(raw["run"], tables, raw["sources"])


def current_snapshot(spark: SparkSession, location: str) -> Snapshot | None:
    """The last published snapshot of a database folder."""
    names = _published(spark, location)
    return _read(spark, location, names[-1]) if names else None


def publish(spark: SparkSession, location: str, snapshot: Snapshot, keep: int = 2) -> None:
    """Make the snapshot the current one and remove what the last ``keep`` do not name."""
    write_text(spark, join_location(location, "versions", f"published-{snapshot.run}.json"),
               json.dumps(asdict(snapshot)))
    names = _published(spark, location)
    kept = [_read(spark, location, n) for n in names[-keep:]]
    for old in names[:-keep]:
        delete_path(spark, join_location(location, "versions", old))
    used = {v.folder.split("/")[1] for s in kept for v in s.tables.values()} | {s.run for s in kept}
    for run in list_names(spark, join_location(location, "versions")):
        if not run.startswith((".", "published-")) and run < snapshot.run and run not in used:
            delete_path(spark, join_location(location, "versions", run))
    for run in used:  # folders of tables that later loads wrote anew
        named = {v.folder for s in kept for v in s.tables.values()}
        for table in list_names(spark, join_location(location, "versions", run)):
            if f"versions/{run}/{table}" not in named:
                delete_path(spark, join_location(location, "versions", run, table))


def discard(spark: SparkSession, location: str, run: str) -> None:
    """Remove the folders of a load that is not published."""
    delete_path(spark, join_location(location, "versions", run))
