"""All-or-nothing publishing of a set of tables on plain files.

A refresh writes ``<root>/version=<id>/<table>`` and, once the new version has
passed its checks, one small marker under ``<root>/published``. Readers follow
the marker published last, so they see the old version or the new one and never a mix,
and a refresh that fails leaves no trace they can see.

A marker is a manifest: it names the version that holds each small table, and for each fact
the version that holds each year, with the year's rows and a digest of them. So a version
writes the years that changed and takes the others over. ``remove_unreachable`` deletes the
folders that none of the kept versions names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import astuple, dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse.scratch import delete, folders

_STAMP = "%Y%m%dT%H%M%S%f"
_PARTS = "array<struct<table_name: string, year: int, version: string, n_rows: bigint, digest: string>>"


@dataclass(frozen=True)
class Part:
    """One year of a fact: the version whose folder holds it, its rows and their digest."""

    table_name: str
    year: int
    version: str
    n_rows: int
    digest: str


@dataclass(frozen=True)
class Manifest:
    """A published version: tables it takes from earlier ones, and where each year of a fact lies."""

    version: str
    tables: dict[str, str] = field(default_factory=dict)
    parts: tuple[Part, ...] = ()
    published_at: str = ""

    def years(self, table: str) -> dict[int, Part]:
        return {p.year: p for p in self.parts if p.table_name == table}

    def holds(self) -> set[tuple[str, str]]:
        """(version, folder below it) of all that the version reads, other than its own tables."""
        years = {(p.version, f"{p.table_name}/year_val={p.year}") for p in self.parts}
        return years | {(version, table) for table, version in self.tables.items()}


def new_version() -> str:
    """Sorts by creation time."""
    return f"{datetime.now(timezone.utc):{_STAMP}}-{uuid.uuid4().hex[:8]}"


def version_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/version={version}"


def publish(
    summary: DataFrame, root: str, version: str, tables: dict[str, str] | None = None, parts: Iterable[Part] = ()
) -> None:
    """Write the marker; ``summary`` is the one-row outcome kept with it.

    ``tables`` names the tables that this version takes over from an earlier one, and
    that version; ``parts`` says where the years of the facts lie. The marker bears the time of publishing: of two refreshes that overlap,
    the one that was published last is current, whichever began first.
    """
    taken = F.create_map(*[F.lit(x) for pair in (tables or {}).items() for x in pair]) if tables else F.lit(None)
    now = f"{datetime.now(timezone.utc):{_STAMP}}"
    # A few hundred years of three facts, whatever the data.
    listed = F.array(*[F.struct(*[F.lit(x) for x in astuple(part)]) for part in parts]).cast(_PARTS)
    marker = summary.withColumns(
        {"version": F.lit(version), "published_at": F.lit(now), "tables": taken.cast("map<string,string>"), "parts": listed}
    )
    marker.coalesce(1).write.mode("append").json(f"{root.rstrip('/')}/published")


def manifests(spark: SparkSession, root: str) -> list[Manifest]:
    """All published versions, the current one last; one marker a version."""
    try:
        markers = spark.read.schema(f"version string, published_at string, tables map<string,string>, parts {_PARTS}").json(
            f"{root.rstrip('/')}/published"
        )
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    found = [
        Manifest(r.version, r.tables or {}, tuple(Part(*p) for p in r.parts or ()), r.published_at or r.version)
        for r in markers.collect()
    ]
    return sorted(found, key=lambda m: (m.published_at, m.version))


def published(spark: SparkSession, root: str) -> Manifest | None:
    """The current version; None before the first."""
    found = manifests(spark, root)
    return found[-1] if found else None


def published_version(spark: SparkSession, root: str) -> str | None:
    found = published(spark, root)
    return found.version if found else None


def remove_unreachable(spark: SparkSession, root: str, keep: int = 2, older_than: timedelta = timedelta(days=7)) -> list[str]:
    """Delete the folders that none of the last ``keep`` versions reads; returns their paths.

    A published version goes when it has been superseded for ``older_than``, which is to be
    longer than any reader runs; what is not published, the leftovers of a failed refresh or a
    refresh that is still running, when it began that long ago. Of a version that a kept one
    takes something over from, the rest goes. Listings grow with versions, tables and years.
    """
    if keep < 1:
        raise ValueError("at least the current version is kept")
    known = manifests(spark, root)
    bound = f"{datetime.now(timezone.utc) - older_than:{_STAMP}}"
    superseded = {m.version: later.published_at for m, later in zip(known, known[1:])}
    kept = known[-keep:]
    # Versions that are not kept but were current within the bound may still be read.
    read = [m for m in known if m in kept or superseded.get(m.version, bound) >= bound]
    whole = {m.version for m in read}
    held = {x for m in read for x in m.holds()}
    needed = held | {(version, folder.split("/")[0]) for version, folder in held}
    gone: list[str] = []
    base = root.rstrip("/")
    for name in folders(spark, base):
        if not name.startswith("version="):
            continue
        version = name.removeprefix("version=")
        since = superseded.get(version, version)
        if version in whole or since >= bound:
            continue
        if not any(v == version for v, _ in needed):
            gone.append(f"{base}/{name}")
            continue
        for table in folders(spark, f"{base}/{name}"):
            if (version, table) not in needed:
                gone.append(f"{base}/{name}/{table}")
            elif (version, table) not in held:
                years = folders(spark, f"{base}/{name}/{table}")
                gone += [f"{base}/{name}/{table}/{y}" for y in years if (version, f"{table}/{y}") not in held]
    for path in gone:
        delete(spark, path)
    return gone


def published_summary(spark: SparkSession, root: str, version: str, schema: str) -> DataFrame:
    """What :func:`publish` kept with a version."""
    markers = spark.read.schema(f"{schema}, version string").json(f"{root.rstrip('/')}/published")
    return markers.filter(F.col("version") == version).drop("version")
