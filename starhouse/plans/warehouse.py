"""Access to the tables of one warehouse: staging, dimensions, facts.

Two kinds share the interface. A *derived* warehouse builds each table from its
staging source the first time it is asked for and keeps it as Parquet in the
shared folder, so later queries read a partitioned, column-pruned table instead
of repeating the load. A *published* warehouse reads the version a refresh made
current.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Collection
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starhouse.operators.loading import build_country_dim, load_fact
from starhouse.parallel import run_together
from starhouse.profile import Profile
from starhouse.schemas import (
    COMM_FACT,
    COUNTRY_SCHEMA,
    FACTS,
    HEALTH_FACT,
    NCD_FACT,
    STATIC_DIMS,
    STG_COUNTRY,
    FactSpec,
    staging_schema,
)
from starhouse.scratch import scratch_path
from starhouse.sinks.files import write_fact, write_table
from starhouse.sinks.versions import Manifest, published, version_path
from starhouse.sources.literal import static_dim

Stage = Callable[[str], DataFrame]
REJECTS_SCHEMA = "table_name STRING, row_key STRING, value STRING, reason STRING, record_id BINARY"


class Warehouse:
    """Tables by name; ``fact``, ``dim`` and ``stg`` return DataFrames."""

    def __init__(self, spark: SparkSession, profile: Profile):
        self.spark = spark
        self.profile = profile
        self._frames: dict[str, DataFrame] = {}

    def _frame(self, name: str, read: Callable[[], DataFrame]) -> DataFrame:
        """Tables never change under a name, so one DataFrame per table is enough:
        its files are listed and its schema resolved once."""
        if name not in self._frames:
            self._frames[name] = read()
        return self._frames[name]

    def _parquet(self, name: str, schema: StructType | str, path: str) -> DataFrame:
        return self._frame(name, lambda: self.spark.read.schema(schema).parquet(path))

    def stg(self, table: str) -> DataFrame:
        raise NotImplementedError

    def country(self) -> DataFrame:
        raise NotImplementedError

    def fact(self, spec: FactSpec) -> DataFrame:
        raise NotImplementedError

    def dim(self, name: str) -> DataFrame:
        if name == "dim_country":
            return self.country()
        return self._frame(name, lambda: static_dim(self.spark, self.profile, name))

    def dims(self) -> dict[str, DataFrame]:
        return {name: self.dim(name) for name in (*STATIC_DIMS, "dim_country")}

    @property
    def health(self) -> DataFrame:
        return self.fact(HEALTH_FACT)

    @property
    def ncd(self) -> DataFrame:
        return self.fact(NCD_FACT)

    @property
    def comm(self) -> DataFrame:
        return self.fact(COMM_FACT)


class DerivedWarehouse(Warehouse):
    """Tables built on first use from ``stage(table)`` and kept for the session."""

    def __init__(self, spark: SparkSession, profile: Profile, stage: Stage):
        super().__init__(spark, profile)
        self._stage = stage
        self._paths: dict[str, str] = {}
        self._locks: dict[str, threading.Lock] = {}
        self._guard = threading.Lock()

    def _once(self, table: str, write: Callable[[str], None]) -> str:
        """Path of a table, written by the first caller; a failed write is not remembered."""
        with self._guard:
            lock = self._locks.setdefault(table, threading.Lock())
        with lock:
            if table not in self._paths:
                path = scratch_path(self.spark, table)
                write(path)
                self._paths[table] = path
            return self._paths[table]

    def stg(self, table: str) -> DataFrame:
        path = self._once(table, lambda p: write_table(self._stage(table), p))
        return self._parquet(table, staging_schema(table), path)

    def country(self) -> DataFrame:
        path = self._once(
            "dim_country", lambda p: write_table(build_country_dim(self.stg(STG_COUNTRY)), p)
        )
        return self._parquet("dim_country", COUNTRY_SCHEMA, path)

    def fact(self, spec: FactSpec) -> DataFrame:
        def write(path: str) -> None:
            rows = load_fact(self.stg(spec.staging), spec, self.dims(), self.profile)
            write_fact(rows, spec, path)

        path = self._once(spec.name, write)
        return self._parquet(spec.name, spec.schema, path)

    def prepare(self) -> None:
        """Build all tables now, the facts side by side."""
        self.country()
        run_together(self.spark, [partial(self.fact, spec) for spec in FACTS])


class PublishedWarehouse(Warehouse):
    """The current version under ``root``, or the one of a manifest; ``stage`` is only needed for
    staging reports."""

    def __init__(
        self,
        spark: SparkSession,
        profile: Profile,
        root: str,
        stage: Stage | None = None,
        manifest: Manifest | None = None,
    ):
        super().__init__(spark, profile)
        found = manifest or published(spark, root)
        if found is None:
            raise LookupError(f"no published version under {root}")
        self.root = root
        self.manifest = found
        self.version = found.version
        self._stage = stage

    def path(self, table: str) -> str:
        """Where the version keeps a small table: its own folder, or that of the version it is taken from."""
        return f"{version_path(self.root, self.manifest.tables.get(table, self.version))}/{table}"

    def stg(self, table: str) -> DataFrame:
        if self._stage is None:
            raise LookupError("this warehouse was opened without its staging source")
        return self._stage(table)

    def country(self) -> DataFrame:
        return self._parquet("dim_country", COUNTRY_SCHEMA, self.path("dim_country"))

    def dim(self, name: str) -> DataFrame:
        if name == "dim_country":
            return self.country()
        schema = static_dim(self.spark, self.profile, name).schema
        return self._parquet(name, schema, self.path(name))

    def stored_fact(self, spec: FactSpec, years: Collection[int] | None = None) -> DataFrame:
        """The rows of a fact, or of some of its years, as its files hold them: ids count within a year."""
        held = self.manifest.years(spec.name)
        by_version: dict[str, list[int]] = {}
        for year, part in sorted(held.items()):
            if years is None or year in years:
                by_version.setdefault(part.version, []).append(year)
        frames = [self.spark.createDataFrame([], spec.schema)] if not by_version else []
        for version, own in by_version.items():
            base = f"{version_path(self.root, version)}/{spec.name}"
            read = self.spark.read.schema(spec.schema).option("basePath", base)
            frames.append(read.parquet(*[f"{base}/year_val={y}" for y in own]))
        return reduce(DataFrame.unionByName, frames)

    def year_starts(self, spec: FactSpec) -> dict[int, int]:
        """The rows of a fact before each of its years."""
        starts, total = {}, 0
        for year, part in sorted(self.manifest.years(spec.name).items()):
            starts[year] = total
            total += part.n_rows
        return starts

    def fact(self, spec: FactSpec) -> DataFrame:
        def read() -> DataFrame:
            rows = self.stored_fact(spec)
            if not (starts := self.year_starts(spec)):
                return rows
            before = F.create_map(*[F.lit(x) for pair in starts.items() for x in pair])
            return rows.withColumn("fact_id", F.col("fact_id") + before[F.col("year_val").cast("int")])

        return self._frame(spec.name, read)

    def rejects(self) -> DataFrame:
        """Rows that the refresh refused: table_name, row_key, value, reason, record_id."""
        return self._parquet("rejects", REJECTS_SCHEMA, self.path("rejects"))


__all__ = ["FACTS", "DerivedWarehouse", "PublishedWarehouse", "Stage", "Warehouse"]
