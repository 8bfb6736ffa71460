"""Refresh of the core: write what changed as a new version, check it, make it current."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starhouse.operators.constraints import stacked, violations
from starhouse.operators.loading import LEVEL, RECORD_ID, build_country_dim, parsed, record, record_id, referenced, typed_staging
from starhouse.operators.quality import inverted, repair_inverted
from starhouse.operators.rules import first_violation, rules, split, strict
from starhouse.parallel import run_together
from starhouse.plans.warehouse import REJECTS_SCHEMA, PublishedWarehouse, Stage
from starhouse.profile import Profile
from starhouse.schemas import FACTS, HEALTH_FACT, STATIC_DIMS, STG_COUNTRY, FactSpec
from starhouse.scratch import released, scratch_path
from starhouse.sinks.files import write_fact, write_table
from starhouse.sinks.versions import Manifest, Part, new_version, publish, published, published_summary, version_path
from starhouse.sources.literal import static_dim

SUMMARY_SCHEMA = "countries_loaded BIGINT, facts_loaded BIGINT, deaths_loaded BIGINT, rows_rejected BIGINT"
#: Share of a staging table's country rows that may be unreadable before the core is not built.
MAX_UNREADABLE = 0.5
COUNTRY_REQUIRED = ["country_code", "country_name", "region_code", "region_name"]


class RefreshRejected(RuntimeError):
    """The new version failed its checks; the published one is untouched."""


def core_violations(warehouse: PublishedWarehouse, years: Mapping[str, Collection[int]] | None = None) -> DataFrame:
    """Constraint and reference violations of every core table, one row per check.

    ``years`` names the years of each fact to look at; a business key has one year.
    """
    checks = [violations(warehouse.country(), "dim_country", COUNTRY_REQUIRED, ["country_code"])]
    for spec in FACTS:
        fact = warehouse.fact(spec) if years is None else warehouse.stored_fact(spec, years[spec.name])
        checks.append(violations(fact, spec.name, spec.key + [spec.measure], spec.key))
        orphans = fact.join(warehouse.country(), "country_code", "left_anti")
        checks.append(
            orphans.agg(F.count("*").alias("n_violations")).select(
                F.lit(spec.name).alias("table_name"),
                F.lit("references:dim_country").alias("constraint_name"),
                "n_violations",
            )
        )
    return stacked(checks)


def year_digests(rows: DataFrame, spec: FactSpec, version: str) -> list[Part]:
    """Rows and digest of each year, over business key and values; the order of rows does not matter."""
    missing = [F.isnull(c) for c in ("low_ci", "high_ci")]

    def total(seed: str) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), *spec.columns, *missing).cast("decimal(20,0)"))

    digest = F.concat_ws(":", total("a"), total("b"))
    found = rows.groupBy(F.col("year_val").cast("int").alias("year")).agg(F.count("*").alias("n"), digest.alias("digest"))
    return [Part(spec.name, r.year, version, r.n, r.digest) for r in found.collect()]  # a row a year


def staging_gate(stage: Stage, profile: Profile, max_unreadable: float = MAX_UNREADABLE) -> DataFrame:
    """For each facts staging table its country rows, the unreadable ones, and whether it may be loaded.

    A row is unreadable when its year or its value does not parse. A table without any
    country row, or with a larger share of unreadable ones than allowed, is not loaded.
    """
    frames = []
    for spec in FACTS:
        rows = typed_staging(stage(spec.staging), spec).filter(F.col(LEVEL) == profile.country_level)
        unreadable = F.col("year_val").isNull() | F.col(spec.measure).isNull()
        counted = rows.agg(F.count("*").alias("n_rows"), F.count_if(unreadable).alias("n_unreadable"))
        passes = (F.col("n_rows") > 0) & (F.col("n_unreadable") <= F.col("n_rows") * max_unreadable)
        frames.append(counted.select(F.lit(spec.staging).alias("table_name"), "*", passes.alias("passes")))
    return stacked(frames)


def refresh_core(
    spark: SparkSession,
    profile: Profile,
    stage: Stage,
    root: str,
    verbose: bool = False,
    on_violation: str = "record",
    max_unreadable: float = MAX_UNREADABLE,
    whole: bool = False,
) -> DataFrame | None:
    """Bring all core tables under ``root`` up to date with staging.

    Staging text is read once: its country rows are typed and written to the shared folder,
    and counted as they pass for the gate. What is loaded is then compared with the published
    version by a digest a year; equal years are taken over and only the others numbered and
    written (all of them with ``whole``). Rows that break a row rule are written to the
    version's ``rejects`` table (``on_violation="record"``) or fail the refresh
    (``"abort"``); repeated business keys always fail it. The previous version stays
    current until the new one is complete and free of violations. With ``verbose`` the
    one-row summary of what was loaded is returned.
    """
    if on_violation not in ("record", "abort"):
        raise ValueError(f"on_violation is 'record' or 'abort', not {on_violation!r}")
    with released(spark):
        typed = {spec.name: scratch_path(spark, f"typed-{spec.name}") for spec in FACTS}
        _typed_once(spark, profile, stage, typed, max_unreadable)
        version = new_version()
        parts, summary = _write_version(spark, profile, stage, root, version, typed, on_violation, whole)
    publish(summary, root, version, None, parts)
    return published_summary(spark, root, version, SUMMARY_SCHEMA) if verbose else None


def _named(spec: FactSpec, profile: Profile) -> bool:
    """Whether typed rows that are refused keep their records' ids: only those of a fact that can have rejects."""
    return bool(rules(spec, profile))


def _refused(rejects: DataFrame, spec: FactSpec) -> DataFrame:
    value, row_key = F.col(spec.measure).cast("string").alias("value"), F.concat_ws("|", *spec.key).alias("row_key")
    return rejects.select(F.lit(spec.name).alias("table_name"), row_key, value, "reason", RECORD_ID)


def _typed_once(spark: SparkSession, profile: Profile, stage: Stage, paths: dict[str, str], max_unreadable: float) -> None:
    """Write the typed country rows of each facts staging table, unless one may not be loaded.

    Both counts are taken in tasks that write, so they are exact whatever is retried.
    """
    counts: dict[str, tuple[int, int]] = {}

    def write(spec: FactSpec) -> None:
        seen, kept = Observation(), Observation()
        staged, keep = stage(spec.staging), ["_record"] if _named(spec, profile) else []
        if keep:
            staged = staged.withColumn("_record", record(spec))
        rows = parsed(staged, spec, profile, seen=seen, keep=keep).observe(kept, F.count("*").alias("n"))
        if keep:
            # Only rows that are refused are named by their record; its digest is costly, and does not compress.
            refused = first_violation(spec, profile).isNotNull()
            rows = rows.withColumn(RECORD_ID, F.when(refused, record_id(spec, F.col("_record")))).drop("_record")
        write_table(rows, paths[spec.name])
        counts[spec.staging] = seen.get["n_rows"], kept.get["n"]

    run_together(spark, [partial(write, spec) for spec in FACTS])
    stopped = {t: (n, n - kept) for t, (n, kept) in counts.items() if n == 0 or n - kept > n * max_unreadable}
    if stopped:
        listed = ", ".join(f"{t} ({bad} of {n} rows unreadable)" for t, (n, bad) in sorted(stopped.items()))
        raise RefreshRejected(f"staging not loaded: {listed}")


def _write_version(
    spark: SparkSession, profile: Profile, stage: Stage, root: str, version: str, typed: dict[str, str], on_violation: str, whole: bool
) -> tuple[list[Part], DataFrame]:
    """The folders of a version and its checks; returns where the years lie, and the summary."""
    path = version_path(root, version)
    dims = {name: static_dim(spark, profile, name) for name in STATIC_DIMS}
    known = None if whole else published(spark, root)

    def write_static() -> None:
        for name, dim in dims.items():
            write_table(dim.coalesce(1), f"{path}/{name}")

    def write_countries() -> None:
        write_table(build_country_dim(stage(STG_COUNTRY)), f"{path}/dim_country")

    run_together(spark, [write_static, write_countries])
    countries = PublishedWarehouse(spark, profile, root, manifest=Manifest(version)).country()
    references = {**dims, "dim_country": countries}
    parts: dict[str, list[Part]] = {}
    rejected: dict[str, int] = {}

    def candidates(spec: FactSpec) -> DataFrame:
        schema = spec.typed_schema + (f", {RECORD_ID} BINARY" if _named(spec, profile) else "")
        return referenced(spark.read.schema(schema).parquet(typed[spec.name]), spec, references)

    def write_one(spec: FactSpec) -> None:
        if on_violation == "abort":
            accepted = strict(candidates(spec), spec, profile)
        else:
            accepted, _ = split(candidates(spec), spec, profile)
        accepted = accepted.select(*spec.columns)
        found = year_digests(accepted, spec, version)
        before = known.years(spec.name) if known else {}
        same = {p.year: before[p.year] for p in found if p.year in before and before[p.year].digest == p.digest}
        changed = sorted((p for p in found if p.year not in same), key=lambda p: p.year)
        if changed:
            starts, total = {}, 0
            for part in changed:
                starts[part.year] = total
                total += part.n_rows
            rows = accepted.filter(F.col("year_val").isin(list(starts))) if same else accepted
            written = write_fact(rows, spec, f"{path}/{spec.name}", starts)
            if written != total:
                raise RefreshRejected(f"version {version} not published: {spec.name} has {written} rows of {total}")
        parts[spec.name] = [*same.values(), *changed]

    def write_rejects() -> None:
        frames = [spark.createDataFrame([], REJECTS_SCHEMA)]
        for spec in FACTS if on_violation == "record" else ():
            if rules(spec, profile):
                _, rejects = split(candidates(spec), spec, profile)
                frames.append(_refused(rejects, spec))
        seen = Observation()
        write_table(stacked(frames).observe(seen, F.count("*").alias("n")), f"{path}/rejects")
        rejected["n"] = seen.get["n"]

    run_together(spark, [write_rejects, *[partial(write_one, spec) for spec in FACTS]])
    listed = [p for spec in FACTS for p in parts[spec.name]]
    written = PublishedWarehouse(spark, profile, root, manifest=Manifest(version, {}, tuple(listed)))
    own = {spec.name: {p.year for p in parts[spec.name] if p.version == version} for spec in FACTS}
    # One row per check: a fixed, small number whatever the data.
    failed = core_violations(written, own).filter(F.col("n_violations") > 0).collect()
    if failed:
        names = ", ".join(f"{r.table_name} {r.constraint_name} ({r.n_violations})" for r in failed)
        raise RefreshRejected(f"version {version} not published: {names}")
    rows = {spec.name: sum(p.n_rows for p in parts[spec.name]) for spec in FACTS}
    deaths = sum(n for name, n in rows.items() if name != HEALTH_FACT.name)
    counts = {"facts_loaded": rows[HEALTH_FACT.name], "deaths_loaded": deaths, "rows_rejected": rejected["n"]}
    loaded = countries.agg(F.count("*").alias("countries_loaded"))
    return listed, loaded.select("*", *[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()])


def publish_repaired(spark: SparkSession, profile: Profile, root: str) -> PublishedWarehouse:
    """Publish the current version with the bounds of inverted health rows swapped.

    Only the years of the health fact that have such rows are written; all else is taken over.
    Without any the current version stays. Readers, views included, see the repair from then on.
    """
    current = PublishedWarehouse(spark, profile, root)
    wrong = current.stored_fact(HEALTH_FACT).filter(inverted()).select(F.col("year_val").cast("int").alias("y")).distinct()
    years = sorted(r.y for r in wrong.collect())  # a row a year
    if not years:
        return current
    version = new_version()
    # The rows come from year folders, in files that are sorted already; ids within a year stay.
    repaired = repair_inverted(current.stored_fact(HEALTH_FACT, years))
    path = f"{version_path(root, version)}/{HEALTH_FACT.name}"
    repaired.write.mode("errorifexists").partitionBy("year_val").parquet(path)
    own = year_digests(spark.read.schema(HEALTH_FACT.schema).parquet(path), HEALTH_FACT, version)
    parts = [p for p in current.manifest.parts if p.table_name != HEALTH_FACT.name or p.year not in years] + own
    others = [*STATIC_DIMS, "dim_country", "rejects"]
    taken = {name: current.manifest.tables.get(name, current.version) for name in others}
    summary = published_summary(spark, root, current.version, SUMMARY_SCHEMA)
    publish(summary, root, version, taken, parts)
    return PublishedWarehouse(spark, profile, root)


def replay_rejects(spark: SparkSession, profile: Profile, root: str, mended: DataFrame, spec: FactSpec = HEALTH_FACT) -> PublishedWarehouse:
    """Load records that the current version refused and that have been mended since.

    ``mended`` has the staging columns of ``spec`` and ``record_id``, the id under which the record
    stands in ``rejects``. The rows that pass now join the fact: their years are written, all else
    is taken over. What still breaks a rule stays refused with its new reason; of what is no
    country row, does not parse or has an unknown reference, the old reject stays. A record that is
    not among the rejects, one mended twice, or a business key that the fact holds already ends
    the replay and leaves the current version as it is. A later refresh says again what staging says.
    """
    current = PublishedWarehouse(spark, profile, root)
    refused = current.rejects().filter(F.col("table_name") == spec.name)
    given = mended.groupBy(RECORD_ID).agg(F.count("*").alias("n"))
    twice = given.filter(F.col("n") > 1).agg(F.count("*").alias("twice"))
    foreign = given.join(refused, RECORD_ID, "left_anti").agg(F.count("*").alias("foreign"))
    found = twice.join(foreign).first()  # one row each
    if found.twice or found.foreign:
        raise RefreshRejected(f"not replayed: {found.twice} records mended twice, {found.foreign} not among the rejects")
    version = new_version()
    path = version_path(root, version)
    with released(spark):
        kept_id = "_reject"
        text = mended.withColumnRenamed(RECORD_ID, kept_id)
        rows = parsed(text, spec, profile, keep=[kept_id])
        typed = scratch_path(spark, "replayed")
        write_table(referenced(rows, spec, current.dims()).withColumnRenamed(kept_id, RECORD_ID), typed)
        rows = spark.read.schema(f"{spec.typed_schema}, {RECORD_ID} BINARY").parquet(typed)
        accepted, rejects = split(rows, spec, profile)
        years = sorted(r.y for r in accepted.select(F.col("year_val").cast("int").alias("y")).distinct().collect())  # a row a year
        if not years and rejects.isEmpty():
            return current
        # Equal records share an id: one mended record stands for each of them, and may be loaded once.
        others = current.rejects().join(rows.select(F.lit(spec.name).alias("table_name"), RECORD_ID), ["table_name", RECORD_ID], "left_anti")
        columns = current.rejects().columns
        seen = Observation()
        left = others.select(*columns).unionByName(_refused(rejects, spec)).observe(seen, F.count("*").alias("n"))
        write_table(left, f"{path}/rejects")
        added = 0
        parts = list(current.manifest.parts)
        if years:
            whole = current.stored_fact(spec, years).select(*spec.columns).unionByName(accepted.select(*spec.columns))
            own = year_digests(whole, spec, version)
            starts, total = {}, 0
            for part in sorted(own, key=lambda p: p.year):
                starts[part.year] = total
                total += part.n_rows
            write_fact(whole, spec, f"{path}/{spec.name}", starts)
            before = sum(p.n_rows for p in parts if p.table_name == spec.name and p.year in starts)
            added = total - before
            parts = [p for p in parts if p.table_name != spec.name or p.year not in starts] + own
    taken = {name: current.manifest.tables.get(name, current.version) for name in (*STATIC_DIMS, "dim_country")}
    written = PublishedWarehouse(spark, profile, root, manifest=Manifest(version, taken, tuple(parts)))
    failed = violations(written.stored_fact(spec, years), spec.name, spec.key + [spec.measure], spec.key)
    broken = failed.filter(F.col("n_violations") > 0).collect()  # a row a check
    if broken:
        names = ", ".join(f"{r.constraint_name} ({r.n_violations})" for r in broken)
        raise RefreshRejected(f"version {version} not published: {names}")
    counted = "facts_loaded" if spec is HEALTH_FACT else "deaths_loaded"
    summary = published_summary(spark, root, current.version, SUMMARY_SCHEMA)
    summary = summary.withColumn(counted, F.col(counted) + F.lit(added)).withColumn("rows_rejected", F.lit(seen.get["n"]))
    publish(summary, root, version, taken, parts)
    return PublishedWarehouse(spark, profile, root)


def changes(before: PublishedWarehouse, after: PublishedWarehouse, spec: FactSpec) -> DataFrame:
    """Rows of a fact that were inserted, deleted or updated between two versions.

    Years with equal digests are not read. Business key, ``change``, and each value in both
    versions (``old_``, ``new_``); the join is an ordinary shuffle of the changed years.
    """
    old, new = before.manifest.years(spec.name), after.manifest.years(spec.name)
    years = {y for y in {**old, **new} if y not in old or y not in new or old[y].digest != new[y].digest}
    values = [c for c in spec.columns if c not in spec.key]

    def side(warehouse: PublishedWarehouse, name: str) -> DataFrame:
        rows = warehouse.stored_fact(spec, years)
        return rows.select(*spec.key, F.struct(*values).alias(name))

    both = side(before, "old").join(side(after, "new"), spec.key, "full")
    change = F.when(F.col("old").isNull(), "inserted").when(F.col("new").isNull(), "deleted").otherwise("updated")
    return both.filter(~F.col("old").eqNullSafe(F.col("new"))).select(
        *spec.key,
        change.alias("change"),
        *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for c in values for side in ("old", "new")],
    )
