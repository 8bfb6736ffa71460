"""KPI views from mergeable states, one for each year of a fact, kept beside the versions.

A state holds, for each category, year, sex and region of a fact, what the views need: rows,
distinct countries, exact sum, squared distances from the mean, smallest and largest value,
and two sketches: countries (HyperLogLog) and values (KLL). It belongs to a year's digest and
to a digest of the countries' regions, so versions that share a year share its state and a
changed year costs the pass over that year. Merging runs over groups, never over fact rows.

States lie under ``<root>/states`` and are listed there in markers that are written after
them; a state that was left half-written is never read. They can be deleted as a whole at
any time and are computed again from the facts.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starhouse.plans.views import labelled_deaths, labelled_kpi, with_region_share
from starhouse.plans.warehouse import PublishedWarehouse
from starhouse.schemas import HEALTH_FACT, NCD_FACT, FactSpec

#: Part of a state's name: another content needs another number.
_FORMAT = 1
#: lg of the registers of a country sketch: a relative standard error near 1.6 %, 4 KB at most.
COUNTRY_SKETCH = 12
#: Items a level of a value sketch: a rank error near 1.3 %.
VALUE_SKETCH = 200
_MARKER = "table_name STRING, year INT, state STRING, batch STRING"


def _keys(spec: FactSpec) -> list[str]:
    return [spec.category, "year_val", *(["sex_code"] if spec.has_sex else []), "region_name"]


def state_schema(spec: FactSpec) -> str:
    sex = "sex_code STRING, " if spec.has_sex else ""
    scale = spec.number_type.rstrip(")").split(",")[1]
    return (
        f"{spec.category} STRING, {sex}region_name STRING, n BIGINT, n_countries BIGINT, total DECIMAL(28,{scale}), "
        f"squares DOUBLE, low {spec.number_type}, high {spec.number_type}, countries BINARY, sketch BINARY, year_val SMALLINT"
    )


def states_of(rows: DataFrame, regions: DataFrame, spec: FactSpec) -> DataFrame:
    """The states of fact rows; ``regions`` has country_code and region_name."""
    value, keys = F.col(spec.measure), _keys(spec)
    placed = rows.join(regions, "country_code")
    # Apart from the distinct count, which would make a pair of sketches for each country of a group.
    counted = placed.select(*keys, "country_code").distinct().groupBy(*keys).agg(F.count("country_code").alias("n_countries"))
    counted = counted.withColumnsRenamed({k: f"_{k}" for k in keys})
    summed = placed.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.sum(value).alias("total"),
        (F.var_pop(value) * F.count("*")).alias("squares"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        F.hll_sketch_agg("country_code", COUNTRY_SKETCH).alias("countries"),
        F.kll_sketch_agg_double(value.cast("double"), VALUE_SKETCH).alias("sketch"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return summed.join(counted, same).drop(*counted.columns[:-1])


class KpiStates:
    """The states of a published version; those that are missing are computed when asked for."""

    def __init__(self, warehouse: PublishedWarehouse):
        self.wh = warehouse
        self.spark = warehouse.spark
        self.base = f"{warehouse.root.rstrip('/')}/states"
        self.regions = warehouse.country().select("country_code", "region_name")
        digest = F.sum(F.xxhash64("country_code", "region_name").cast("decimal(20,0)")).cast("string")
        self._countries = self.regions.agg(F.count("*").alias("n"), digest.alias("digest")).first()
        self._frames: dict[str, DataFrame] = {}

    def _wanted(self, spec: FactSpec) -> dict[int, str]:
        """The name of each year's state."""
        parts = self.wh.manifest.years(spec.name)
        content = {y: f"{_FORMAT}:{p.n_rows}:{p.digest}:{self._countries.n}:{self._countries.digest}" for y, p in parts.items()}
        return {y: hashlib.sha256(text.encode()).hexdigest() for y, text in content.items()}

    def _known(self, spec: FactSpec) -> dict[tuple[int, str], str]:
        """The batch that holds each state; a row a year and change, whatever the data."""
        try:
            markers = self.spark.read.schema(_MARKER).json(f"{self.base}/known")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        return {(r.year, r.state): r.batch for r in markers.filter(F.col("table_name") == spec.name).collect()}

    def bring_up_to_date(self, spec: FactSpec) -> list[int]:
        """Compute the states that are missing, in one job; returns their years."""
        wanted, known = self._wanted(spec), self._known(spec)
        missing = sorted(y for y, state in wanted.items() if (y, state) not in known)
        if missing:
            batch = uuid.uuid4().hex
            found = states_of(self.wh.stored_fact(spec, missing), self.regions, spec)
            path = f"{self.base}/{spec.name}/batch={batch}"
            # A year's groups are few: one file each.
            found.repartition("year_val").write.mode("errorifexists").partitionBy("year_val").parquet(path)
            rows = [(spec.name, y, wanted[y], batch) for y in missing]
            self.spark.createDataFrame(rows, _MARKER).coalesce(1).write.mode("append").json(f"{self.base}/known")
        return missing

    def frame(self, spec: FactSpec) -> DataFrame:
        """The states of all years of a fact, one row a group."""
        if spec.name not in self._frames:
            self.bring_up_to_date(spec)
            wanted, known = self._wanted(spec), self._known(spec)
            base = f"{self.base}/{spec.name}"
            paths = [f"{base}/batch={known[y, state]}/year_val={y}" for y, state in sorted(wanted.items())]
            if paths:
                read = self.spark.read.schema(state_schema(spec)).option("basePath", base).parquet(*paths)
            else:
                read = self.spark.createDataFrame([], state_schema(spec))
            self._frames[spec.name] = read
        return self._frames[spec.name]


def merged(states: DataFrame, spec: FactSpec, keys: list[str]) -> DataFrame:
    """States put together to one row for each of ``keys``.

    ``n_countries`` is exact where ``keys`` hold the year and, if the fact has one, the sex, since a
    country has one region; across years or sexes take the ``countries`` sketch.
    """
    group = Window.partitionBy(*keys)
    mean = F.sum("total").over(group).cast("double") / F.sum("n").over(group)
    apart = F.col("total").cast("double") / F.col("n") - F.col("_mean")
    precision, scale = (int(x) for x in spec.number_type.rstrip(")").split("(")[1].split(","))
    total = F.sum("total").cast(f"decimal({precision + 10},{scale})")
    return (
        states.withColumn("_mean", mean)
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("n"),
            F.sum("n_countries").alias("n_countries"),
            total.alias("total"),
            F.sqrt(F.sum(F.col("squares") + F.col("n") * apart * apart) / F.sum("n")).alias("deviation"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.hll_union_agg("countries").alias("countries"),
            F.kll_merge_agg_double("sketch", VALUE_SKETCH).alias("sketch"),
        )
        .withColumn("mean", (F.col("total") / F.col("n")).cast(f"decimal({precision + 4},{scale + 4})"))
    )


def yearly_kpi(states: KpiStates) -> DataFrame:
    found = merged(states.frame(HEALTH_FACT), HEALTH_FACT, ["indicator_code", "year_val", "sex_code"])
    return labelled_kpi(
        states.wh,
        found.select(
            "indicator_code",
            "year_val",
            "sex_code",
            F.col("n").alias("n_countries"),
            F.round("mean", 2).alias("avg_value"),
            F.round("low", 2).alias("min_value"),
            F.round("high", 2).alias("max_value"),
            F.round(F.col("deviation").cast("decimal(38,10)"), 2).alias("stddev_value"),
        ),
    )


def region_yearly_kpi(states: KpiStates) -> DataFrame:
    both = states.frame(HEALTH_FACT).filter(F.col("sex_code") == states.wh.profile.both_sexes)
    found = merged(both, HEALTH_FACT, ["indicator_code", "year_val", "region_name"])
    columns = ["indicator_code", "year_val", "region_name", "n_countries"]
    return with_region_share(states.wh, found.select(*columns, F.round("mean", 2).alias("avg_value")))


def yearly_deaths_by_cause(states: KpiStates) -> DataFrame:
    both = states.frame(NCD_FACT).filter(F.col("sex_code") == states.wh.profile.both_sexes)
    found = merged(both, NCD_FACT, ["cause_code", "year_val"])
    average = F.round("mean", 0).alias("avg_deaths_per_country")
    return labelled_deaths(
        states.wh, found.select("cause_code", "year_val", F.col("total").alias("total_deaths"), "n_countries", average)
    )


def countries_over_years(states: KpiStates, spec: FactSpec = HEALTH_FACT, exact: bool = True) -> DataFrame:
    """Distinct countries of each category over all years.

    Exact from the fact, or with ``exact=False`` estimated from the states without reading it
    (relative standard error near 1.6 %).
    """
    if exact:
        return states.wh.fact(spec).groupBy(spec.category).agg(F.count_distinct("country_code").alias("n_countries"))
    found = states.frame(spec).groupBy(spec.category).agg(F.hll_union_agg("countries").alias("countries"))
    return found.select(spec.category, F.hll_sketch_estimate("countries").alias("n_countries"))


def region_box(states: KpiStates, indicator: str, year: int | None = None) -> DataFrame:
    """Approximate box statistics of an indicator per region, in one year or over all of them.

    Smallest and largest value are exact. Quartiles are values of the data whose rank is near
    the wanted one (1.3 % of the rows; exact ranks up to some 200 rows).
    """
    rows = states.frame(HEALTH_FACT).filter(
        (F.col("indicator_code") == indicator) & (F.col("sex_code") == states.wh.profile.both_sexes)
    )
    if year is not None:
        rows = rows.filter(F.col("year_val") == year)

    def quantile(rank: float) -> Column:
        return F.kll_sketch_get_quantile_double("sketch", F.lit(rank))

    return merged(rows, HEALTH_FACT, ["region_name"]).select(
        "region_name",
        F.col("n").alias("n_rows"),
        F.col("low").cast("double").alias("min_value"),
        quantile(0.25).alias("q1_value"),
        quantile(0.5).alias("median_value"),
        quantile(0.75).alias("q3_value"),
        F.col("high").cast("double").alias("max_value"),
    )


def sketch_check(states: KpiStates) -> DataFrame:
    """For each indicator over all years: exact countries and rows, and whether the sketches are near.

    Countries may be off by four standard errors (and one); the median's rank by 4 % of the rows.
    """
    fact = states.wh.fact(HEALTH_FACT)
    found = states.frame(HEALTH_FACT).groupBy("indicator_code").agg(
        F.hll_sketch_estimate(F.hll_union_agg("countries")).alias("_estimate"),
        F.kll_sketch_get_quantile_double(F.kll_merge_agg_double("sketch", VALUE_SKETCH), F.lit(0.5)).alias("_median"),
    )
    value = F.col("metric_value").cast("double")
    counted = (
        fact.join(found, "indicator_code")
        .groupBy("indicator_code")
        .agg(
            F.count("*").alias("n_rows"),
            F.count_distinct("country_code").alias("n_countries"),
            F.count_if(value < F.col("_median")).alias("_below"),
            F.count_if(value <= F.col("_median")).alias("_upto"),
            F.first("_estimate").alias("_estimate"),
        )
    )
    half, slack = F.col("n_rows") / 2, F.col("n_rows") * 0.04 + 1
    return counted.select(
        "indicator_code",
        "n_rows",
        "n_countries",
        (F.abs(F.col("_estimate") - F.col("n_countries")) <= F.col("n_countries") * 0.064 + 1).alias("countries_near"),
        ((F.col("_below") <= half + slack) & (F.col("_upto") >= half - slack)).alias("median_near"),
    )
