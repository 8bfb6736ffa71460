"""The order tables (lineitem, orders, part, ...) staged as the four raw tables.

Suppliers play countries, return flags play sexes, part types play indicators,
market segments play causes and order priorities play diseases. The result is
text with deliberate defects, placed by arithmetic on keys, so that every
cleaning rule and every check has something to find:

* year text padded with spaces, or unreadable (``19x5``)
* value text ``None``, or negative
* bounds blank, or swapped
* rows at REGION level next to the COUNTRY ones
* region names ending in a carriage return, or no region at all
* rows staged twice: of suppliers without a region, and some whole countries

Each facts table costs one pass over lineitem with the columns it needs. The
join to part goes by key and is left to adaptive execution, which broadcasts a
side that turns out small and splits a key that turns out hot. So is the join to
orders, until lines are so many that a task would hold more and more of them: then
lines and orders are dealt by their number, and a hot order is sorted by one task. The
aggregation that follows combines on the map side, so a hot supplier shrinks to
its few groups before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse.parallel import dealt
from starhouse.schemas import STG_COMM, STG_COUNTRY, STG_HEALTH, STG_NCD, staging_columns

SOURCE_TABLES = ("lineitem", "part", "orders", "customer", "supplier", "nation", "region")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _health_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (
        lines.join(part, lines.l_partkey == part.p_partkey)
        .groupBy(
            F.col("p_type").alias("category"),
            F.col("l_suppkey").alias("supp"),
            F.year("l_shipdate").alias("yr"),
            F.col("l_returnflag").alias("flag"),
        )
        .agg(
            F.min("l_extendedprice").cast("decimal(18,2)").alias("low"),
            F.max("l_extendedprice").cast("decimal(18,2)").alias("high"),
        )
    )


def _with_orders(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with their orders, both dealt by the number of lines."""
    n = lines.count()  # from the footers of the files
    lines, orders = dealt(lines, n, "l_orderkey"), dealt(orders, n, "o_orderkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def _ncd_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_returnflag", "l_quantity"
    )
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("yr")
    )
    dated = orders.join(customer, orders.o_custkey == customer.c_custkey)
    return (
        _with_orders(lines, dated)
        .groupBy(
            F.col("c_mktsegment").alias("category"),
            F.col("l_suppkey").alias("supp"),
            "yr",
            F.col("l_returnflag").alias("flag"),
        )
        .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(18,2)").alias("value"))
    )


def _comm_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    priority = F.col("o_orderpriority")
    # Two priorities are known for one year only, so all their orders count for that year.
    yr = F.when(priority.isin("4-NOT SPECIFIED", "5-LOW"), 2000).otherwise(F.year("o_orderdate"))
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", yr.alias("yr"), priority.alias("category")
    )
    return (
        _with_orders(lines, orders)
        .groupBy("category", F.col("l_suppkey").alias("supp"), "yr")
        .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(18,2)").alias("value"))
    )


def _to_regions(
    groups: DataFrame, spark: SparkSession, sf_dir: str, keys: list[str], **measures: Column
) -> DataFrame:
    """The same groups one level up: supplier -> region.

    The null-safe join adds no filter to ``groups``, so both uses of it have the
    same plan and Spark runs the pass over lineitem once.
    """
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (
        groups.join(supplier, groups.supp.eqNullSafe(supplier.s_suppkey))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(*keys, F.col("n_regionkey").alias("supp"))
        .agg(*[measure.alias(name) for name, measure in measures.items()])
    )


def _health_values(groups: DataFrame) -> DataFrame:
    """Price range in thousands, with the midpoint as the value."""
    low, high = F.col("low"), F.col("high")
    thousandth = F.lit("0.001").cast("decimal(4,3)")
    half_thousandth = F.lit("0.0005").cast("decimal(5,4)")
    return groups.withColumns(
        {
            "value": ((low + high) * half_thousandth).cast("decimal(18,6)"),
            "low": (low * thousandth).cast("decimal(18,6)"),
            "high": (high * thousandth).cast("decimal(18,6)"),
        }
    )


def _count_values(groups: DataFrame) -> DataFrame:
    """A count with bounds ten percent either side."""
    value = F.col("value")
    return groups.withColumns(
        {
            "low": (value * F.lit("0.90").cast("decimal(3,2)")).cast("decimal(18,4)"),
            "high": (value * F.lit("1.10").cast("decimal(3,2)")).cast("decimal(18,4)"),
        }
    )


def _plain_text(groups: DataFrame) -> DataFrame:
    return groups.select(
        *[c for c in ("category", "flag") if c in groups.columns],
        F.concat(F.lit("REG-"), F.col("supp").cast("string")).alias("raw_country_code"),
        F.lit("REGION").alias("raw_spatial_dim_type"),
        F.col("yr").cast("string").alias("raw_year"),
        *[F.col(c).cast("string").alias(f"raw_{c}") for c in ("value", "low", "high")],
    )


def _defective_text(groups: DataFrame, negative: Column) -> DataFrame:
    supp, yr = F.col("supp"), F.col("yr")
    mixed, summed = supp * 31 + yr, supp + yr
    year, value, low, high = (F.col(c).cast("string") for c in ("yr", "value", "low", "high"))
    blank, swapped = summed % 4 == 0, summed % 13 == 5
    # Suppliers without a region never reach the core; their rows stand in staging twice.
    copies = F.array_repeat(F.lit(1), F.when(supp % 40 == 7, 2).otherwise(1))
    return groups.withColumn("_copy", F.explode(copies)).select(
        *[c for c in ("category", "flag") if c in groups.columns],
        supp.cast("string").alias("raw_country_code"),
        F.lit("COUNTRY").alias("raw_spatial_dim_type"),
        F.when(mixed % 101 == 3, "19x5")
        .when(supp % 5 == 0, F.concat(F.lit(" "), year, F.lit(" ")))
        .otherwise(year)
        .alias("raw_year"),
        F.when(mixed % 103 == 4, "None")
        .when(negative, F.concat(F.lit("-"), value))
        .otherwise(value)
        .alias("raw_value"),
        F.when(blank, "").when(swapped, high).otherwise(low).alias("raw_low"),
        F.when(blank, "").when(swapped, low).otherwise(high).alias("raw_high"),
    )


def stage_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = _health_groups(spark, sf_dir)
    regions = _to_regions(
        groups, spark, sf_dir, ["category", "yr", "flag"], low=F.min("low"), high=F.max("high")
    )
    negative = ((F.col("supp") * 31 + F.col("yr")) % 107 == 5) & (F.col("category") == "ECONOMY")
    text = _defective_text(_health_values(groups), negative).unionByName(
        _plain_text(_health_values(regions))
    )
    return text.select(
        F.col("category").alias("raw_indicator_code"),
        "raw_country_code",
        "raw_spatial_dim_type",
        "raw_year",
        F.col("flag").alias("raw_sex_code"),
        F.col("raw_value").alias("raw_numeric_value"),
        "raw_low",
        "raw_high",
    )


# Negative counts sit only on suppliers without a region, which never reach the core.
def _negative_count() -> Column:
    return (F.col("supp") % 40 == 7) & (F.col("yr") % 2 == 0)


def stage_ncd(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = _ncd_groups(spark, sf_dir)
    regions = _to_regions(
        groups, spark, sf_dir, ["category", "yr", "flag"], value=F.sum("value").cast("decimal(18,2)")
    )
    text = _defective_text(_count_values(groups), _negative_count()).unionByName(
        _plain_text(_count_values(regions))
    )
    return text.select(
        F.lit("DEATHS").alias("raw_indicator_code"),
        "raw_country_code",
        "raw_spatial_dim_type",
        "raw_year",
        F.col("flag").alias("raw_sex_code"),
        F.col("category").alias("raw_cause_code"),
        F.col("raw_value").alias("raw_numeric_value"),
        "raw_low",
        "raw_high",
    )


def stage_comm(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = _comm_groups(spark, sf_dir)
    regions = _to_regions(
        groups, spark, sf_dir, ["category", "yr"], value=F.sum("value").cast("decimal(18,2)")
    )
    text = _defective_text(_count_values(groups), _negative_count()).unionByName(
        _plain_text(_count_values(regions))
    )
    return text.select(
        F.col("category").alias("raw_indicator_code"),
        F.expr("substr(category, 3)").alias("raw_disease_name"),
        "raw_country_code",
        "raw_spatial_dim_type",
        "raw_year",
        F.col("raw_value").alias("raw_numeric_value"),
        "raw_low",
        "raw_high",
    )


def stage_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read_table(spark, sf_dir, "supplier")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    lost = F.col("s_suppkey") % 40 == 7
    copies = F.array_repeat(F.lit(1), F.when(F.col("s_suppkey") % 40 == 8, 2).otherwise(1))
    return (
        supplier.withColumn("_copy", F.explode(copies))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").cast("string").alias("raw_country_code"),
            F.col("s_name").alias("raw_country_name"),
            F.when(lost, "").otherwise(F.col("r_regionkey").cast("string")).alias("raw_region_code"),
            F.when(lost, "").otherwise(F.concat("r_name", F.lit("\r"))).alias("raw_region_name"),
        )
    )


STAGES = {
    STG_HEALTH: stage_health,
    STG_NCD: stage_ncd,
    STG_COMM: stage_comm,
    STG_COUNTRY: stage_countries,
}


def stage(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return STAGES[table](spark, sf_dir).select(*staging_columns(table))
