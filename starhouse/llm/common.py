"""What the corpus operators share: reading tables and storing intermediate results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse.scratch import scratch_path

#: Keys beyond this share (one in so many) of all rows are few enough to broadcast.
LARGE_KEYS = 1000

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage is cut, and
    later jobs neither recompute it nor see another outcome of a retried task."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def document_key(text: Column) -> Column:
    """A digest of id and text. Rows that agree in both share it, and with it their results,
    so null and repeated ids need no care elsewhere."""
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), text)))


def shielded(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with other names for columns that begin with an underscore, as the operators'
    own columns do, and what gives a result the names back."""
    prefix = "kept"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    names = {c: f"{prefix}{i}" for i, c in enumerate(docs.columns) if c.startswith("_")}
    return docs.withColumnsRenamed(names), lambda out: out.withColumnsRenamed({v: k for k, v in names.items()})


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, however often ``body`` names it.

    Inside a higher-order function Spark evaluates an expression anew for each element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def joined_evenly(
    rows: DataFrame, groups: DataFrame, keys: list[str], size: str, how: str = "left", large_keys: int = LARGE_KEYS
) -> DataFrame:
    """``rows`` joined with ``groups``, which has a row a key, however many rows share a key.

    ``size`` says how many rows a key of ``groups`` stands for. Keys with more than one in
    ``large_keys`` of those rows are at most ``large_keys``, so they are broadcast and their
    rows stay where they are; the others meet in an ordinary join. Both sides should be stored
    tables. Key columns must not be null; ``size`` is not returned.
    """
    total = groups.agg(F.sum(size).alias("n")).first()["n"] or 0
    large = F.col(size) > total / large_keys
    hot, rest = groups.filter(large).drop(size), groups.filter(~large).drop(size)
    met = rows.join(F.broadcast(hot), keys)
    others = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest, keys, how)
    return met.unionByName(others)
