"""Load the input relations and stage them for the builders."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstar.functions.columns import run_stamp
from claimstar.sources.contracts import CONTRACTS, STAMP, conform

# These carry the run timestamp of their own build; terminology without a stamp stays bare;
# every other staged input is stamped with the timestamp of this run.
PASSES_STAMP = frozenset({"medical_claim", "pharmacy_claim", "member_month", "cost"})
UNSTAMPED = frozenset(
    {
        "augmented_admissions",
        "service_categories",
        "diagnosis_categories",
        "drug_packages",
        "drugs",
        "drug_classes",
        "encounter_group_keys",
        "encounter_type_keys",
    }
)


def stage(name: str, frame: DataFrame, run_ts: str) -> DataFrame:
    """The staged form of an input: contract projection, run stamp, and the few input rules."""
    staged = conform(name, frame)
    if name == "eligibility":
        staged = staged.distinct()
    elif name == "encounter":
        staged = staged.filter(F.col("encounter_source_type") == "claim")
    elif name == "member_month":
        staged = staged.withColumn("year_nbr", F.substring("year_month", 1, 4))
    if name in PASSES_STAMP or name in UNSTAMPED:
        return staged
    return staged.withColumn(STAMP, run_stamp(run_ts))


def load_inputs(
    spark: SparkSession,
    read: Callable[[str], DataFrame],
    names: Iterable[str] | None = None,
    renames: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Read and check the inputs by name.

    ``read`` is :func:`parquet_reader`, :func:`table_reader` or any function from an input name
    to a DataFrame. ``renames`` maps upstream column names to contract names. The two key value
    sets must be given like any other input: encounters of labels outside them are dropped.
    """
    loaded = {}
    for name in names or CONTRACTS:
        frame = read(name)
        loaded[name] = frame.withColumnsRenamed(dict(renames or {}))
        conform(name, loaded[name])
    return loaded


def parquet_reader(
    spark: SparkSession, root: str, paths: Mapping[str, str | None] | None = None
) -> Callable[[str], DataFrame]:
    """Read ``root/<name>``; ``paths`` overrides single names; None refuses one."""
    overrides = dict(paths or {})

    def read(name: str) -> DataFrame:
        path = overrides.get(name, f"{root}/{name}")
        if path is None:
            raise KeyError(f"no path for the input {name}")
        return spark.read.parquet(path)

    return read


def table_reader(
    spark: SparkSession, database: str, tables: Mapping[str, str | None] | None = None
) -> Callable[[str], DataFrame]:
    """Read catalog tables; claims bucketed by (encounter_id, data_source) keep their layout."""
    overrides = dict(tables or {})

    def read(name: str) -> DataFrame:
        table = overrides.get(name, f"{database}.{name}")
        if table is None:
            raise KeyError(f"no table for the input {name}")
        return spark.table(table)

    return read
