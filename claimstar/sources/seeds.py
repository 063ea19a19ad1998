"""Key value sets for encounter groups and types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimstar.sources.contracts import schema

# Keys that must hold in every value set.
FIXED_TYPE_KEYS = (("inpatient long term acute care", "32", "1"),)

# The labels and keys of this package's default; read_keys takes a full value set.
GROUP_KEYS = (
    ("inpatient", "1"),
    ("outpatient", "2"),
    ("office based", "3"),
    ("other", "4"),
)
TYPE_KEYS = (
    ("acute inpatient", "1", "1"),
    ("emergency department", "2", "2"),
    ("office visit", "3", "3"),
    ("urgent care", "4", "2"),
    *FIXED_TYPE_KEYS,
)


def _literal_table(spark: SparkSession, name: str, rows: tuple[tuple[str, ...], ...]) -> DataFrame:
    # VALUES becomes a local relation of known size, so its joins broadcast without a hint.
    values = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)
    columns = ", ".join(schema(name).fieldNames())
    return spark.sql(f"select * from values {values} as t({columns})")


def default_group_keys(spark: SparkSession) -> DataFrame:
    return _literal_table(spark, "encounter_group_keys", GROUP_KEYS)


def default_type_keys(spark: SparkSession) -> DataFrame:
    return _literal_table(spark, "encounter_type_keys", TYPE_KEYS)


def fixed_type_keys(spark: SparkSession) -> DataFrame:
    return _literal_table(spark, "encounter_type_keys", FIXED_TYPE_KEYS)


def read_keys(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Read a key value set (CSV with header, may be gzipped) from shared storage."""
    return spark.read.csv(path, schema=schema(name), header=True, enforceSchema=False)
