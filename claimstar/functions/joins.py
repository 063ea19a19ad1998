"""Join helpers: null-safe keys and skew-splittable joins.

No join is hinted as broadcast. Spark broadcasts a side whose estimated or, in adaptive execution,
measured size is within ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise. Key
value sets, whose size Spark cannot know where they are derived, are checked by ``bounded``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY_ROWS = 10_000  # most rows of a key value set that is taken as small


def bounded(frame: DataFrame, name: str, rows: int | None = KEY_ROWS) -> DataFrame:
    """The frame, proven to be small: a query over more than ``rows`` rows of it fails.

    The rows pass through one array of at most ``rows`` + 1 of them, whose length is checked when
    the query runs, so that Spark takes the frame as small when it plans a join, whatever it was
    derived from; large sides are then not shuffled by a few hot labels. With ``rows`` None the
    frame stays as it is, and Spark decides by its own estimate.
    """
    if rows is None:
        return frame
    return _held(frame, name, rows).select(F.inline("held"))


def _held(frame: DataFrame, name: str, rows: int) -> DataFrame:
    """One array, ``held``, of all rows of the frame; a query over more than ``rows`` of them fails."""
    packed = frame.limit(rows + 1).agg(F.collect_list(F.struct("*")).alias("held"))
    message = F.lit(f"{name} has more than {rows} rows; give a larger key_rows, or None")
    checked = F.when(F.size("held") <= rows, F.col("held")).otherwise(F.raise_error(message))
    return packed.select(checked.alias("held"))


def numbered(frame: DataFrame, name: str, rows: int, number: str) -> tuple[DataFrame, DataFrame]:
    """The rows of a ``bounded`` frame with a number each, and one array, ``held``, of them by number.

    Rows to be moved can carry the number, and are given what stands for it (``F.get`` on the array as a
    scalar subquery) where they arrive. Both are computed on their own, so numbers follow the order of the
    rows' values, and rows alike in all of them are alike whichever number they have.
    """
    ordered = _held(frame, name, rows).select(F.sort_array("held").alias("held"))
    return ordered.select(F.posexplode("held").alias(number, "row")).select(number, "row.*"), ordered


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """The union by name of frames of the same columns.

    Halves are united first: each union checks all of its plan again, which for one long chain of
    them grows with the square of their number.
    """
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    return union_all(frames[:middle]).unionByName(union_all(frames[middle:]))


def left_join_null_safe(
    left: DataFrame, right: DataFrame, plain: Sequence[str], null_safe: Sequence[str]
) -> DataFrame:
    """Left join on equal names; ``null_safe`` keys also match null with null.

    The key columns of the right side are dropped from the result.
    """
    renamed = {name: f"_right_{name}" for name in [*plain, *null_safe]}
    other = right.withColumnsRenamed(renamed)
    condition = F.lit(True)
    for name in plain:
        condition = condition & (left[name] == other[renamed[name]])
    for name in null_safe:
        condition = condition & left[name].eqNullSafe(other[renamed[name]])
    return left.join(other, condition, "left").drop(*renamed.values())


def skew_splittable_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi join whose two inputs both arrive through an exchange of their own.

    Adaptive execution splits a hot key only if both inputs of the join are shuffle stages. A
    side that is itself a join or an aggregate on the same keys is already partitioned by them
    and gets no exchange, so a hot key would stay in one task. A value computed from the keys as
    an additional, redundant key makes that partitioning insufficient: the (narrow) side is
    exchanged once more, and the hot key becomes splittable. One bit of their hash is enough, and
    moves in fewer bytes than all of it.
    """
    spread = F.xxhash64(*keys).bitwiseAND(F.lit(1))
    return (
        left.withColumn("_spread", spread)
        .join(right.withColumn("_spread", spread), [*keys, "_spread"], how)
        .drop("_spread")
    )
