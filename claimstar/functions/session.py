"""Session settings the builders are meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution is what splits hot join keys, merges small shuffle partitions and turns
# a shuffled join into a broadcast one once the measured size allows it.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where several joins on the same keys follow each other and the split
    # costs one of them another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Where every partition of the narrow side turns out at most this large, the wide side of a
    # shuffled join is streamed past a hash table instead of being sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # HotSpot leaves methods above 8000 bytes of bytecode interpreted, which the fused
    # projections of the wide tables exceed; those fall back to split projections instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(
    app_name: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings above.

    ``shuffle_partitions`` should be about the shuffled bytes divided by 128 MiB (tens of
    thousands for 100 TB); adaptive execution merges what turns out too small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
