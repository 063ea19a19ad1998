"""What the operators share: reading tables, storing intermediate tables, labelled samples."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CELL = 1024  # members of a crowded key in one block; a cell holds two blocks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir.

    Where it is unset, a temporary one if the session runs on this machine alone, as in tests; on a
    cluster, whose other machines could not read it, that is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="claimstar-llm-"))
        configured = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet to the shared folder and read back: lineage ends here."""
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids are in no bucket."""
    return F.crc32(F.col(id_column).cast("string")) % modulus


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Exactly the two columns (doc_id, text); other columns, whatever their names, stay behind."""
    return docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )


def row_key() -> Column:
    """A number of the row: the hash of its id and text, null or not; equal rows share it."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def keyed(docs: DataFrame) -> DataFrame:
    """The columns (doc_id, text, row), for stages whose findings go back to the rows."""
    return texts(docs).withColumn("row", row_key())


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, rows: int
) -> DataFrame:
    """(doc_id, text, label) of at most `rows` labelled documents outside the held-out bucket.

    The rows are those of least hash of the id, so the choice is the same at every run. The chosen
    ids are at most `rows`, which bounds the broadcast; documents are read where they lie. Of several
    texts of one id, that of least hash counts.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .where(bucket("doc_id", modulus) != remainder)
        .groupBy("doc_id")
        .agg(F.max("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    found = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(least)
    return found.select("doc_id", F.col("least.text").alias("text"), "label")


def cells(members: DataFrame, key: str, member: str, block: int = CELL) -> DataFrame:
    """Members of the keys that several share, sorted by cell, in which any two of a key meet.

    A key's members are cut into blocks of about `block` by hash; a cell is two blocks of a key (its only
    one, if they are few), so a task holds one cell at a time however many members a key has.
    """
    blocks = F.ceil(F.col("n") / block).cast("int")
    sizes = members.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    own = F.pmod(F.xxhash64(key, member), F.col("blocks").cast("long")).cast("int")
    met = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: (b != F.col("own")) | (F.col("blocks") == 1))
    dealt = members.join(sizes.select(key, blocks.alias("blocks")), key).withColumn("own", own)
    dealt = dealt.select("*", F.explode(met).alias("other"))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    dealt = dealt.withColumn("low", low).withColumn("high", high).drop("own", "other", "blocks")
    spread = dealt.repartition(partitions(members.sparkSession), key, "low", "high")
    return spread.sortWithinPartitions(key, "low", "high").withColumnRenamed(key, "cell_key")


def whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one cell after the other, from batches sorted by (cell_key, low, high)."""
    held: list[pa.RecordBatch] = []

    def whole() -> pa.Table:
        return pa.Table.from_batches(held)

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("cell_key", "low", "high")])
        cuts = np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for begin, end in zip(edges, edges[1:]):
            name = tuple(names[:, begin].tolist())
            if held and name != last:
                yield whole()
                held = []
            held.append(batch.slice(begin, end - begin))
            last = name
    if held:
        yield whole()


def forest(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Edges (i, j) of a spanning forest of numbers below n; `near(i, rest)` marks those of `rest` linked to i."""
    edges: list[tuple[int, int]] = []
    rest = np.arange(n)
    while len(rest):
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            i = front.pop()
            linked = near(i, rest)
            found = rest[linked].tolist()
            if found:
                edges += [(i, j) for j in found]
                front += found
                rest = rest[~linked]
    return edges
