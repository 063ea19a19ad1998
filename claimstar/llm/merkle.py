"""Merkle manifest of a dataset: a hash tree per language, one over their roots, a proof per row.

Nested-interval labels. The leaves of a tree are numbered by a range sort, and every node carries the
interval [lo, hi) of the leaf numbers that it covers, so a node's ancestors are the nodes whose
intervals contain its own, and its siblings are what is left of its parent's interval without its
own. Levels are dealt with in bands: a bucket holds the up to fanout^LEVELS nodes under one node of
the band's top level, so no group grows with the data.

Upwards, each band groups its entries by bucket and hashes them level by level into the node table
(the manifest); the buckets' tops are the next band's entries. Downwards, entries meet the nodes of
their bucket and what is known of the bucket's top (its siblings and the roots) in a join on tree and
bucket; within it they find their ancestors by containment. Leaves, numbers and nodes are written to
the shared folder once each, so sizes and numbers stay the same when a task is run again.

Nulls: a null field is hashed as `-`; a null language is a tree of its own, the first; a null doc_id
comes first in its tree. Rows of one doc_id are ordered by their leaves; equal rows are equal leaves
in a row, so any order among them gives the same tree. Empty texts are fields of 0 bytes. An empty
table gives an empty result. Columns beyond those hashed stay behind.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimstar.llm import common

FANOUT = 2
LEVELS = 10  # of a band; a bucket holds up to FANOUT ** LEVELS entries
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODES = "tree string, total long, entries long, bucket long, level int, lo long, hi long, digest string"
_ROW_BITS = 33  # of monotonically_increasing_id, below the number of the partition


def field(column: Column) -> Column:
    """A value that no other field's end can be taken for: its size in bytes, a colon, its text."""
    text = column.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaf(*columns: Column) -> Column:
    """The digest of a row, as lowercase hex."""
    return F.sha2(F.concat(*map(field, columns)).cast("binary"), 256)


def _digest(texts: list[str]) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def _whole(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    """The frame, written once."""
    return common.stored(frame, f"merkle-{name}")


def numbered(entries: DataFrame, order: list[str]) -> DataFrame:
    """Rows (tree, digest, any others) with their number in the tree, by `order`, and the tree's size.

    The range sort also goes by a number that each row gets as it is written, so equal rows spread.
    """
    spark = entries.sparkSession
    rows = _whole(spark, entries.withColumn("row", F.monotonically_increasing_id()), "rows")
    by = ["tree", *order, "digest", "row"]
    ordered = rows.repartitionByRange(common.partitions(spark), *by).sortWithinPartitions(*by)
    place = F.monotonically_increasing_id()
    placed = _whole(spark, ordered.drop("row").withColumn("place", place), "places")
    placed = placed.withColumn("part", F.shiftright("place", _ROW_BITS))
    parts = placed.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(
        "tree",
        "part",
        (F.col("first") - F.coalesce(before, F.lit(0))).alias("shift"),
        F.sum("n").over(tree).alias("total"),
    )
    joined = placed.join(parts, ["tree", "part"]).withColumn("lo", F.col("place") - F.col("shift"))
    return joined.drop("part", "place", "shift").withColumn("hi", F.col("lo") + 1)


def _bucketed(entries: DataFrame, width: int) -> DataFrame:
    """Leaves as the entries of the first band."""
    bucket = F.floor(F.col("lo") / width).cast("long")
    return entries.withColumn("entries", F.col("total")).withColumn("bucket", bucket)


def _climber(fanout: int, levels: int, band: int):
    width = fanout**levels

    def climb(entries: pa.Table) -> pa.Table:
        """The nodes above a bucket's entries, up to the band's top or the tree's root."""
        entries = entries.sort_by("lo")
        total, count, bucket = (entries[c][0].as_py() for c in ("total", "entries", "bucket"))
        lo, hi, digest = (entries[c].to_pylist() for c in ("lo", "hi", "digest"))
        rows = []
        level = band * levels
        while len(digest) > 1 if count <= width else level < (band + 1) * levels:
            level += 1
            runs = range(0, len(digest), fanout)
            hi = [hi[min(i + fanout, len(hi)) - 1] for i in runs]
            lo = [lo[i] for i in runs]
            digest = [_digest(digest[i : i + fanout]) for i in runs]
            rows += [(level, *node) for node in zip(lo, hi, digest)]
        columns = list(zip(*rows)) or [(), (), (), ()]
        n = len(rows)
        return pa.table(
            {
                "tree": pa.array([entries["tree"][0].as_py()] * n, pa.string()),
                "total": pa.array([total] * n, pa.int64()),
                "entries": pa.array([count] * n, pa.int64()),
                "bucket": pa.array([bucket] * n, pa.int64()),
                "level": pa.array(columns[0], pa.int32()),
                "lo": pa.array(columns[1], pa.int64()),
                "hi": pa.array(columns[2], pa.int64()),
                "digest": pa.array(columns[3], pa.string()),
            }
        )

    return climb


def bands(leaves: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> list[tuple[DataFrame, DataFrame]]:
    """Per band its entries and the nodes above them, from numbered leaves upwards."""
    width = fanout**levels
    entries = _bucketed(leaves, width)
    largest = leaves.agg(F.max("total")).first()[0] or 0  # one number
    out = []
    while True:
        band = len(out)
        narrow = entries.select("tree", "total", "entries", "bucket", "lo", "hi", "digest")
        nodes = narrow.groupBy("tree", "bucket").applyInArrow(_climber(fanout, levels, band), NODES)
        nodes = _whole(leaves.sparkSession, nodes, f"nodes-{band}")
        out.append((entries, nodes))
        if largest <= width:
            return out
        largest = -(-largest // width)
        tops = nodes.where((F.col("level") == (band + 1) * levels) & (F.col("entries") > width))
        entries = tops.drop("level").withColumnRenamed("bucket", "number").withColumns(
            {
                "entries": F.ceil(F.col("entries") / width).cast("long"),
                "bucket": F.floor(F.col("number") / width).cast("long"),
            }
        )


def manifest(built: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """The node table: tree, level, lo, hi, digest of every leaf and node."""
    frames = [built[0][0].withColumn("level", F.lit(0)), *(nodes for _, nodes in built)]
    out = None
    for frame in frames:
        part = frame.select("tree", "total", "level", "lo", "hi", "digest")
        out = part if out is None else out.union(part)
    return out


def roots(built: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """tree, total, digest of the node of each tree that covers all its leaves."""
    whole = (F.col("lo") == 0) & (F.col("hi") == F.col("total"))
    return manifest(built).where(whole).select("tree", "total", "digest")


def _contained(lo, hi, inner_lo, inner_hi) -> np.ndarray:
    """The interval that contains each inner one; both sides ascend and do not overlap."""
    at = np.searchsorted(lo, inner_lo, side="right") - 1
    if not ((lo[at] <= inner_lo) & (inner_hi <= hi[at])).all():
        raise ValueError("a node without an ancestor: the node table is not whole")
    return at


def _attach(entries: pa.Table, above: pa.Table) -> pa.Table:
    """Entries of a bucket with the siblings of all their ancestors, up to the root."""
    entries = entries.sort_by("lo")
    if not entries.num_rows:
        return _with_proofs(entries, [], [], [], [], None, None)
    is_node = pc.is_valid(above["level"])
    top = above.filter(pc.invert(is_node)).to_pylist()[0]
    nodes = above.filter(is_node).sort_by([("level", "ascending"), ("lo", "ascending")])
    level_of = nodes["level"].to_numpy()
    node_lo, node_hi = nodes["lo"].to_numpy(), nodes["hi"].to_numpy()
    node_digest = nodes["digest"].to_pylist()
    lo, hi, digest = entries["lo"].to_numpy(), entries["hi"].to_numpy(), entries["digest"].to_pylist()
    ancestor = np.arange(len(lo))
    before: list[pa.Array] = []
    after: list[pa.Array] = []
    for level in np.unique(level_of):
        a, b = np.searchsorted(level_of, [level, level + 1])
        up_lo, up_hi = node_lo[a:b], node_hi[a:b]
        parent = _contained(up_lo, up_hi, lo, hi)
        first = np.searchsorted(lo, up_lo)[parent].tolist()
        last = np.searchsorted(lo, up_hi)[parent].tolist()
        left = ["".join(digest[first[i] : i]) for i in range(len(digest))]
        right = ["".join(digest[i + 1 : last[i]]) for i in range(len(digest))]
        before.append(pa.array(left, pa.string()).take(pa.array(ancestor)))
        after.append(pa.array(right, pa.string()).take(pa.array(ancestor)))
        ancestor = parent[ancestor]
        lo, hi, digest = up_lo, up_hi, node_digest[a:b]
    root = top["root"] if top["root"] is not None else digest[0]
    return _with_proofs(entries, before, after, top["before"], top["after"], top["subroot"], root)


def _with_proofs(entries, before, after, more_before, more_after, subroot, root) -> pa.Table:
    n, height = entries.num_rows, len(before)
    steps = height + len(more_before)

    def lists(own: list[pa.Array], shared: list[str]) -> pa.Array:
        flat = pa.concat_arrays([*own, pa.array(shared, pa.string())])
        at = np.empty((n, steps), np.int64)
        at[:, :height] = np.arange(height) * n + np.arange(n)[:, None]
        at[:, height:] = height * n + np.arange(len(shared))
        return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * steps, flat.take(pa.array(at.ravel())))

    out = entries.drop_columns(["entries", "bucket"])
    out = out.append_column("before", lists(before, more_before))
    out = out.append_column("after", lists(after, more_after))
    out = out.append_column("subroot", pa.array([subroot] * n, pa.string()))
    return out.append_column("root", pa.array([root] * n, pa.string()))


_TOP = "before array<string>, after array<string>, subroot string, root string"


def attached(built: list[tuple[DataFrame, DataFrame]], tops: DataFrame, width: int) -> DataFrame:
    """The entries of the first band with their proofs, from the roots of the trees downwards.

    `tops`: per tree what lies above its root: tree, before, after, subroot, root.
    """
    known = None  # proofs of the band above
    for entries, nodes in reversed(built):
        names = ["tree", "bucket", "level", "lo", "hi", "digest", "before", "after", "subroot", "root"]
        void = {c: F.lit(None).cast(t) for c, t in (f.rsplit(" ", 1) for f in _TOP.split(", "))}
        above = nodes.withColumns(void).select(*names)
        ends = entries.where(F.col("entries") <= width).select("tree", "total").distinct()
        none = {"level": F.lit(None).cast("int"), "digest": F.lit(None).cast("string")}
        own = ends.join(tops, "tree").withColumns(
            {**none, "bucket": F.lit(0).cast("long"), "lo": F.lit(0).cast("long"), "hi": F.col("total")}
        )
        above = above.union(own.select(*names))
        if known is not None:
            below = known.withColumn("bucket", F.col("number")).withColumns(none)
            above = above.union(below.select(*names))
        kept = [f for f in entries.schema.fields if f.name not in ("entries", "bucket")]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", " + _TOP
        known = (
            entries.groupBy("tree", "bucket")
            .cogroup(above.groupBy("tree", "bucket"))
            .applyInArrow(_attach, schema)
        )
    return known


def proofs(
    rows: DataFrame, by: str = "lang", order: tuple[str, ...] = ("doc_id",), digest: str = "leaf",
    fanout: int = FANOUT, levels: int = LEVELS,
) -> DataFrame:
    """The rows with their proofs: before and after, per level the siblings' digests joined, up to the
    tree's own root (subroot) and on to that over all trees (root).

    A tree holds the rows of one value of `by`, ordered by `order`; the trees' roots, ordered by that
    value, nulls first, are the leaves of the last tree.
    """
    width = fanout**levels
    leaves = numbered(
        rows.withColumn("tree", field(F.col(by))).withColumnRenamed(digest, "digest"), list(order)
    )
    built = bands(leaves, fanout, levels)
    values = leaves.where("lo = 0").select("tree", F.col(by).alias("value"))
    subroots = roots(built).join(values, "tree").select(F.lit("").alias("tree"), "value", "digest")
    last = bands(numbered(subroots, ["value"]), fanout, levels)
    nothing = F.array().cast("array<string>")
    void = F.lit(None).cast("string")
    start = last[0][0].where("lo = 0").select(
        "tree", nothing.alias("before"), nothing.alias("after"), void.alias("subroot"), void.alias("root")
    )
    tops = attached(last, start, width).select(
        field(F.col("value")).alias("tree"), "before", "after", F.col("digest").alias("subroot"), "root"
    )
    tops = _whole(rows.sparkSession, tops, "subroots")
    out = attached(built, tops, width).drop("tree", "total", "lo", "hi")
    return out.withColumnRenamed("digest", digest)


def folded(digest: Column) -> Column:
    """The root that a leaf's digest gives with the siblings of a row of `proofs`."""
    step = lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]).cast("binary"), 256)
    return F.aggregate(F.arrays_zip("before", "after"), digest, step)


def siblings_digest() -> Column:
    """One digest of all siblings of a row of `proofs`, level by level."""
    parts = F.transform(F.arrays_zip("before", "after"), lambda s: F.concat(s["before"], s["after"]))
    return F.sha2(F.array_join(parts, "").cast("binary"), 256)


def document_leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf, and changed: the leaf with n_chars one higher where 7 divides the id's crc32."""
    values = {c: F.col(f"`{c}`") for c in FIELDS}
    original = leaf(*values.values())
    more = leaf(*(values | {"n_chars": values["n_chars"] + 1}).values())
    chosen = F.crc32(values["doc_id"].cast("string")) % 7 == 0
    return docs.select(
        values["doc_id"].cast("long").alias("doc_id"),
        values["lang"].cast("string").alias("lang"),
        original.alias("leaf"),
        F.when(chosen, more).alias("changed"),
    )


def digests(proven: DataFrame) -> DataFrame:
    """The contract's columns."""
    root = folded(F.coalesce("changed", "leaf"))
    return proven.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        siblings_digest().alias("proof_sha256"),
        root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(proofs(document_leaves(common.table(spark, sf_dir, "documents"))))
