"""Sharding by k-d tree partitioning, with DataFrame operations only.

A node of the tree stands for some shards. It is cut along its widest metadata dimension (range within
the node over range in the table) at the weighted median: the place that leaves each side bytes in
proportion to its shards. Leaves hold one shard each, so their bytes come close to total / shards.

The medians of all nodes of a level are searched at once, each round being one aggregation: rows count into
``BINS`` equal bins of their node's open key range, a running sum finds the bin in which the median
lies, and the range between that bin's own smallest and largest key is searched next, until it holds
little enough. Only those bins (one row per node) reach the driver. The keys continue below equal
coordinates with the text's hash and a row's number, so a value that a third of all rows share is cut like
any other, and equal texts stay side by side. The tree is a small nested CASE over a row's
own columns: no join and no shuffle of the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed

BINS = 2048
#: A range is small enough when it holds at most this share of a shard's bytes, or one row.
TOLERANCE = 0.0005
#: Bytes of a document besides its text.
OVERHEAD = 16
#: Rows that are numbered together.
SLOT_ROWS = 20_000
_COORDINATE_BITS, _TIE_BITS = 31, 31


@dataclass
class Node:
    """A part of the key space and its shards; cut at ``key < at`` of a dimension unless it is a leaf."""
    first: int
    shards: int
    dimension: int | None = None
    at: int = 0
    left: Node | None = None
    right: Node | None = None

    def leaves(self) -> list[Node]:
        return [self] if self.left is None else self.left.leaves() + self.right.leaves()

    def sql(self, keys: list[str], value: Callable[[Node], str] = lambda leaf: str(leaf.first)) -> str:
        """SQL of a value of the leaf that a row lies in; its first shard unless told otherwise."""
        if self.left is None:
            return value(self)
        return (f"CASE WHEN {keys[self.dimension]} < {self.at}L THEN {self.left.sql(keys, value)} "
                f"ELSE {self.right.sql(keys, value)} END")


def document_dimensions() -> dict[str, Column]:
    """Metadata of documents as numbers: logarithm of the length, language, source, id."""
    def label(name: str) -> Column:
        return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")).cast("double")
    return {"length": F.log2(F.octet_length(F.coalesce("text", F.lit(""))) + 1.0), "lang": label("lang"), "source": label("source"),
            "id": F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0))}


def _key(name: str, low: float, high: float) -> str:
    """SQL of a dimension's key: the coordinate scaled to 31 bits, then 31 bits that tell ties apart."""
    if not high > low:
        return "tie"
    top = (1 << _COORDINATE_BITS) - 1
    return f"(shiftleft(CAST(least(greatest(({name} - {low!r}D) / {high - low!r}D, 0D), 1D) * {top} AS BIGINT), {_TIE_BITS}) + tie)"


def with_keys(rows: DataFrame, dimensions: list[str]) -> DataFrame:
    """``rows`` with each dimension (a double) replaced by its key: the coordinate scaled to 31 bits over
    the table's range, then the 31 bits of ``tie``. Written once: every round reads only these columns."""
    ends = rows.agg(*[f(d).alias(f"{f.__name__}_{d}") for d in dimensions for f in (F.min, F.max)]).first()
    keys = {d: F.expr(_key(d, ends[f"min_{d}"] or 0.0, ends[f"max_{d}"] or 0.0)) for d in dimensions}
    return checkpointed(rows.withColumns(keys).drop("tie"))


def kd_tree(rows: DataFrame, keys: list[str], shards: int) -> Node:
    """The tree over rows with ``size`` and these key columns."""
    root = Node(0, shards)
    while open_nodes := [n for n in root.leaves() if n.shards > 1]:
        _cut(rows, keys, root, open_nodes)
    return root


def _cut(rows: DataFrame, keys: list[str], root: Node, nodes: list[Node]) -> None:
    """Cut all these leaves of the tree."""
    def per_leaf(value: Callable[[dict], str]) -> str:
        return root.sql(keys, lambda leaf: value(search[leaf.first]) if leaf.first in search else "NULL")

    search: dict[int, dict] = {n.first: {"node": n} for n in nodes}
    placed = rows.selectExpr("size", f"CAST({per_leaf(lambda s: str(s['node'].first))} AS INT) AS node", *keys).filter("node IS NOT NULL")
    found = {r["node"]: r for r in placed.groupBy("node").agg(
        F.sum("size").alias("size"), *[f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max)]).collect()}
    cuts: dict[int, tuple[int, int]] = {n.first: (0, 0) for n in nodes}  # (dimension, at); without rows any place will do
    for n in nodes:
        if not (r := found.get(n.first)):
            del search[n.first]
            continue
        wide = max(keys, key=lambda k: (r[f"max_{k}"] >> _TIE_BITS) - (r[f"min_{k}"] >> _TIE_BITS))
        search[n.first] |= {"key": wide, "low": r[f"min_{wide}"], "high": r[f"max_{wide}"] + 1, "before": 0,
                            "wanted": r["size"] * (n.shards // 2) / n.shards, "enough": TOLERANCE * r["size"] / n.shards}
    while search:
        def bin_of(s: dict) -> str:
            step = -(-(s["high"] - s["low"]) // BINS)
            return f"CASE WHEN {s['key']} >= {s['low']}L AND {s['key']} < {s['high']}L THEN ({s['key']} - {s['low']}L) DIV {step}L END"

        inside = rows.selectExpr("size", f"CAST({per_leaf(lambda s: str(s['node'].first))} AS INT) AS node",
                                 f"{per_leaf(lambda s: s['key'])} AS key", f"{per_leaf(bin_of)} AS bin").filter("bin IS NOT NULL")
        bins = inside.groupBy("node", "bin").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"),
                                                 F.min("key").alias("low"), F.max("key").alias("high"))
        upto = F.sum("size").over(Window.partitionBy("node").orderBy("bin"))  # at most BINS rows per node
        open_bytes = " ".join(f"WHEN {k} THEN {s['wanted'] - s['before']!r}D" for k, s in search.items())
        crossing = bins.withColumn("upto", upto).filter(f"upto >= CASE node {open_bytes} END")
        first = crossing.groupBy("node").agg(F.min_by(F.struct("size", "n", "low", "high", "upto"), "bin").alias("b")).select("node", "b.*")
        for r in first.collect():
            s = search[r["node"]]
            before, after = s["before"] + r["upto"] - r["size"], s["before"] + r["upto"]
            if r["size"] <= s["enough"] or r["n"] == 1 or r["low"] == r["high"]:
                cuts[r["node"]] = (keys.index(s["key"]), r["low"] if s["wanted"] - before < after - s["wanted"] else r["high"] + 1)
                del search[r["node"]]
            else:
                s["low"], s["high"], s["before"] = r["low"], r["high"] + 1, before
    for n in nodes:
        left = n.shards // 2
        n.dimension, n.at = cuts[n.first]
        n.left, n.right = Node(n.first, left), Node(n.first + left, n.shards - left)


def number_rows(rows: DataFrame, group: str, order: str, slot: str = "slot") -> DataFrame:
    """Gapless numbers from 0 within each group, without one task per group: rows are
    numbered within buckets of a group, which start where the bucket before ends."""
    largest = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    buckets = max(1, -(-largest // SLOT_ROWS))
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(order), F.lit(buckets)))
    counts = dealt.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_bucket")) - F.col("_n")
    starts = counts.withColumn("_start", before).drop("_n")
    place = F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(order)) - 1
    return (dealt.withColumn("_place", place).join(starts, [group, "_bucket"])
            .withColumn(slot, F.col("_start") + F.col("_place")).drop("_bucket", "_place", "_start"))


def shard_documents(docs: DataFrame, shards: int, dimensions: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law (``bytes``), shard, slot, grown_shard (null) per document.

    A null text has no bytes and the checksum of the empty text; null metadata counts as empty or 0.
    Repeated rows each get a place of their own and may be cut apart; an empty table gives no rows;
    other columns are not read.
    """
    dimensions = dimensions or document_dimensions()
    names = [f"d{i}" for i in range(len(dimensions))]
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    half = _TIE_BITS // 2
    number = F.monotonically_increasing_id()
    tie = (F.shiftleft(F.xxhash64("text").bitwiseAND((1 << (_TIE_BITS - half)) - 1), half)
           + F.xxhash64("number").bitwiseAND((1 << half) - 1))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(data) + OVERHEAD).cast("bigint").alias("size"),
                       F.crc32(data).alias("text_crc32"), number.alias("number"), F.col("text"),
                       *[c.cast("double").alias(n) for n, c in zip(names, dimensions.values())])
    # the row numbers must stay what they are, and the texts are read no more
    rows = with_keys(checkpointed(rows.withColumn("tie", tie).drop("text")), names)
    tree = kd_tree(rows, names, shards)
    placed = rows.select("doc_id", "size", "text_crc32", "number", F.expr(tree.sql(names)).cast("int").alias("shard"))
    return number_rows(placed, "shard", "number").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
