"""K-d tree sharding: recursive splits at distributed weighted medians along the widest metadata dimension."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from numprep.llm.common import running_total, stored, text_of

#: A split may miss its weight by this share of the node; a single row heavier than that is never cut.
TOLERANCE = 2.0**-14
#: Histogram rows that come to the driver in one pass, over all nodes.
HISTOGRAM_ROWS = 4096
#: Rows of a shard that are numbered in one task, on average.
ROWS_PER_CELL = 20_000


@dataclass
class Node:
    """A cell of the tree that is to give ``leaves`` shards, and the search for its cut."""

    leaves: int
    first_shard: int
    axis: int = 0
    low: float = 0.0
    high: float = 0.0
    below: float = 0.0
    target: float = 0.0
    weight: float = 0.0
    value: float | None = None  # set while rows that tie at this value are split by their tie-breaker
    cut: tuple[float, float] | None = None
    children: list[Node] = field(default_factory=list)


def position(column: Column, kind: T.DataType) -> Column:
    """A metadata value as a double that keeps its order; text by its first six bytes, missing values lowest."""
    if isinstance(kind, T.StringType):
        first = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 6)), 12, "0")
        return F.coalesce(F.conv(first, 16, 10).cast("double"), F.lit(-1.0))
    number = column.cast("double")
    return F.when(number.isNull() | F.isnan(number), F.lit(-1.0e308)).otherwise(
        F.greatest(F.least(number, F.lit(1.0e300)), F.lit(-1.0e300))
    )


def _unit(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 11).cast("double") * F.lit(2.0**-53)


def _leaf_expression(node: Node, axes: list[str], choose) -> Column:
    if not node.children:
        return choose(node)
    value, tie = node.cut
    axis = F.col(axes[node.axis])
    left = (axis < F.lit(value)) | ((axis == F.lit(value)) & (F.col("_tie") < F.lit(tie)))
    return F.when(left, _leaf_expression(node.children[0], axes, choose)).otherwise(
        _leaf_expression(node.children[1], axes, choose)
    )


def _search(rows: DataFrame, nodes: list[Node], axes: list[str]) -> None:
    """Narrow every node's cut, one histogram of all nodes that have none yet per pass."""
    buckets = max(16, HISTOGRAM_ROWS // len(nodes))
    while any(n.cut is None for n in nodes):
        ranges = F.array(
            *[
                F.struct(
                    F.lit(n.cut is None).alias("open"),
                    F.lit(n.value is not None).alias("tied"),
                    F.lit(n.value or 0.0).alias("value"),
                    F.lit(n.axis + 1).alias("axis"),
                    F.lit(n.low).alias("low"),
                    F.lit(n.high).alias("high"),
                )
                for n in nodes
            ]
        )
        own = rows.withColumn("_at", F.element_at(ranges, F.col("_node") + 1)).where("_at.open")
        on_axis = F.element_at(F.array(*axes), F.col("_at.axis"))
        seen = own.withColumn("_on_axis", on_axis).where("not _at.tied or _on_axis = _at.value")
        valued = seen.withColumn("_x", F.when(F.col("_at.tied"), F.col("_tie")).otherwise(F.col("_on_axis")))
        share = F.try_divide(F.col("_x") / 2 - F.col("_at.low") / 2, F.col("_at.high") / 2 - F.col("_at.low") / 2)
        bucket = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * buckets), F.lit(buckets - 1))
        histogram = (
            valued.where("_x between _at.low and _at.high")
            .groupBy("_node", bucket.alias("_bucket"))
            .agg(F.sum("_weight").alias("w"), F.min("_x").alias("lo"), F.max("_x").alias("hi"))
            .orderBy("_node", "_bucket")
            .collect()
        )
        for number, node in enumerate(nodes):
            if node.cut is None:
                _narrow(node, [r for r in histogram if r["_node"] == number])


def _narrow(node: Node, histogram: list) -> None:
    below = node.below
    for row in histogram:
        if below + row["w"] >= node.target or row is histogram[-1]:
            break
        below += row["w"]
    single = row["lo"] == row["hi"]
    small = row["w"] <= TOLERANCE * node.weight
    if small or (single and node.value is not None):
        before = node.target - below <= below + row["w"] - node.target
        at = row["lo"] if before else math.nextafter(row["hi"], math.inf)
        node.cut = (at, -1.0) if node.value is None else (node.value, at)
    elif single:
        node.value, node.low, node.high, node.below = row["lo"], 0.0, 1.0, below
    else:
        node.low, node.high, node.below = row["lo"], row["hi"], below


def shard(
    docs: DataFrame,
    dimensions: list[str],
    shards: int | None = None,
    target_bytes: int | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Put all rows into shards of nearly equal bytes: (key, size, text_crc32, law, shard, slot, grown_shard).

    A row's size is the UTF-8 bytes of its text (missing: none) plus 1. A node that is to hold k shards is cut, at the
    weighted median if k is even, along the dimension that is widest in it, measured in shares of the whole table's
    extent, until each leaf is one shard. Give the number of shards, or the bytes that no shard should exceed by more
    than a row. Rows that tie on a dimension are cut by a hash of their key and content, and at last of their
    position, so a value that a third of all rows share, or repeated rows, do no harm.

    ``slot`` numbers the rows of a shard from 0 without gaps, ``law`` is ``bytes`` and ``grown_shard`` NULL: the law does
    not let a shard grow by itself. Missing keys, texts and dimension values are allowed, other columns are ignored, and
    an empty table gives no row.

    The texts are read once. What comes after reads a stored narrow table; per pass a histogram of at most
    ``HISTOGRAM_ROWS`` rows reaches the driver, and no row is shuffled until the numbering.
    """
    kinds = {f.name: f.dataType for f in docs.schema}
    axes = [f"_axis{i}" for i in range(len(dimensions))]
    size = F.octet_length(text_of(text)).cast("long") + 1
    base = docs.select(
        F.col(key).alias("_key"),
        size.alias("_weight"),
        F.crc32(text_of(text).cast("binary")).alias("_crc"),
        F.monotonically_increasing_id().alias("_row"),
        *[position(F.col(d), kinds[d]).alias(a) for d, a in zip(dimensions, axes, strict=True)],
    )
    tie = F.floor(_unit(F.xxhash64("_key", "_crc", "_weight")) * F.lit(2.0**32)) * F.lit(2.0**-32) + _unit(
        F.xxhash64(F.col("_row"))
    ) * F.lit(2.0**-32)
    rows = stored(base.withColumns({"_tie": tie, "_draw": _unit(F.xxhash64(F.lit(1), F.col("_row")))}), "kd")
    whole = rows.agg(
        F.count("*").alias("n"),
        F.sum("_weight").alias("w"),
        *[f(a).alias(f"{f.__name__}{a}") for a in axes for f in (F.min, F.max)],
    ).first()
    total = whole["w"] or 0
    count = shards or max(1, math.ceil(total / target_bytes))
    extent = [((whole[f"max{a}"] or 0.0) / 2 - (whole[f"min{a}"] or 0.0) / 2) or 1.0 for a in axes]
    root = Node(leaves=count, first_shard=0)
    level = [root] if total else []
    while level := [n for n in level if n.leaves > 1]:
        numbers = {id(n): i for i, n in enumerate(level)}
        node_of = _leaf_expression(root, axes, lambda n: F.lit(numbers.get(id(n), -1)))
        here = rows.withColumn("_node", node_of).where("_node >= 0")
        spans = here.groupBy("_node").agg(
            F.sum("_weight").alias("w"), *[f(a).alias(f"{f.__name__}{a}") for a in axes for f in (F.min, F.max)]
        )
        for row in spans.collect():
            node = level[row["_node"]]
            spread = [(row[f"max{a}"] / 2 - row[f"min{a}"] / 2) / e for a, e in zip(axes, extent, strict=True)]
            node.axis = max(range(len(axes)), key=lambda i: spread[i])
            node.low, node.high = row[f"min{axes[node.axis]}"], row[f"max{axes[node.axis]}"]
            node.weight, node.target = row["w"], row["w"] * (node.leaves // 2) / node.leaves
        for node in level:
            if not node.weight:  # fewer rows than shards: nothing is left to cut
                node.cut = (0.0, 0.0)
        _search(here, level, axes)
        for node in level:
            half = node.leaves // 2
            node.children = [Node(half, node.first_shard), Node(node.leaves - half, node.first_shard + half)]
        level = [child for node in level for child in node.children]
    shard_of = _leaf_expression(root, axes, lambda n: F.lit(n.first_shard)) if total else F.lit(0)
    cells = max(1, math.ceil((whole["n"] or 0) / (count * ROWS_PER_CELL)))
    placed = rows.select(
        F.col("_key").alias(key),
        F.col("_weight").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        shard_of.cast("int").alias("shard"),
        F.floor(F.col("_draw") * cells).alias("_cell"),
        "_draw",
        "_row",
    )
    numbered = running_total(placed, ["shard"], "_cell", [F.col("_draw"), F.col("_row")], F.lit(1), "slot")
    return numbered.select(
        key, "size", "text_crc32", "law", "shard", F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard")
    )
