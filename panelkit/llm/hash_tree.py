"""Shards chosen by descending a weighted tree of regions, racks and shards.

At every node each child draws a number from the hash of the key and the child's
own name, and the child with the smallest ``-ln(u) / weight`` wins; so a child is
chosen with a probability in proportion to its weight, a subtree's being the sum
of its leaves. The draw of a child depends on nothing but key and name. When the
weight of one subtree grows, keys therefore only move into that subtree, and
draws inside all other subtrees stay as they are. A new shard takes keys only
into itself when it comes as a subtree of its own (a new region).

Everything is a built-in expression. A key's place needs no data but the key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.names import free_names
from panelkit.session import materialise

# Weight of a shard, or the shards of a rack, or the racks of a region, by name.
Tree = Mapping[str, "Tree | float"]

ROW_BITS = (1 << 33) - 1


def regular_tree(shards: int, per_rack: int = 4, racks_per_region: int = 2) -> dict:
    """Equal shards numbered from 0, filled into racks and regions in order.

    With one shard more than whole regions hold, that shard has a region of its own.
    """
    tree: dict = {}
    for shard in range(shards):
        rack = shard // per_rack
        region = rack // racks_per_region
        tree.setdefault(f"region{region}", {}).setdefault(f"rack{rack}", {})[str(shard)] = 1.0
    return tree


def weight_of(tree: Tree | float) -> float:
    return sum(map(weight_of, tree.values())) if isinstance(tree, Mapping) else float(tree)


def _depth(tree: Tree | float) -> int:
    return 1 + max(map(_depth, tree.values()), default=0) if isinstance(tree, Mapping) else 0


def draw(key: Sequence[Column], children: Mapping[str, Tree | float], path: str) -> Column:
    """The name of the child that wins the draw at node ``path``."""
    def score(name: str, below: Tree | float) -> Column:
        mixed = F.xxhash64(*key, F.lit(f"{path}/{name}"))
        u = (F.shiftrightunsigned(mixed, 11).cast("double") + 0.5) / float(1 << 53)
        return F.struct((-F.log(u) / weight_of(below)).alias("score"), F.lit(name).alias("name"))

    alive = {name: below for name, below in children.items() if weight_of(below) > 0}
    if not alive:
        raise ValueError(f"no child of {path or 'the root'} has a weight")
    if len(alive) == 1:
        return F.lit(next(iter(alive)))
    return F.array_min(F.array(*[score(name, below) for name, below in alive.items()]))["name"]


def descend(df: DataFrame, key: Sequence[str], tree: Tree, out: str = "shard") -> DataFrame:
    """Add ``out``, the name of the shard of every row, level by level.

    All branches have the same depth. Rows with equal keys go to the same shard;
    a null key column counts as absent, so rows with all keys null share a shard.
    An empty frame stays empty.
    """
    columns = [F.col(f"`{c}`") for c in key]
    level: dict[str, Tree | float] = {"": tree}
    at = free_names([*df.columns, out], *[f"_at_{i}" for i in range(_depth(tree))])
    step = 0
    while any(isinstance(node, Mapping) for node in level.values()):
        if not all(isinstance(node, Mapping) for node in level.values()):
            raise ValueError("all branches of the tree need the same depth")
        chosen = None
        for path, node in level.items():
            pick = F.concat(F.lit(f"{path}/"), draw(columns, node, path))
            if step == 0:
                chosen = pick
            else:
                here = F.col(at[step - 1]) == path
                chosen = F.when(here, pick) if chosen is None else chosen.when(here, pick)
        df = df.withColumn(at[step], chosen)
        level = {f"{path}/{name}": below for path, node in level.items() for name, below in node.items()}
        step += 1
    name = F.element_at(F.split(F.col(at[step - 1]), "/"), -1)
    return df.withColumn(out, name).drop(*at)


def number_within(df: DataFrame, group: str, out: str = "slot") -> DataFrame:
    """Number the rows of every group from 0 without gaps, however large a group is.

    Rows are written with the number of their partition. The rows of a group that
    one partition holds are numbered together, and the counts of the partitions
    before it are added; so no task sees a whole group. Null is a group as well.
    """
    piece, row, key, of, n, shift, place = free_names([*df.columns, out], "_piece", "_row", "_group", "_of", "_n", "_shift", "_place")
    placed = df.withColumns({piece: F.spark_partition_id(), row: F.monotonically_increasing_id()})
    placed = materialise(placed, "numbered")
    counts = placed.groupBy(F.col(f"`{group}`").alias(key), F.col(piece).alias(of)).agg(F.count(F.lit(1)).alias(n))
    earlier = Window.partitionBy(key).orderBy(of).rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(key, of, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(shift))
    inside = Window.partitionBy(piece, F.col(f"`{group}`")).orderBy(row)
    numbered = placed.withColumn(place, F.row_number().over(inside))
    return numbered.join(shifts, F.col(f"`{group}`").eqNullSafe(F.col(key)) & (F.col(piece) == F.col(of))).select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col(shift) + F.col(place) - 1).cast("bigint").alias(out))
