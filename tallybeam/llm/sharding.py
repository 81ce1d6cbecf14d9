"""Sharding by a hierarchical weighted hash tree.

A document descends regions, racks and shards. At each node every child draws ln(u) / weight with u in (0, 1] hashed from the
document's key and the child's name, and the largest draw wins; so a child's share is its weight over the sum, and a changed
weight moves rows only into or out of the subtree whose weight changed. A shard that is added as a region of its own
changes no other subtree, so it takes rows only into itself: the law `key`. A shard added inside a rack also
raises the weights above it and may move rows within that region alone.

Only DataFrame functions are used. The number of draws is the sum of the fan-outs on the way, not the number of shards. Hashes are MD5, so SQL can draw alike.

Slots number the rows of a shard in order of a hash of doc_id and the text's checksum, by ranges of that order with row numbers last (running()), so no task holds
a shard and equal rows are spread too.

Defined results: null texts have 8 bytes and the checksum of no bytes; rows with a null doc_id share one key. Repeated rows get the same shard
and slots of their own, gapless in each shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybeam.llm.common import materialise, running

SEED = 20_011
SHARDS = 24
#: Hexadecimal digits of a hash that make a number.
DIGITS = 13


@dataclass(frozen=True)
class Node:
    """A subtree; a leaf has a shard number. Its name, not its position, decides its draws."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def tree(shards: int = SHARDS, layout: tuple[int, int, int] = (2, 3, 4)) -> Node:
    """The layout's regions, racks and shards of equal weight; shards beyond it are regions of one rack and one shard."""
    regions, racks, leaves = layout
    if shards < regions * racks * leaves:
        raise ValueError(f"the layout alone has {regions * racks * leaves} shards")
    number = iter(range(shards))
    leaf = lambda rack: Node(f"{rack}/{(n := next(number))}", shard=n)
    top = [Node(f"g{g}", tuple(Node(f"g{g}/r{r}", tuple(leaf(f"g{g}/r{r}") for _ in range(leaves))) for r in range(racks))) for g in range(regions)]
    top += [Node(f"s{n}", (Node(f"s{n}/r0", (Node(f"s{n}/r0/{n}", shard=n),)),)) for n in number]
    return Node("", tuple(top))


def number(*parts: Column) -> Column:
    """0 to 16^DIGITS - 1 from the MD5 of the parts, joined by bars."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, DIGITS), 16, 10).cast("long")


def draw(key: Column, child: Node, seed: int) -> Column:
    """ln(u) / weight; a weight of 0 never wins."""
    if child.weight <= 0:
        return F.lit(float("-inf"))
    u = (number(F.lit(str(seed)), F.lit(child.name), key) + 1).cast("double") / float(16**DIGITS)
    return F.log(u) / F.lit(float(child.weight))


def winner(key: Column, children: tuple[Node, ...], seed: int) -> Column:
    """The name of the child with the largest draw (of equal ones the last name)."""
    if len(children) == 1:
        return F.lit(children[0].name)
    return F.array_max(F.array(*(F.struct(draw(key, c, seed).alias("draw"), F.lit(c.name).alias("name")) for c in children)))["name"]


def descend(rows: DataFrame, key: str, top: Node, out: str, seed: int = SEED) -> DataFrame:
    """rows with the shard of the key as column `out`, level by level, so each row draws for the children on its way only."""
    level: list[Node] = [top]
    rows = rows.withColumn(out, F.lit(top.name))
    while any(n.children for n in level):
        step = F.col(out)
        for n in level:
            if n.children:
                step = F.when(F.col(out) == n.name, winner(F.col(key), n.children, seed)).otherwise(step)
        rows = rows.withColumn(out, step)
        level = [c for n in level for c in (n.children or (n,))]
    shards = F.create_map(*(F.lit(x) for n in level for x in (n.name, n.shard)))
    return rows.withColumn(out, F.element_at(shards, F.col(out)))


def assign(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (with one more shard)."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("key"),
    )
    rows = descend(descend(rows, "key", tree(shards), "shard", seed), "key", tree(shards + 1), "grown_shard", seed)
    place = number(F.lit(f"{seed}-slot"), F.col("key"), F.col("text_crc32").cast("string"))
    rows = materialise(rows.select("*", place.alias("place"), F.lit(1).alias("one"), F.monotonically_increasing_id().alias("row")).drop("key"), "shards")
    order = [F.col(c) for c in ("place", "doc_id", "text_crc32", "size", "row")]
    return running(rows, order, {"slot": "one"}, ["shard"]).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")
