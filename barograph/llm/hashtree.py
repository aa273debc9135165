"""Sharding by a hierarchical weighted hash tree.

A tree has regions, regions have racks, racks have shards, and each shard has a
weight; a rack or region weighs what its shards weigh together. A key descends
from the root: at each level every child draws ``-ln(u) / weight`` with ``u`` a
hash of key and child in (0, 1), and the smallest draw wins. A child wins in
proportion to its weight, and a draw depends on nothing but key, child and its
weight: where weights change in one subtree, keys move only into or out of the
subtrees on its path. A shard added as a region of its own takes keys only into
itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.llm.tables import numbered, stored, text_or_empty

#: Steps of the hash draw: the upper 53 bits of a 64-bit hash.
STEPS = float(2**53)


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def even_tree(shards: int, per_rack: int = 4, racks: int = 2) -> list[Shard]:
    """Shards of weight 1, four to a rack and two racks to a region."""
    per_region = per_rack * racks
    return [
        Shard(f"r{n // per_region}", f"r{n // per_region}k{n % per_region // per_rack}", n)
        for n in range(shards)
    ]


def with_shard(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """The tree and one more shard, as a region of its own: no other shard gains rows."""
    number = max((leaf.shard for leaf in tree), default=-1) + 1
    return [*tree, Shard(f"new{number}", f"new{number}k", number, weight)]


def _checked(tree: list[Shard]) -> None:
    if not tree:
        raise ValueError("a tree needs a shard")
    if any(not 0 < leaf.weight < float("inf") for leaf in tree):
        raise ValueError("weights must be positive and finite")
    if len({leaf.shard for leaf in tree}) < len(tree):
        raise ValueError("a shard is in the tree twice")
    homes = {leaf.rack: leaf.region for leaf in tree}
    if any(homes[leaf.rack] != leaf.region for leaf in tree):
        raise ValueError("a rack is in two regions")


def _draw(key: Column, label: str, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(label)), 11)
    return -F.log((bits.cast("double") + 0.5) / F.lit(STEPS)) / F.lit(float(weight))


def _winner(key: Column, children: dict[str, tuple[float, Column]]) -> Column:
    """The value of the child with the smallest draw; equal draws go to the smaller name."""
    if len(children) == 1:
        return next(iter(children.values()))[1]
    labels = sorted(children)
    draws = F.array(*[F.struct(_draw(key, n, children[n][0]), F.lit(n)) for n in labels])
    first = F.array_min(draws)["col2"]
    chosen = F.when(first == labels[0], children[labels[0]][1])
    for label in labels[1:]:
        chosen = chosen.when(first == label, children[label][1])
    return chosen


def shard_of(key: Column, tree: list[Shard]) -> Column:
    """The shard of a key. A null key is a key like any other."""
    _checked(tree)
    regions: dict[str, dict[str, list[Shard]]] = {}
    for leaf in tree:
        regions.setdefault(leaf.region, {}).setdefault(leaf.rack, []).append(leaf)
    weighed: dict[str, tuple[float, Column]] = {}
    for region, racks in regions.items():
        children = {}
        for rack, leaves in racks.items():
            within = {
                f"shard/{x.shard}": (x.weight, F.lit(x.shard).cast("int")) for x in leaves
            }
            children[f"rack/{rack}"] = (sum(x.weight for x in leaves), _winner(key, within))
        total = sum(weight for weight, _ in children.values())
        weighed[f"region/{region}"] = (total, _winner(key, children))
    return _winner(key, weighed)


def sharded(
    docs: DataFrame, tree: list[Shard], grown: list[Shard], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Each document's shard, its place there, and its shard in the grown tree.

    The law is ``key``: the id alone decides, so copies of a text may part and
    rows of one id stay together. Size is the UTF-8 length plus 1. Null text: no
    bytes, CRC 0. Null id: hashed like any other key. Repeated rows: one row
    each, with slots of their own. Empty table: no rows. Other columns are not
    looked at. Slots are gapless within a shard and follow no order.
    """
    body = F.encode(text_or_empty(text), "UTF-8")
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(text_or_empty(text)) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col(key), tree).alias("shard"),
        shard_of(F.col(key), grown).alias("grown_shard"),
    )
    placed = numbered(stored(rows, "shards"), ["shard"], ["doc_id"], "slot")
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
