"""Merkle manifest of a dataset: a digest of every row, a tree over them, a proof for each.

Rows are leaves of one tree per language, whose roots are the leaves of a tree over languages. A
superblock is a run of ``FAN ** HEIGHT`` neighbouring nodes. Going up, each superblock is reduced to
one node, these are numbered and grouped again, until a tree has one node. Going down, the nodes of
a superblock are cogrouped with the outer nodes it requires, those beside its way to the root, and
hand their own ways on; at the leaves the same step joins the proofs and folds them. No task holds
more than a superblock with its outer nodes, whatever the size of a tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.llm.common import stash

#: Children of a node, and levels of a superblock.
FAN, HEIGHT = 8, 4
#: Levels of the tree over languages come after all levels of a language's tree.
OVER = 100

_NODE = "tree string, rank bigint, n bigint, digest string"
#: An outer node of a superblock: a ``sibling`` of its way at a level, the way's ``own`` place there, or a root.
_OUTER = "tree string, block bigint, level int, kind string, place int, digest string"


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def heights(n: int, fan: int) -> int:
    """Levels until ``n`` nodes are one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fan), levels + 1
    return levels


def climb(nodes: Sequence[str], levels: int, fan: int) -> list[list[str]]:
    """The nodes of each level of a superblock, its bottom first."""
    rows = [list(nodes)]
    for _ in range(levels):
        rows.append([digest(rows[-1][i:i + fan]) for i in range(0, len(rows[-1]), fan)])
    return rows


def fold(leaf: str, way: Sequence[tuple[int, Sequence[str]]]) -> str:
    """The root from a leaf and its way: at each level its place in the run and the others of the run."""
    for place, others in way:
        leaf = digest([*others[:place], leaf, *others[place:]])
    return leaf


def ways(rows: list[list[str]], place: int, fan: int) -> list[tuple[int, list[str]]]:
    """The way of one bottom node of a superblock to its top."""
    out = []
    for row in rows[:-1]:
        start = place // fan * fan
        out.append((place - start, [*row[start:place], *row[place + 1:start + fan]]))
        place //= fan
    return out


def part(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _tree(lang: Column) -> Column:
    """A tree's key, which sorts as languages do: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("+"), lang.cast("string")), F.lit(""))


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` (with ``tree``) with ``rank``, their place in their tree by ``order``, and ``n``, the tree's size.

    Rows are sorted by ranges over all tasks, so a tree may hold any share of them; what a window sums
    up is a row for each tree and range.
    """
    keys = ["tree", *order]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    placed = stash(placed, "merkle")
    own = Window.partitionBy("tree")
    starts = placed.groupBy("tree", "part").agg(F.count("*").alias("rows"), F.min("at").alias("first")).select(
        "tree", "part", (F.sum("rows").over(own.orderBy("part")) - F.col("rows") - F.col("first")).alias("base"), F.sum("rows").over(own).alias("n"))
    return placed.join(starts, ["tree", "part"]).withColumn("rank", F.col("at") + F.col("base")).drop("part", "at", "base")


def _passes(nodes: DataFrame, fan: int, height: int) -> int:
    """Superblocks above each other that the largest tree needs."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    return -(-heights(most, fan) // height)


def _block(rank: Column, fan: int, height: int) -> Column:
    return F.floor(rank / F.lit(fan ** height)).cast("bigint").alias("block")


def _up(nodes: DataFrame, fan: int, height: int) -> DataFrame:
    """The top node of each superblock, numbered as nodes of the next pass; a tree of one node stays as it is."""
    def reduce(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        n = int(block["n"].iloc[0])
        rows = climb(block.sort_values("rank")["digest"], min(height, heights(n, fan)), fan)
        return pd.DataFrame({"tree": [key[0]], "rank": [key[1]], "n": [-(-n // fan ** height)], "digest": [rows[-1][0]]})

    keyed = nodes.select("tree", "rank", "n", "digest", _block(F.col("rank"), fan, height))
    return keyed.groupBy("tree", "block").applyInPandas(reduce, _NODE)


def _outer_ways(outer: pd.DataFrame) -> list[tuple[int, list[str]]]:
    """The way above a superblock from its outer nodes."""
    out = []
    for _, level in outer[outer["kind"].isin(["own", "sibling"])].groupby("level", sort=True):
        out.append((int(level["place"][level["kind"] == "own"].iloc[0]), level[level["kind"] == "sibling"].sort_values("place")["digest"].tolist()))
    return out


def _down(nodes: DataFrame, outer: DataFrame, level: int, fan: int, height: int) -> DataFrame:
    """The outer nodes of each node of a pass, which is a superblock of the pass below.

    ``level`` is that of the pass's nodes.
    """
    def hand(key: tuple, block: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("rank")
        rows = climb(block["digest"], min(height, heights(int(block["n"].iloc[0]), fan)), fan)
        above = list(around[["level", "kind", "place", "digest"]].itertuples(index=False, name=None))
        out = []
        for k, rank in enumerate(block["rank"]):
            for step, (place, others) in enumerate(ways(rows, k, fan)):
                at = level + step
                out.append((key[0], rank, at, "own", place, None))
                out += [(key[0], rank, at, "sibling", i + (i >= place), x) for i, x in enumerate(others)]
            out += [(key[0], rank, *x) for x in above]
        return pd.DataFrame(out, columns=["tree", "block", "level", "kind", "place", "digest"])

    keyed = nodes.select("tree", "rank", "n", "digest", _block(F.col("rank"), fan, height))
    return keyed.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(hand, _OUTER)


def _outer(nodes: DataFrame, tops: DataFrame, level: int, fan: int, height: int, passes: list[DataFrame]) -> DataFrame:
    """The outer nodes of the superblocks of ``nodes``, from those of the whole trees."""
    outer = tops
    for k in range(len(passes) - 1, 0, -1):
        outer = stash(_down(passes[k - 1], outer, level + k * height, fan, height), "merkle")
    return outer


def _climbed(nodes: DataFrame, fan: int, height: int) -> list[DataFrame]:
    """The nodes of each pass above ``nodes``; those of the last are the roots."""
    above, count = [], max(_passes(nodes, fan, height), 1)
    for _ in range(count):
        above.append(stash(_up(above[-1] if above else nodes, fan, height), "merkle"))
    return above


def _over_languages(roots: DataFrame, fan: int, height: int) -> DataFrame:
    """The outer nodes of each whole tree: its way among the roots of all trees, its own root and the root of all."""
    nodes = ranked(roots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest"), "of")
    nodes = stash(nodes, "merkle")
    passes = _climbed(nodes, fan, height)
    root = passes[-1].select("tree", F.lit(0).cast("bigint").alias("block"), F.lit(2 * OVER).alias("level"), F.lit("root").alias("kind"), F.lit(0).alias("place"), "digest")
    outer = _outer(nodes, root, OVER, fan, height, passes)
    found = _down(nodes, outer, OVER, fan, height).withColumnRenamed("block", "rank").drop("tree")
    named = nodes.select("rank", F.col("of").alias("tree"), F.col("digest").alias("own"))
    known = found.join(named, "rank").select("tree", F.lit(0).cast("bigint").alias("block"), "level", "kind", "place", "digest")
    own = named.select("tree", F.lit(0).cast("bigint").alias("block"), F.lit(2 * OVER).alias("level"), F.lit("subroot").alias("kind"), F.lit(0).alias("place"), F.col("own").alias("digest"))
    return stash(known.union(own), "merkle")


def manifest(leaves: DataFrame, fan: int = FAN, height: int = HEIGHT) -> DataFrame:
    """``id, leaf, shown, subroot, root, proof, folded_root, verified`` for every row of ``leaves`` (``tree, id, leaf, shown``).

    ``leaf`` is a row's digest, ``shown`` the digest of the row as it is shown to whoever verifies it (null:
    the same). Leaves of a tree go by id (nulls first), those with the same id by digest, so rows that are equal
    in all have neighbouring places and no order matters among them. While a tree has several nodes, each
    ``fan`` neighbouring ones become the digest of their hex digests. ``proof`` is the list of the siblings from
    the leaf to the root, left to right; ``folded_root`` comes from ``shown``, places and siblings.
    No rows give no rows.
    """
    # Written with a number for each row first: equal rows then may be split over ranges, the same way at each try.
    nodes = stash(leaves.select("tree", "id", "leaf", "shown", F.monotonically_increasing_id().alias("row")), "merkle")
    nodes = stash(ranked(nodes, "id", "leaf", "row").drop("row").withColumnRenamed("leaf", "digest"), "merkle")
    passes = _climbed(nodes, fan, height)
    outer = _outer(nodes, _over_languages(passes[-1], fan, height), 0, fan, height, passes)

    def finish(key: tuple, block: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("rank")
        rows = climb(block["digest"], min(height, heights(int(block["n"].iloc[0]), fan)), fan)
        above = _outer_ways(around)
        subroot, root = (around["digest"][around["kind"] == k].iloc[0] for k in ("subroot", "root"))
        shown = block["shown"].where(block["shown"].notna(), block["digest"])
        every = [[*ways(rows, k, fan), *above] for k in range(len(block))]
        folded = [fold(leaf, way) for leaf, way in zip(shown, every)]
        return pd.DataFrame({
            "id": block["id"], "leaf": block["digest"], "shown": shown, "subroot": subroot, "root": root,
            "proof": [[x for _, others in way for x in others] for way in every], "folded_root": folded, "verified": [f == root for f in folded],
        })

    # Ids travel as text: beside a null, pandas would make whole numbers floats.
    keyed = nodes.select("tree", "rank", "n", "digest", "shown", F.col("id").cast("string").alias("id"), _block(F.col("rank"), fan, height))
    made = keyed.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(
        finish, "id string, leaf string, shown string, subroot string, root string, proof array<string>, folded_root string, verified boolean")
    return made.withColumn("id", F.col("id").cast(leaves.schema["id"].dataType))


def leaves_of(docs: DataFrame, columns: Sequence[str], shown: dict[str, Column] | None = None,
              id_column: str = "doc_id", tree_column: str = "lang") -> DataFrame:
    """``tree, id, leaf, shown`` of each row: the digest over ``columns``, and over them with those of ``shown`` in their place.

    A null is told from an empty text. A row that is shown as it is has a null there. Texts of any
    length are hashed whole where they lie; columns that aren't named don't matter.
    """
    own = lambda named: F.sha2(F.concat(*(part(named.get(c, F.col(f"`{c}`"))) for c in columns)), 256)
    changed = F.lit(False)
    for name, value in (shown or {}).items():
        changed = changed | ~value.eqNullSafe(F.col(f"`{name}`"))
    return docs.select(
        _tree(F.col(f"`{tree_column}`")).alias("tree"), F.col(f"`{id_column}`").alias("id"), own({}).alias("leaf"),
        (F.when(changed, own(shown)) if shown else F.lit(None).cast("string")).alias("shown"))
