"""Merkle manifest of a dataset, with proofs and folds of single leaves.

Leaves are ordered within their group, every ``fanout`` consecutive nodes are hashed into
a parent until one is left, the group's subroot; the subroots are joined likewise.

1. One range sort numbers the leaves of all groups; a group of any size is spread.
2. Trees are built in blocks of ``fanout ** LEVELS`` consecutive nodes, one layer of blocks
   after the other, so a task holds one block.
3. On the way down every block is given the siblings above it, and its leaves get theirs.
4. A parent retains a copy of its hash state before each child slot. A fold takes the state
   before the replaced child's slot, adds the replacement and the siblings to its right,
   and goes on so to the root; what lies to the left is not hashed again.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from basketlens.shipping import map_batches
from basketlens.staging import stage

#: Tree levels that a task builds at a time.
LEVELS = 12

#: Siblings of a node to the left and to the right, level by level upwards.
PATH = "array<struct<left: array<string>, right: array<string>>>"
_PATH = pa.list_(pa.struct([("left", pa.list_(pa.string())), ("right", pa.list_(pa.string()))]))
_PATHS = f"tree string, pos long, path {PATH}, subroot string, root string"
_TEXT = pa.string()


def leaf_digest(*columns: Column) -> Column:
    """Lower-case hex SHA-256 of the values: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    parts = []
    for c in columns:
        text = c.cast("string")
        parts.append(F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def levels_of(n: int, fanout: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    found = 0
    while fanout**found < n:
        found += 1
    return found


class MidstateTree:
    """``levels`` levels above consecutive nodes; ``states[level][parent][slot]`` is the parent's hash before that child.

    ``above`` holds the (left, right) siblings of this tree's top, level by level.
    """

    def __init__(self, digests: list[str], fanout: int, levels: int, above: list[dict] = ()):
        self.fanout, self.rows, self.states = fanout, [digests], []
        for _ in range(levels):
            parents, kept = [], []
            for run in self._runs(self.rows[-1]):
                state, slots = sha256(), []
                for child in run:
                    slots.append(state.copy())
                    state.update(child.encode())
                kept.append(slots)
                parents.append(state.hexdigest())
            self.states.append(kept)
            self.rows.append(parents)
        self.top = self.rows[-1][0] if self.rows[-1] else None
        self.above = [(sha256("".join(x["left"]).encode()), "".join(x["right"]).encode()) for x in above]

    def _runs(self, nodes: list[str]) -> Iterator[list[str]]:
        return (nodes[k : k + self.fanout] for k in range(0, len(nodes), self.fanout))

    def path(self, place: int) -> list[dict]:
        """The siblings of the node at ``place``, up to this tree's top."""
        found = []
        for nodes in self.rows[:-1]:
            first = place - place % self.fanout
            found.append({"left": nodes[first:place], "right": nodes[place + 1 : first + self.fanout]})
            place //= self.fanout
        return found

    def fold(self, place: int, digest: str) -> str:
        """The root with ``digest`` at ``place``: states are resumed, left siblings not read."""
        for nodes, states in zip(self.rows, self.states):
            parent, slot = divmod(place, self.fanout)
            state = states[parent][slot].copy()
            state.update(digest.encode())
            for right in nodes[place + 1 : (parent + 1) * self.fanout]:
                state.update(right.encode())
            digest, place = state.hexdigest(), parent
        for before, right in self.above:
            state = before.copy()
            state.update(digest.encode())
            state.update(right)
            digest = state.hexdigest()
        return digest


def _blocks(batches) -> Iterator[list[dict]]:
    """The rows of every block; they come sorted by (tree, block, pos)."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["tree"], row["block"]) != key:
                if rows:
                    yield rows
                key, rows = (row["tree"], row["block"]), []
            rows.append(row)
    if rows:
        yield rows


def _climb(fanout: int, levels: int):
    def run(batches):
        for rows in _blocks(batches):
            n = rows[0]["n"]
            up = min(levels, levels_of(n, fanout))
            tree = MidstateTree([r["digest"] for r in rows], fanout, up)
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[0]["tree"]], _TEXT), pa.array([rows[0]["block"]], pa.int64()), pa.array([-(-n // fanout**levels)], pa.int64()), pa.array([tree.top], _TEXT)],
                names=["tree", "pos", "n", "digest"],
            )

    return run


def _tree_of(rows: list[dict], fanout: int, levels: int) -> tuple[dict, list[dict], MidstateTree]:
    """(row with the path of the block, the block's nodes, their tree)."""
    over, nodes = rows[0], rows[1:]
    up = min(levels, levels_of(nodes[0]["n"], fanout))
    return over, nodes, MidstateTree([r["digest"] for r in nodes], fanout, up, over["path"])


def _descend(fanout: int, levels: int):
    def run(batches):
        for rows in _blocks(batches):
            over, nodes, tree = _tree_of(rows, fanout, levels)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["tree"] for r in nodes], _TEXT),
                    pa.array([r["pos"] for r in nodes], pa.int64()),
                    pa.array([tree.path(k) + over["path"] for k in range(len(nodes))], _PATH),
                    pa.array([over["subroot"]] * len(nodes), _TEXT),
                    pa.array([over["root"]] * len(nodes), _TEXT),
                ],
                names=["tree", "pos", "path", "subroot", "root"],
            )

    return run


def _prove(fanout: int, levels: int):
    def run(batches):
        for rows in _blocks(batches):
            over, nodes, tree = _tree_of(rows, fanout, levels)
            shared = [s for x in over["path"] for s in (*x["left"], *x["right"])]
            siblings = [[s for x in tree.path(k) for s in (*x["left"], *x["right"])] + shared for k in range(len(nodes))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["id"] for r in nodes], pa.int64()),
                    pa.array([r["digest"] for r in nodes], _TEXT),
                    pa.array([over["subroot"]] * len(nodes), _TEXT),
                    pa.array([over["root"]] * len(nodes), _TEXT),
                    pa.array(siblings, pa.list_(_TEXT)),
                    pa.array([tree.fold(k, r["replacement"]) for k, r in enumerate(nodes)], _TEXT),
                ],
                names=["id", "leaf", "subroot", "root", "siblings", "folded_root"],
            )

    return run


def numbered(nodes: DataFrame, *order: str) -> DataFrame:
    """``nodes`` with ``pos``, their place in their ``tree`` by ``order``, and ``n``, the tree's size.

    Rows are sorted by ranges; a tree has one row of counts for each range that it lies in.
    """
    keys = ("tree", *order)
    ordered = nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("row", F.monotonically_increasing_id())
    ordered = stage(ordered, "merkle-order").withColumn("part", F.shiftright("row", 33))
    cuts = ordered.groupBy("tree", "part").agg(F.min("row").alias("first"), F.count("*").alias("own"))
    tree = Window.partitionBy("tree")
    before = F.sum("own").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    cuts = cuts.select("tree", "part", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("own").over(tree).alias("n"))
    placed = ordered.join(stage(cuts, "merkle-cuts"), ["tree", "part"])
    return placed.withColumn("pos", F.col("before") + F.col("row") - F.col("first")).drop("row", "part", "first", "before")


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def _block(fanout: int, levels: int) -> Column:
    return F.floor(F.col("pos") / F.lit(fanout**levels)).cast("long").alias("block")


def _layers(leaves: DataFrame, fanout: int, levels: int) -> list[DataFrame]:
    """Nodes (tree, pos, n, digest), layer after layer of blocks; the last has one node for each tree."""
    layers = [leaves]
    while True:
        rows = _dealt(layers[-1].select("tree", "pos", "n", "digest", _block(fanout, levels)))
        layers.append(stage(map_batches(rows, _climb(fanout, levels), "tree string, pos long, n long, digest string"), "merkle-nodes"))
        if (layers[-1].agg(F.max("n")).first()[0] or 1) == 1:
            return layers


def _with_paths(nodes: DataFrame, paths: DataFrame, fanout: int, levels: int) -> DataFrame:
    """A block's path stands before its nodes."""
    over = paths.select("tree", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), "path", "subroot", "root")
    return _dealt(nodes.withColumn("block", _block(fanout, levels)).unionByName(over, allowMissingColumns=True))


def _paths_below(layers: list[DataFrame], paths: DataFrame, fanout: int, levels: int) -> DataFrame:
    """The paths of a layer's blocks, from those of the top, for the lowest of ``layers``."""
    for nodes in reversed(layers):
        paths = stage(map_batches(_with_paths(nodes.select("tree", "pos", "n", "digest"), paths, fanout, levels), _descend(fanout, levels), _PATHS), "merkle-paths")
    return paths


def merkle_manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "lang",
    replaced: dict[str, Column] | None = None,
    fanout: int = 2,
    levels: int = LEVELS,
) -> DataFrame:
    """(id, leaf, subroot, root, siblings, folded_root) for every row of ``docs``.

    ``leaf`` is ``leaf_digest`` of the ``fields``. Groups are the values of ``group_col``, null a
    group of its own and the first, the others by their UTF-8 bytes. Within a group leaves ascend
    by id, nulls first, rows of one id by digest. While several nodes remain, every ``fanout``
    consecutive ones are hashed together (the last run may have fewer, even one); a lone leaf is
    its group's subroot, a lone subroot the root. ``siblings`` is the row's proof: the other nodes
    of its runs, from the leaf's level to the root's, left to right.

    ``replaced`` gives other values for some fields; ``folded_root`` is the root with this row's
    leaf taken from them and all other leaves as they are. It equals ``root`` exactly where no
    field of the row changes. Any field may be null; other columns are ignored; an empty table
    gives an empty result.
    """
    replaced = replaced or {}
    group = F.col(group_col).cast("string")
    leaves = docs.select(
        F.col(id_col).cast("long").alias("id"),
        # Keeps null first and the order of the bytes.
        F.when(group.isNull(), "").otherwise(F.concat(F.lit("+"), group)).alias("tree"),
        leaf_digest(*[F.col(c) for c in fields]).alias("digest"),
        leaf_digest(*[replaced.get(c, F.col(c)) for c in fields]).alias("replacement"),
    )
    leaves = stage(numbered(leaves, "id", "digest"), "merkle-leaves")
    layers = _layers(leaves, fanout, levels)
    subroots = layers[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    tops = stage(numbered(subroots, "name"), "merkle-subroots")
    top_layers = _layers(tops, fanout, levels)

    none = F.from_json(F.lit("[]"), PATH)
    roots = top_layers[-1].select("tree", "pos", none.alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    paths = _paths_below(top_layers[:-1], roots, fanout, levels).drop("tree", "subroot")
    paths = tops.select("pos", "name", "digest").join(paths, "pos").select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", F.col("digest").alias("subroot"), "root"
    )
    paths = _paths_below(layers[1:-1], paths, fanout, levels)
    schema = "id long, leaf string, subroot string, root string, siblings array<string>, folded_root string"
    return map_batches(_with_paths(leaves, paths, fanout, levels), _prove(fanout, levels), schema)
