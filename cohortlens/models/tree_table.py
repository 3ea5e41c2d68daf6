"""The boosted ensemble as a table of nodes (ML5), scored by native expressions (ML8) and explained in Arrow batches (XP5).

``model_table`` writes a fitted ensemble out as plain rows, one a node: the slot and threshold it asks for and
where both answers lead, or a leaf's share of the margin. :func:`score_by_table` walks the trees inside each
row with array functions: the nodes are constants of the plan (at most 2 ** (depth + 1) - 1 a tree, so
bounded by the parameters of the fit), and no row is multiplied or moved. :func:`explained` needs every tree once
more for each slot it asks for; it asks all nodes of a tree for a chunk of rows at once (Arrow batches, :class:`LeafMasks`),
and a row's tree without a slot is what the other slots leave of its leaves.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.session import ensure_checkpoint_dir

CHUNK = 4096  # rows that one tree is asked for at a time: some MB of arrays
SCHEMA = "tree int, node int, slot int, threshold double, low int, high int, value double"


def model_table(model: GBTClassificationModel) -> DataFrame:
    """One row a node: a split has slot, threshold and the nodes for values up to it (``low``) and over it
    (``high``), a leaf has ``value``, its prediction times the tree's weight."""
    spark = SparkSession.getActiveSession()
    path = os.path.join(ensure_checkpoint_dir(spark), "models", uuid.uuid4().hex)
    model.write().save(path)
    weight = F.get(F.array(*[F.lit(float(w)) for w in model.treeWeights]), F.col("treeID"))
    split = F.col("nodeData.split")
    leaf = F.col("nodeData.leftChild") < 0
    at = F.when(split["numCategories"] >= 0, F.raise_error(F.lit("a split by categories has no threshold")).cast("double")).otherwise(
        F.get(split["leftCategoriesOrThreshold"], 0))
    return spark.read.parquet(os.path.join(path, "data")).select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"), F.when(~leaf, split["featureIndex"]).alias("slot"),
        F.when(~leaf, at).alias("threshold"), F.when(~leaf, F.col("nodeData.leftChild")).alias("low"),
        F.when(~leaf, F.col("nodeData.rightChild")).alias("high"), F.when(leaf, F.col("nodeData.prediction") * weight).alias("value"))


def _constant(values: list, kind: str) -> Column:
    """A constant array; the optimizer folds the text into it once a plan."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def _nodes(table: DataFrame) -> list:
    """The nodes of one model by tree and node: bounded by its parameters."""
    return sorted(table.collect(), key=lambda r: (r["tree"], r["node"]))


class Walks:
    """The trees of a node table as expressions over ``x``, an array column of the slots' values."""

    def __init__(self, table: DataFrame, x: str):
        rows = _nodes(table)
        place = {(r["tree"], r["node"]): i for i, r in enumerate(rows)}
        children = [tuple(None if r[c] is None else place[r["tree"], r[c]] for c in ("low", "high")) for r in rows]
        levels = {place[t, n]: 0 for t, n in place if n == 0}
        self.roots, self.x = _constant(sorted(levels), "int"), x
        todo = list(levels)
        for at in todo:  # breadth first: the list grows while it is read
            for child in children[at]:
                if child is not None:
                    levels[child] = levels[at] + 1
                    todo.append(child)
        self.steps = F.array(*[F.lit(i) for i in range(max(levels.values(), default=0))])
        self.slot = _constant([-1 if r["slot"] is None else r["slot"] for r in rows], "int")
        self.threshold = _constant([r["threshold"] or 0.0 for r in rows], "double")
        self.low, self.high = (_constant([-1 if c[i] is None else c[i] for c in children], "int") for i in (0, 1))
        self.value = _constant([r["value"] or 0.0 for r in rows], "double")

    def _next(self, at: Column) -> Column:
        slot = F.get(self.slot, at)
        value = F.get(F.col(self.x), slot)
        return F.when(slot < 0, at).when(value <= F.get(self.threshold, at), F.get(self.low, at)).otherwise(F.get(self.high, at))

    def leaves(self) -> Column:
        """Each tree's leaf."""
        return F.transform(self.roots, lambda root: F.aggregate(self.steps, root, lambda at, _: self._next(at)))

    def share(self, leaf: Column) -> Column:
        return F.get(self.value, leaf)


class LeafMasks:
    """One tree, asked for many rows at once. Its leaves are numbered from the low side on, a bit each, in as many words as
    they need. A node that sends a row to its high side takes away the leaves below its low side, and the first leaf
    that is left is the row's (nodes off its path take away only later ones, or those that are gone). So a slot is
    the leaves that its nodes leave, and the tree without it what the other slots and that slot at zero leave."""

    def __init__(self, nodes: list):
        found = {r["node"]: r for r in nodes}
        splits, values = [], []  # a split: (slot, threshold, first and last + 1 of the leaves below its low side)
        todo = [(0, None)]
        while todo:  # the low side first: a split's own leaves from ``begin`` on
            at, begin = todo.pop()
            row = found[at]
            if begin is not None:
                splits.append((row["slot"], row["threshold"], begin, len(values)))
            elif row["slot"] is None:
                values.append(row["value"])
            else:
                todo += [(row["high"], None), (at, len(values)), (row["low"], None)]
        splits.sort(key=lambda s: s[0])
        word = np.uint32 if len(values) <= 32 else np.uint64
        bits = 8 * word().itemsize
        self.all, self.values = ~word(0), np.array(values)
        self.asked, self.thresholds = np.array([s[0] for s in splits], np.int64), np.array([s[1] for s in splits], float)
        self.slots, begins = np.unique(self.asked, return_index=True)
        self.spans = list(zip(begins, [*begins[1:], len(splits)]))
        gone = [sum(1 << leaf for leaf in range(*s[2:])) for s in splits]
        full = (1 << bits) - 1
        #: what a split leaves of each word when it sends a row to its high side
        self.left = [np.array([full & ~(g >> bits * w) for g in gone], word) for w in range(-(-len(values) // bits))]
        zero_high = ~(0.0 <= self.thresholds)
        self.left_at_zero = [np.array([np.bitwise_and.reduce(left[a:b][zero_high[a:b]], initial=self.all) for a, b in self.spans], word) for left in self.left]

    def _leaf(self, words: list[np.ndarray]) -> np.ndarray:
        """The first bit that is set: as many zeros are before it."""
        bits, at = 8 * self.all.itemsize, None
        for w in range(len(words) - 1, -1, -1):
            first = np.bitwise_count((words[w] - 1) & ~words[w]).astype(np.int64) + bits * w
            at = first if at is None else np.where(words[w] != 0, first, at)
        return at

    def shares(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tree's share of each row's margin, and by how much it falls with each of ``slots`` at zero. ``x``: slots by rows."""
        low = x[self.asked] <= self.thresholds[:, None]
        whole, others = [], []
        for left, left_at_zero in zip(self.left, self.left_at_zero):
            kept = np.where(low, self.all, left[:, None])
            by_slot = [np.bitwise_and.reduce(kept[a:b], axis=0) if b - a > 1 else kept[a] for a, b in self.spans]
            other, so_far = np.empty((len(by_slot), x.shape[1]), left.dtype), np.full(x.shape[1], self.all)
            for i, own in enumerate(by_slot):  # what the slots before leave
                other[i] = so_far
                so_far = so_far & own
            whole.append(so_far)
            so_far = np.full(x.shape[1], self.all)
            for i in range(len(by_slot) - 1, -1, -1):  # and those after
                other[i] &= so_far
                so_far = so_far & by_slot[i]
            others.append(other & left_at_zero[:, None])
        share = self.values[self._leaf(whole)]
        return share, share - self.values[self._leaf(others)]


def _margins(trees: list[LeafMasks], x: np.ndarray, known: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The rows' margins and by how much they fall with each slot at zero (slots by rows), both added up tree by tree.
    A slot that is not ``known`` goes to the side of larger values and is never set to zero."""
    margin, falls = np.zeros(x.shape[1]), np.zeros(x.shape)
    for tree in trees:
        share, fall = tree.shares(x)
        margin += share
        falls[tree.slots] += fall if known is None else np.where(known[tree.slots], fall, 0.0)
    return margin, falls


def _slots_by_rows(lists: pa.ListArray, width: int) -> tuple[np.ndarray, np.ndarray | None]:
    """Each row's first ``width`` slots as a column, and which are there (none: all)."""
    values = lists.flatten()
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    if not values.null_count and len(sizes) and sizes.min() == sizes.max() >= width:
        return np.ascontiguousarray(values.to_numpy().reshape(len(sizes), -1)[:, :width].T), None
    x, known = np.full((width, len(sizes)), np.nan), np.zeros((width, len(sizes)), bool)
    row = np.repeat(np.arange(len(sizes)), sizes)
    slot = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    there = (slot < width) & values.is_valid().to_numpy(zero_copy_only=False)
    x[slot[there], row[there]] = values.to_numpy(zero_copy_only=False)[there]
    known[slot[there], row[there]] = True
    return x, known


def _probability(margin: Column) -> Column:
    return 1 / (1 + F.exp(-2 * margin))


def explained(df: DataFrame, table: DataFrame, x: str, keep: list[str] | None = None) -> DataFrame:
    """(keep..., prob, slots): the probability of class 1 and, for every slot whose zeroing changes the margin,
    by how much the probability falls (array of struct<c double, pos int>). No row is exploded or moved."""
    keep = keep or ["user_id"]
    by_tree: dict[int, list] = {}
    for node in _nodes(table):
        by_tree.setdefault(node["tree"], []).append(node)
    trees = [LeafMasks(nodes) for nodes in by_tree.values()]
    width = max((int(tree.slots[-1]) + 1 for tree in trees if len(tree.slots)), default=0)
    change = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("change", T.DoubleType())])
    rows = df.select(*keep, F.col(x).cast("array<double>").alias("_x"))

    def shape(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in (whole.slice(at, CHUNK) for at in range(0, whole.num_rows, CHUNK)):
                margin, falls = _margins(trees, *_slots_by_rows(part["_x"], width))
                row, pos = np.nonzero(falls.T)
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=part.num_rows))])
                changes = pa.StructArray.from_arrays([pa.array(pos, pa.int32()), pa.array(falls[pos, row])], names=["pos", "change"])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(margin), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), changes)],
                                                 names=[*part.schema.names[:-1], "_margin", "_changes"])

    found = rows.mapInArrow(shape, T.StructType([*rows.schema.fields[:-1], T.StructField("_margin", T.DoubleType()), T.StructField("_changes", T.ArrayType(change))]))
    slots = F.transform("_changes", lambda c: F.struct(
        (_probability(F.col("_margin")) - _probability(F.col("_margin") - c["change"])).alias("c"), c["pos"].alias("pos")))
    return found.select(*keep, _probability(F.col("_margin")).alias("prob"), slots.alias("slots"))


def score_by_table(df: DataFrame, table: DataFrame, x: str, keep: list[str] | None = None) -> DataFrame:
    """ML8 from the table: the probability of class 1 as ``prob``."""
    keep = keep or ["user_id"]
    walks = Walks(table, x)
    margin = F.aggregate(F.transform(walks.leaves(), walks.share), F.lit(0.0), lambda s, v: s + v)
    return df.select(*keep, _probability(margin).alias("prob"))
