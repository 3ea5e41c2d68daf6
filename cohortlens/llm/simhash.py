"""SimHash near-duplicate groups, verified with pivot distance tables.

Distinct fingerprints are dealt by pigeonhole keys: two fingerprints within ``max_bits`` agree on
one of ``max_bits + 1`` bit bands, so no link is lost. A key with more than ``split_over``
fingerprints is dealt again by the bands of its remaining bits, which holds by the same argument.
Within a key, each fingerprint has a row in a pivot table: its Hamming distances to reference
fingerprints. By the triangle inequality a pair whose rows differ by more than ``max_bits`` in any
coordinate cannot link; only the survivors are compared bit by bit. Small keys are compared in one
vectorised sweep; in large ones a search removes each fingerprint from the open set as soon as it
is reached and gives a spanning forest, never the pairs. Components of the links are found by star
contraction. A fingerprint held by a third of all documents is one row in all of this.

Defined cases: a null or empty text has fingerprint zero, linked like any other. Repeated rows are
the same document. A row with a null doc_id takes part in links; a component of such rows alone has
component_id null. Extra columns are not read by the grouping. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import cut
from cohortlens.llm.components import components

SEED = 42
#: Reference fingerprints: the XXH64 of the first numbers.
PIVOTS = np.array([xxhash.xxh64_intdigest(str(i), seed=SEED) for i in range(24)], dtype=np.uint64)
SWEEP = 24  # keys up to this size are compared in a sweep


def fingerprint(text: str, shingle: int = 3) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # on bytes: A-Z and ASCII white space only
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, dtype=np.int64)
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    for at in range(0, len(first), 65536):
        h = np.array([digest(flat[a:b], SEED) for a, b in zip(first[at:at + 65536], last[at:at + 65536])], dtype="<u8")
        total += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int32)
    bits = (2 * total > len(first)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id") -> DataFrame:
    """(id, fp): the 64-bit fingerprint of every whole text, as a signed long."""
    kind = dict(docs.dtypes)[id_col]

    def shape(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            fps = np.array([fingerprint(t.as_py() or "", shingle) for t in part["text"]], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part[id_col], pa.array(fps, pa.int64())], names=[id_col, "fp"])

    return docs.select(id_col, "text").mapInArrow(shape, f"`{id_col}` {kind}, fp long")


def _bands(bits: int, parts: int) -> list[tuple[int, int]]:
    """(offset, width) of ``parts`` near-equal bands over ``bits`` bits."""
    cuts = [bits * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _band(value: Column, offset: int, width: int) -> Column:
    return F.shiftrightunsigned(value, offset).bitwiseAND(F.lit((1 << width) - 1))


def _rotated(value: Column, by: int) -> Column:
    return value if by % 64 == 0 else F.shiftrightunsigned(value, by % 64).bitwiseOR(F.shiftleft(value, 64 - by % 64))


def _near(fps: np.ndarray, table: np.ndarray, one: np.ndarray, other: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs of positions link: pivot coordinates first, then the bits of the survivors."""
    keep = np.arange(len(one))
    for c in range(table.shape[1]):
        keep = keep[np.abs(table[one[keep], c] - table[other[keep], c]) <= max_bits]
        if not len(keep):
            return keep
    return keep[np.bitwise_count(fps[one[keep]] ^ fps[other[keep]]) <= max_bits]


def key_links(fps: np.ndarray, keys: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by key: all of them in small keys, a spanning forest in large ones."""
    table = np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.int16)
    edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.array([], dtype=np.int64)
    sizes = np.diff(np.append(edge, len(keys)))
    left, right = [], []
    small = np.repeat(sizes <= SWEEP, sizes)
    for step in range(1, min(SWEEP, int(sizes.max(initial=0)))):
        one = np.flatnonzero(small[:-step] & (keys[step:] == keys[:-step]))
        if not len(one):
            break
        hit = _near(fps, table, one, one + step, max_bits)
        left.append(one[hit])
        right.append(one[hit] + step)
    for start, size in zip(edge[sizes > SWEEP].tolist(), sizes[sizes > SWEEP].tolist()):
        # sorted by the first coordinate, only a window of it can hold neighbours
        rows = start + np.argsort(table[start:start + size, 0], kind="stable")
        first = table[rows, 0]
        open_ = np.ones(size, dtype=bool)
        for seed in range(size):
            if not open_[seed]:
                continue
            open_[seed], front = False, [seed]
            while front:
                at = front.pop()
                lo, hi = np.searchsorted(first, [first[at] - max_bits, first[at] + max_bits + 1])
                near = lo + np.flatnonzero(open_[lo:hi])
                if not len(near):
                    continue
                near = near[_near(fps, table, np.full(len(near), rows[at]), rows[near], max_bits)]
                open_[near] = False
                left.append(np.full(len(near), rows[at]))
                right.append(rows[near])
                front.extend(near.tolist())
    if not left:
        return np.array([], dtype=np.int64), np.array([], dtype=np.int64)
    return np.concatenate(left), np.concatenate(right)


def _links_of_keys(keyed: DataFrame, max_bits: int) -> DataFrame:
    """Links (u, v) of fingerprints that share a key; keys are read in sorted runs."""

    def shape(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.array([], dtype=np.int64), np.array([], dtype=np.int64)

        def links(k, f):
            a, b = key_links(f.view(np.uint64), k, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(f[a], pa.int64()), pa.array(f[b], pa.int64())], names=["u", "v"])

        for part in parts:
            keys = np.concatenate((keys, part["key"].to_numpy()))
            fps = np.concatenate((fps, part["fp"].to_numpy()))
            if len(keys) and keys[0] != keys[-1]:  # the last key may go on in the next batch
                whole = int(np.searchsorted(keys, keys[-1]))
                yield links(keys[:whole], fps[:whole])
                keys, fps = keys[whole:], fps[whole:]
        if len(keys):
            yield links(keys, fps)

    return keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(shape, "u long, v long")


def fingerprint_links(distinct: DataFrame, max_bits: int = 3, split_over: int = 4096) -> DataFrame:
    """Links (u, v) that connect all fingerprints within ``max_bits`` of each other; ``distinct``
    has one row for each ``fp``."""
    bands = _bands(64, max_bits + 1)
    keys = F.array(*[F.struct(F.lit(i).alias("band"), (_band(F.col("fp"), o, w) + F.lit(i << w)).alias("key"))
                     for i, (o, w) in enumerate(bands)])
    first = distinct.select("fp", F.explode(keys).alias("k")).select("fp", "k.band", "k.key")
    # at most (max_bits + 1) * 2^16 keys have a count, whatever the number of rows
    large = first.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > split_over)
    sized = first.join(large, ["band", "key"], "left")
    links = _links_of_keys(sized.where("n is null").select("key", "fp"), max_bits)
    if large.isEmpty():
        return links
    rest = F.lit(None)
    for i, (o, w) in enumerate(bands):
        rest = F.when(F.col("band") == i, _rotated(F.col("fp"), o + w)).otherwise(rest)
    width = 64 - max(w for _, w in bands)
    subs = [F.xxhash64("band", "key", F.lit(j), _band(F.col("rest"), o, w)) for j, (o, w) in enumerate(_bands(width, max_bits + 1))]
    again = (sized.where("n is not null").withColumn("rest", rest)
             .select("fp", F.explode(F.array(*subs)).alias("key")))
    return links.union(_links_of_keys(again.select("key", "fp"), max_bits))


def near_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without text, plus fingerprint (16 hex digits) and component_id (the smallest id
    reachable over links of at most ``max_bits`` differing bits)."""
    held = cut(fingerprints(docs, shingle, id_col))
    distinct = cut(held.groupBy("fp").agg(F.min(id_col).alias("rep")))
    label = components(fingerprint_links(distinct, max_bits).select("u", "v"))
    labelled = distinct.join(label.select(F.col("u").alias("fp"), F.col("v").alias("label")), "fp", "left") \
        .withColumn("label", F.coalesce("label", "fp"))
    lowest = cut(labelled.groupBy("label").agg(F.min("rep").alias("component_id")))  # joins back can then be split
    of_fp = labelled.join(lowest, "label").select("fp", "component_id")
    return held.join(of_fp, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with the document of the smallest id of each group; rows without an id stay."""
    gone = near_groups(docs, shingle, max_bits, id_col).where(F.col(id_col) != F.col("component_id")).select(id_col)
    return docs.join(gone, id_col, "left_anti")
