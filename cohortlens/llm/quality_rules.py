"""Quality rules: base rules on text statistics, then an isolation forest on the statistics.

Statistics of all whole texts are computed once and written. The forest's trees split random
subsamples of the corpus (256 documents a tree, the method's own sample; ``trees`` x 256 rows come
to the driver, picked by a hash of the id) at random values, and a document's score is 2 to the
power of minus its mean path length over the usual one. The rows are the texts' ratios as they are
(a cut at random between a column's ends does not depend on its scale). One forest splits on all
ratios and gives the anomaly; one on each ratio gives that ratio's score, since the mean over all
ratios hides a document that is odd in one.

Thresholds are calibrated on all labelled documents, whose scores are counted in ``BINS`` bins by
label: the score and threshold are taken that reject most bad documents while they cost few good
ones (``max_loss`` of them in all), then the next among the documents left, until no bad one can be
had. A document is rejected that reaches the threshold of any score. No limit of a ratio is fixed.

Defined cases: a null or empty text has no words and fails the base rules. Repeated rows give
repeated rows. A document labelled more than once counts as bad if any of its labels says so; null
labels and labels without a document are not used. Without labels every document that passes the
base rules is kept. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import sampled, staged
from cohortlens.llm.text_stats import Stats, text_stats

SAMPLE = 256
DEPTH = 8
BINS = 2000


def statistics(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The id and the statistics of every whole text."""
    kind = dict(docs.dtypes)[id_col]

    def shape(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [text_stats(t.as_py() or "")[0] for t in part["text"]]
            columns = list(zip(*found)) or [()] * len(Stats._fields)
            yield pa.RecordBatch.from_arrays([part[id_col], *(pa.array(c, pa.int64()) for c in columns)], names=[id_col, *Stats._fields])

    return docs.select(id_col, "text").mapInArrow(shape, f"`{id_col}` {kind}, " + ", ".join(f"{f} long" for f in Stats._fields))


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """A text's ratios, which do not depend on its length: word length, symbols, repeated lines,
    words in repeated windows, capitals, digits, marks."""
    words, chars, lines = (np.maximum(s[k], 1) for k in ("n_words", "word_chars", "n_lines"))
    return np.column_stack([s["word_chars"] / words, s["n_symbols"] / chars, s["n_dup_lines"] / lines, s["n_repeat_words"] / words,
                            s["n_capitals"] / chars, s["n_digits"] / chars, s["n_marks"] / words])


def usual_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(safe - 1) + 0.5772156649) - 2 * (safe - 1) / safe, np.where(n == 2, 1.0, 0.0))


def fit_forest(rows: np.ndarray, trees: int, seed: int = 7) -> list[tuple[np.ndarray, ...]]:
    """Trees as arrays (column, value, left child; -1 for leaves, path length at leaves)."""
    rng, forest = np.random.default_rng(seed), []
    for _ in range(trees if len(rows) else 0):
        column, value, child, path = [-1], [0.0], [-1], [0.0]
        todo = [(0, rows[rng.permutation(len(rows))[:SAMPLE]], 0)]
        while todo:
            node, part, depth = todo.pop()
            low, high = part.min(axis=0), part.max(axis=0)
            wide = np.flatnonzero(high > low)
            if depth == DEPTH or len(part) < 2 or not len(wide):
                path[node] = depth + float(usual_path(len(part)))
                continue
            c = rng.choice(wide)
            cut = rng.uniform(low[c], high[c])
            column[node], value[node], child[node] = int(c), float(cut), len(column)
            for side in (part[part[:, c] <= cut], part[part[:, c] > cut]):
                todo.append((len(column), side, depth + 1))
                column.append(-1), value.append(0.0), child.append(-1), path.append(0.0)
        forest.append((np.array(column), np.array(value), np.array(child), np.array(path)))
    return forest


def anomaly(rows: np.ndarray, forest: list[tuple[np.ndarray, ...]], sample: int = SAMPLE) -> np.ndarray:
    """Score in 0 to 1; the shorter the mean path to isolation, the higher."""
    if not forest:
        return np.zeros(len(rows))
    total = np.zeros(len(rows))
    for column, value, child, path in forest:
        at = np.zeros(len(rows), dtype=np.int64)
        for _ in range(DEPTH):
            inner = np.flatnonzero(child[at] >= 0)
            if not len(inner):
                break
            node = at[inner]
            at[inner] = child[node] + (rows[inner, column[node]] > value[node])
        total += path[at]
    return 2.0 ** (-total / len(forest) / max(float(usual_path(sample)), 1e-9))


def fit_forests(rows: np.ndarray, trees: int) -> list[tuple[np.ndarray, list]]:
    """(columns, forest): ``trees`` trees on all columns, then as many in all on single columns."""
    columns = [np.arange(rows.shape[1]), *np.arange(rows.shape[1])[:, None]]
    return [(c, fit_forest(rows[:, c], trees if len(c) > 1 else -(-trees // rows.shape[1]), 7 + i)) for i, c in enumerate(columns)]


def scores_of(rows: np.ndarray, forests: list[tuple[np.ndarray, list]], sample: int) -> np.ndarray:
    """One score a forest."""
    return np.column_stack([anomaly(rows[:, c], forest, sample) for c, forest in forests])


def calibrate(labelled: DataFrame, n_scores: int, max_loss: float) -> list[float]:
    """The threshold of each score; 2 for one that rejects nothing. ``labelled``: _quality, scores.
    Each round is one aggregate of at most 2 x scores x bins rows."""
    limits, good = [2.0] * n_scores, None
    for _ in range(n_scores):
        left = labelled.where(reduce(lambda x, y: x & y, [F.col("scores")[i] < limit for i, limit in enumerate(limits)]))
        counts = (left.select("_quality", F.posexplode("scores").alias("score", "value"))
                  .groupBy("score", "_quality", F.floor(F.col("value") * BINS).cast("int").alias("bin")).count().collect())
        best = (0, 0.0)
        for i in range(n_scores):
            own = [(r["_quality"], r["bin"], r["count"]) for r in counts if r["score"] == i]
            rest = sum(n for label, _, n in own if label)
            good = rest if good is None else good
            limit = threshold(own, max(0.0, max_loss * good - (good - rest)) / max(rest, 1))
            edge = round(limit * BINS)
            caught = sum(n for label, at, n in own if not label and at >= edge)
            cost = sum(n for label, at, n in own if label and at >= edge)
            gap = edge - max((at for label, at, _ in own if label and at < edge), default=-1)
            if limits[i] > 1 and caught:
                best = max(best, (caught, -cost, gap, -i, limit))
        if not best[0]:
            break
        limits[-best[3]] = best[4]
    return limits


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", trees: int = 100, max_loss: float = 0.005) -> DataFrame:
    """The id, the statistics, base_failed, anomaly (null where base_failed) and kept."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)[id_col]
    stats = staged(statistics(docs, id_col)).withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    passed = stats.where(~F.col("base_failed"))
    share = min(1.0, trees * SAMPLE / max(1, passed.count()))
    sample = (passed.where(sampled(share, id_col, *Stats._fields)) if share < 1 else passed).select(*Stats._fields).toPandas()
    rows = features({k: sample[k].to_numpy() for k in Stats._fields})
    forests = fit_forests(rows[np.lexsort(rows.T)], trees)
    size = min(SAMPLE, len(rows))

    def shape(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = scores_of(features({k: part[k].to_numpy() for k in Stats._fields}), forests, size)
            failed = part["base_failed"].to_numpy(zero_copy_only=False)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel(), pa.float64()), len(forests)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found[:, 0], pa.float64(), mask=failed), lists],
                                             names=[*part.schema.names, "anomaly", "scores"])

    scored = stats.mapInArrow(shape, f"`{id_col}` {kind}, " + ", ".join(f"{f} long" for f in Stats._fields)
                              + ", base_failed boolean, anomaly double, scores array<double>")
    marks = labels.where("quality is not null").groupBy(F.col(id_col).alias("_id")).agg(F.min("quality").alias("_quality"))
    # labels grow with the documents, and their files are far smaller than their rows in memory: never a broadcast
    labelled = staged(scored.where("anomaly is not null").join(marks.hint("merge"), F.col(id_col) == F.col("_id")).select("_quality", "scores"))
    limits = calibrate(labelled, len(forests), max_loss)
    below = reduce(lambda x, y: x & y, [F.col("scores")[i] < limit for i, limit in enumerate(limits)])
    return scored.withColumn("kept", ~F.col("base_failed") & below).drop("scores")


def threshold(counts: list[tuple[int, int, int]], max_loss: float) -> float:
    """The middle of the bin edges that reject as many bad rows as any edge that costs at most
    ``max_loss`` of the good ones; 2 (nothing is rejected) where no bad row can be had so.
    ``counts``: (label, bin, rows)."""
    good, bad = np.zeros(BINS + 2), np.zeros(BINS + 2)
    for label, at, n in counts:
        (good if label else bad)[at] += n
    lost, caught = (np.cumsum(x[::-1])[::-1] for x in (good, bad))
    low = int(np.flatnonzero(lost <= max_loss * good.sum())[0])
    high = int(np.flatnonzero(caught == caught[low])[-1])
    return (low + high) // 2 / BINS if caught[low] else 2.0
