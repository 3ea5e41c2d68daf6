"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A text's features are its distinct words hashed to ``DIMS`` columns, its structure statistics and
its length. Each feature i has a weight w_i and a latent vector v_i; the score's logit is
``w_0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum (v_if x_i)^2)``, the pairwise interactions
in time linear in the features. It is fitted by mini-batch Adagrad on at most about ``max_train``
labelled documents (picked by a hash of the id, a documented bound; one row each); every whole text is scored.

Labels are learned only from rows whose crc32(id as text) mod 3 is not 1; labels, lang, source and
the id are never inputs of a score.

Defined cases: a null or empty text is scored by its statistics alone. Repeated rows give repeated
rows. A null id is held out of nothing and never trained on. A document labelled more than once is
taken by its smallest label; null labels are not used. Without training rows every score is 0.5.
Extra columns pass through; one named like
an output is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import kept_names, sampled
from cohortlens.llm.text_stats import text_stats

DIMS = 1 << 16
N_STATS = 9
RANK = 8
OUT = ("held_out", "score", "predicted")


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def text_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Columns and values of one text: words at 0 to DIMS - 1, then the statistics."""
    s, words = text_stats(text)
    crc = zlib.crc32
    columns = np.unique(np.array([crc(w) & (DIMS - 1) for w in set(words)], dtype=np.int64))
    n, chars, lines = max(s.n_words, 1), max(s.word_chars, 1), max(s.n_lines, 1)
    dense = [min(s.word_chars / n / 10, 3), min(10 * s.n_symbols / chars, 3), s.n_dup_lines / lines, s.n_repeat_words / n,
             s.n_capitals / chars, min(10 * s.n_digits / chars, 3), min(s.n_marks / n, 3), np.log1p(len(text)) / 10, float(s.n_words == 0)]
    values = np.concatenate((np.full(len(columns), 1 / np.sqrt(max(len(columns), 1))), dense)).astype(np.float32)
    return np.concatenate((columns, np.arange(DIMS, DIMS + N_STATS))), values


class Machine:
    """w_0, w and V of a fitted machine."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.bias = 0.0
        self.w = np.zeros(DIMS + N_STATS, dtype=np.float32)
        self.v = rng.normal(0, 0.05, (DIMS + N_STATS, RANK)).astype(np.float32)

    def logits(self, columns: np.ndarray, values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits of the rows that begin at ``starts``, and each row's sums of v x."""
        vx = self.v[columns] * values[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        pairs = 0.5 * (sums ** 2 - np.add.reduceat(vx ** 2, starts, axis=0)).sum(axis=1)
        return self.bias + np.add.reduceat(self.w[columns] * values, starts) + pairs, sums

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = 6, batch: int = 128, rate: float = 0.1, decay: float = 1e-5):
        rng = np.random.default_rng(5)
        gw, gv, gb = np.full(len(self.w), 1e-2, np.float32), np.full(self.v.shape, 1e-2, np.float32), 1e-2
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), batch):
                some = order[at:at + batch]
                sizes = np.array([len(rows[i][0]) for i in some])
                columns, values = (np.concatenate([rows[i][k] for i in some]) for k in (0, 1))
                logit, sums = self.logits(columns, values, np.cumsum(sizes) - sizes)
                error = ((1 / (1 + np.exp(-logit)) - y[some]) / len(some)).astype(np.float32)
                each = np.repeat(error, sizes) * values
                own, at_own = np.unique(columns, return_inverse=True)
                dw = np.bincount(at_own, each, len(own)).astype(np.float32) + decay * self.w[own]
                dv = each[:, None] * (np.repeat(sums, sizes, axis=0) - self.v[columns] * values[:, None])
                dv = np.column_stack([np.bincount(at_own, dv[:, f], len(own)) for f in range(RANK)]).astype(np.float32) + decay * self.v[own]
                gw[own] += dw ** 2
                gv[own] += dv ** 2
                gb += float(error.sum()) ** 2
                self.w[own] -= rate * dw / np.sqrt(gw[own])
                self.v[own] -= rate * dv / np.sqrt(gv[own])
                self.bias -= rate * float(error.sum()) / gb ** 0.5
        return self


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, max_train: int) -> tuple[list, np.ndarray]:
    """Features and labels of at most about ``max_train`` labelled, not held-out documents."""
    marks = (labels.where(F.col("quality").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("_id")).agg(F.min("quality").alias("_quality")))
    share = min(1.0, max_train / max(1, marks.count()))
    if share < 1:
        marks = marks.where(sampled(share, "_id"))

    def shape(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            made = [text_features(t.as_py() or "") for t in part["text"]]
            yield pa.RecordBatch.from_arrays(
                [part["_id"].cast(pa.string()), part["_quality"].cast(pa.int32()), pa.array([c.astype("<i4").tobytes() for c, _ in made], pa.binary()),
                 pa.array([v.tobytes() for _, v in made], pa.binary())], names=["id", "quality", "c", "v"])

    chosen = docs.select(id_col, "text").join(F.broadcast(marks), F.col(id_col) == F.col("_id")).groupBy("_id", "_quality").agg(F.min("text").alias("text"))
    rows = sorted(chosen.mapInArrow(shape, "id string, quality int, c binary, v binary").collect(), key=lambda r: (r["id"], r["c"]))
    return ([(np.frombuffer(r["c"], "<i4").astype(np.int64), np.frombuffer(r["v"], "<f4")) for r in rows],
            np.array([r["quality"] for r in rows], dtype=np.float32))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", max_train: int = 8000) -> DataFrame:
    """``docs`` with held_out, score (0 to 1) and predicted (1 from 0.5 on) of every whole text."""
    rows, y = training_rows(docs, labels, id_col, max_train)
    machine = Machine()
    if len(rows):
        machine.fit(rows, y)
    else:
        machine.v[:] = 0
    model = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.w, machine.v))
    given = docs.select(*[f"`{c}`" for c in kept_names(docs, OUT)])

    def shape(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Machine.__new__(Machine)
        fitted.bias, fitted.w, fitted.v = model.value
        for part in parts:
            scores = []
            for text in part["text"]:
                columns, values = text_features(text.as_py() or "")
                logit = fitted.logits(columns, values, np.array([0]))[0][0]
                scores.append(float(1 / (1 + np.exp(-np.clip(logit, -30, 30)))))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=[*part.schema.names, "score"])

    schema = ", ".join(f"`{c}` {kind}" for c, kind in given.dtypes) + ", score double"
    return given.mapInArrow(shape, schema).select("*", held_out(id_col).alias("held_out"), (F.col("score") >= 0.5).cast("int").alias("predicted"))
