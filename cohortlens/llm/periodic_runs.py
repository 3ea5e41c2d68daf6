"""Periodic runs of words, found in a grammar-compressed text.

A run is a stretch of consecutive words with smallest period q and at least max(6, 4 q) words that no
neighbouring word extends. Documents are read where they lie, in groups of bounded size; nothing is
shuffled. In a group, Re-Pair compresses the word ids: each round counts the pairs of neighbouring
symbols and replaces those that occur twice or more, an occurrence giving way to an overlapping one
of a more frequent pair. What is left of a document is joined by a balanced tree of pairs. Every node
of the grammar is one boundary between two strings, and every run of a document crosses the boundary
of exactly one node of its derivation (the lowest that holds it), so the runs that cross a node's
boundary are computed once a node, however often it occurs; repeated text costs as much as its grammar.

At a boundary a run has two whole periods on one side. Distances between equal four-word grams (or
equal words, up to distance three) give the possible periods, prefix hashes drop those without two
equal halves, and the rest are extended both ways inside the node. Node runs are then translated to
all positions of their node, pieces of one run are merged to the maximal interval, and each is held
against the words themselves, so no hash decides a result.

Defined cases: a null or empty text, or one of white space alone, has no runs and collapses to the
empty text. Repeated rows give repeated rows; the id may be null. Equal (start, length) with several
periods is one run of the smallest. A text of any length is treated whole, in one task (a group is
never smaller than a document). Other columns are not read, whatever their names. Empty tables give
empty results.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

LEAST_WORDS, LEAST_PERIODS = 6, 4
GROUP_WORDS = 250_000  # words of the documents that share a grammar
GRAM = 4  # shorter periods are compared word by word
CHUNK = 1 << 20  # candidates handled at a time

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Grammar(NamedTuple):
    """Nodes with the place of their first occurrence and, node by node, the starts of all of them."""

    start: np.ndarray
    mid: np.ndarray
    end: np.ndarray
    first: np.ndarray  # offsets into places, one more than nodes
    places: np.ndarray


def _ranges(lengths: np.ndarray) -> np.ndarray:
    """0 .. n - 1 for each length n, joined."""
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _chosen(rank: np.ndarray) -> np.ndarray:
    """Positions to replace: occurrences whose pair ranks before both overlapping ones, and of a pair
    that overlaps itself every other one from the left. A rank of -1 stands for no pair."""
    edge = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1])))
    value = rank[edge].astype(np.float64)
    value[value < 0] = np.inf
    best = (value < np.inf) & (value < np.append(np.inf, value[:-1])) & (value < np.append(value[1:], np.inf))
    size = np.diff(np.append(edge, len(rank)))[best]
    steps = (size + 1) // 2
    return np.repeat(edge[best], steps) + 2 * _ranges(steps)


def grammar(words: np.ndarray, ends: np.ndarray) -> Grammar:
    """The grammar of documents whose words follow each other in ``words`` and end at ``ends``."""
    n = len(words)
    symbol, place = words.astype(np.int64), np.arange(n)
    last = np.zeros(n, dtype=bool)  # the last symbol of a document
    last[ends[ends > 0] - 1] = True
    live = ~last
    following = int(words.max(initial=-1)) + 1
    found, base = [], following

    def replace(at: np.ndarray, name: np.ndarray) -> None:
        nonlocal symbol, place, last, live
        found.append((name, place[at], place[at + 1], np.append(place, n)[at + 2]))
        symbol[at] = name
        last[at] = last[at + 1]
        live[at] = True
        live[at[at > 0] - 1] = True
        keep = np.ones(len(symbol), dtype=bool)
        keep[at + 1] = False
        symbol, place, last, live = symbol[keep], place[keep], last[keep], live[keep]
        live &= ~last

    while True:  # Re-Pair
        at = np.flatnonzero(live)
        pair = symbol[at] << 31 | symbol[at + 1]
        kinds, kind, count = np.unique(pair, return_inverse=True, return_counts=True)
        again = count[kind] > 1
        live[at[~again]] = False  # a pair's count never rises
        if not again.any():
            break
        order = np.empty(len(kinds), dtype=np.int64)
        order[np.argsort(-count, kind="stable")] = np.arange(len(kinds))
        rank = np.full(len(symbol), -1, dtype=np.int64)
        rank[at[again]] = order[kind[again]]
        chosen = _chosen(rank)
        names, name = np.unique(rank[chosen], return_inverse=True)
        replace(chosen, following + name)
        following += len(names)
    while not last.all():  # the balanced tree above
        edge = np.flatnonzero(np.concatenate(([True], last[:-1])))
        number = _ranges(np.diff(np.append(edge, len(last))))
        at = np.flatnonzero((number % 2 == 0) & ~last)
        replace(at, following + np.arange(len(at)))
        following += len(at)
    if not found:
        none = np.array([], dtype=np.int64)
        return Grammar(none, none, none, np.array([0]), none)
    name, start, mid, end = (np.concatenate(column) for column in zip(*found))
    order = np.argsort(name, kind="stable")
    first = np.searchsorted(name[order], np.arange(base, following + 1))
    lead = order[first[:-1]]
    return Grammar(start[lead], mid[lead], end[lead], first, start[order])


class Text:
    """Words with prefix hashes, for equality and common extensions of stretches."""

    def __init__(self, words: np.ndarray):
        self.words = words
        rng = np.random.default_rng(11)
        self.value = rng.integers(1, 1 << 63, int(words.max(initial=0)) + 1, dtype=np.uint64)[words] * np.uint64(2) + np.uint64(1)
        factors = np.full(len(words) + 1, 0x9E3779B97F4A7C15, dtype=np.uint64)
        factors[0] = 1
        self.power = np.cumprod(factors, dtype=np.uint64)
        self.sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(self.value * self.power[:-1], dtype=np.uint64)))

    def equal(self, one: np.ndarray, other: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether stretches of one length at two places (one <= other) have the same hash."""
        return (self.sums[one + length] - self.sums[one]) * self.power[other - one] == self.sums[other + length] - self.sums[other]

    def common(self, one: np.ndarray, other: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words from both places on (or before both) are equal, ``most`` at most."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            half = (low + high + 1) // 2
            same = self.equal(one - half, other - half, half) if back else self.equal(one, other, half)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low

    def grams(self, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Places sorted by their gram of words and then by place, as (keys, gram of each place or -1,
        stride): key = gram * stride + place. Grams that a document has once are left out."""
        n = len(self.words)
        sizes = np.diff(ends, prepend=0)
        mixed = np.repeat(np.arange(len(sizes)).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), sizes)[: max(0, n - GRAM + 1)]
        for k in range(GRAM):
            mixed = (mixed ^ self.value[k: k + len(mixed)]) * np.uint64(0xFF51AFD7ED558CCD)
            mixed ^= mixed >> np.uint64(32)
        whole = np.repeat(ends, sizes)[: len(mixed)] - np.arange(len(mixed)) >= GRAM
        places = np.flatnonzero(whole)
        order = places[np.argsort(mixed[places], kind="stable")]
        run = np.concatenate(([True], mixed[order][1:] != mixed[order][:-1])) if len(order) else np.array([], dtype=bool)
        number = np.cumsum(run) - 1
        many = np.bincount(number, minlength=1)[number] > 1 if len(order) else run
        gram = np.full(n + 1, -1, dtype=np.int64)
        gram[order[many]] = number[many]
        return number[many] * (n + 1) + order[many], gram, n + 1


def _periods(text: Text, ends: np.ndarray, g: Grammar, right: bool) -> tuple[np.ndarray, np.ndarray]:
    """(node, period), sorted: periods of which two lie just right (left) of the node's boundary."""
    w, room = text.words, (g.end - g.mid if right else g.mid - g.start) // 2
    nodes, periods = [], []
    for q in range(1, GRAM):
        node = np.flatnonzero(room >= q)
        base = g.mid[node] if right else g.mid[node] - 2 * q
        for k in range(q):
            same = w[base + k] == w[base + k + q]
            node, base = node[same], base[same]
        nodes.append(node)
        periods.append(np.full(len(node), q))
    keys, gram, stride = text.grams(ends)
    node = np.flatnonzero(room >= GRAM)
    at = g.mid[node] if right else g.mid[node] - GRAM
    node, at = node[gram[at] >= 0], at[gram[at] >= 0]
    own = gram[at] * stride + at
    near, far = own + (GRAM if right else -GRAM), own + (room[node] if right else -room[node])
    low = np.searchsorted(keys, near if right else far, "left")
    size = np.maximum(0, np.searchsorted(keys, far if right else near, "right") - low)
    cuts = np.searchsorted(np.cumsum(size), np.arange(0, int(size.sum()) + CHUNK, CHUNK)[1:], "left") + 1
    for a, b in zip([0, *cuts.tolist()], cuts.tolist()):
        some, which = size[a:b], np.repeat(np.arange(a, min(b, len(size))), size[a:b])
        q = np.abs(keys[np.repeat(low[a:b], some) + _ranges(some)] - own[which])
        base = g.mid[node[which]] - (0 if right else 2 * q)
        hit = text.equal(base, base + q, q)
        nodes.append(node[which[hit]])
        periods.append(q[hit])
    node, q = np.concatenate(nodes), np.concatenate(periods)
    order = np.lexsort((q, node))
    return node[order], q[order]


def crossing_runs(text: Text, ends: np.ndarray, g: Grammar) -> np.ndarray:
    """Rows (node, start within it, length, period) of the runs that cross the nodes' boundaries."""
    out = [np.empty((0, 4), dtype=np.int64)]
    for right in (True, False):
        node, q = _periods(text, ends, g, right)
        while len(node):
            # the smallest period of each node; what its run covers has no other smallest period
            lead = np.concatenate(([True], node[1:] != node[:-1]))
            v, p = node[lead], q[lead]
            base = g.mid[v] if right else g.mid[v] - p
            s = base - text.common(base, base + p, base - g.start[v], back=True)
            e = base + p + text.common(base, base + p, g.end[v] - base - p)
            for i in np.flatnonzero(e - s >= np.maximum(LEAST_WORDS, LEAST_PERIODS * p)).tolist():
                if not np.array_equal(text.words[s[i]:e[i] - p[i]], text.words[s[i] + p[i]:e[i]]):
                    s[i], e[i] = _extended(text.words, int(base[i]), int(p[i]), int(g.start[v[i]]), int(g.end[v[i]]))
            good = (e - s >= np.maximum(LEAST_WORDS, LEAST_PERIODS * p)) & (s < g.mid[v]) & (e > g.mid[v])
            out.append(np.column_stack((v, s - g.start[v], e - s, p))[good])
            group = np.cumsum(lead) - 1
            reach = np.where(right, e - g.mid[v], g.mid[v] - s)[group]
            rest = ~lead & (2 * q > reach)
            node, q = node[rest], q[rest]
    return np.concatenate(out)


def _extended(words: np.ndarray, base: int, q: int, low: int, high: int) -> tuple[int, int]:
    """The stretch around ``base`` that keeps period q within [low, high), word by word (where two
    different stretches had one hash)."""
    other = np.flatnonzero(words[base:high - q] != words[base + q:high])
    e = base + q + (int(other[0]) if len(other) else high - q - base)
    other = np.flatnonzero(words[low:base] != words[low + q:base + q])
    return (low + int(other[-1]) + 1 if len(other) else low), e


def find(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, sorted by start and period; starts count the words of the
    documents before."""
    g = grammar(words, ends)
    node, at, length, period = crossing_runs(Text(words), ends, g).T
    times = g.first[node + 1] - g.first[node]
    start = np.repeat(at, times) + g.places[np.repeat(g.first[node], times) + _ranges(times)]
    end, period = start + np.repeat(length, times), np.repeat(period, times)
    # pieces of one run share a whole period; merged, they give the maximal interval
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    wide = len(words) + 1
    reach = np.maximum.accumulate(period * wide + end) - period * wide if len(start) else end
    fresh = np.concatenate(([True], (period[1:] != period[:-1]) | (start[1:] + period[1:] > reach[:-1]))) if len(start) else np.array([], dtype=bool)
    lead = np.flatnonzero(fresh)
    start, period = start[lead], period[lead]
    end = np.maximum.reduceat(end, lead) if len(lead) else end
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    if len(start):
        smallest = np.concatenate(([True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])))
        start, end, period = start[smallest], end[smallest], period[smallest]
        order = np.lexsort((period, start))
        start, end, period = start[order], end[order], period[order]
    return start, end - start, period


def _group(texts: list[list[bytes]]) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed texts of documents given by their words."""
    index: defaultdict[bytes, int] = defaultdict()
    index.default_factory = index.__len__
    ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))
    words = np.fromiter(map(index.__getitem__, chain.from_iterable(texts)), dtype=np.int64, count=int(ends[-1]))
    start, length, period = find(words, ends)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    first = np.searchsorted(start, np.append(0, ends))
    starts = np.append(0, ends[:-1])
    collapsed = []
    for text, a, b, x, y in zip(texts, starts.tolist(), ends.tolist(), first.tolist(), first[1:].tolist()):
        if x < y:
            text = [text[i] for i in np.flatnonzero(kept[a:b]).tolist()]
        collapsed.append(b" ".join(text))
    shift = np.repeat(starts, np.diff(first))
    runs = pa.StructArray.from_arrays([pa.array(start - shift, pa.int64()), pa.array(length, pa.int64()), pa.array(period, pa.int64())], fields=list(RUN))
    return (pa.ListArray.from_arrays(pa.array(first, pa.int32()), runs), pa.array(collapsed, pa.binary()).cast(pa.string()))


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(id, n_words, runs, collapsed): every whole text's runs as (start, length, period) in words,
    sorted by start and period, and the text with one period left of each run, its words joined by a
    space. ``rewrite`` may change a document's words before they are searched."""
    kind = dict(docs.dtypes)[id_col]

    def shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, texts, size, done = batch[id_col].to_pylist(), [], 0, 0
            for i, text in enumerate(batch["text"]):
                words = (text.as_py() or "").encode().split()  # bytes: cut at ASCII white space
                texts.append(rewrite(held[i], words) if rewrite else words)
                size += len(words)
                if size >= GROUP_WORDS or i + 1 == len(held):
                    runs, collapsed = _group(texts)
                    yield pa.RecordBatch.from_arrays([batch[id_col].slice(done, len(texts)), pa.array(list(map(len, texts)), pa.int64()), runs, collapsed],
                                                     names=[id_col, "n_words", "runs", "collapsed"])
                    texts, size, done = [], 0, i + 1

    return docs.select(id_col, "text").mapInArrow(
        shape, f"`{id_col}` {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
