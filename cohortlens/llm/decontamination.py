"""Benchmark decontamination: windows of documents within a small edit distance of an item.

Texts and items are lower-cased and runs of white space become one space. For an item of L
characters and ``max_edit`` of K = floor(max_edit * L) edits:

* Window starts. The item is cut into K + 2 pieces; K edits leave two of them whole, on diagonals
  at most K apart. All texts are scanned (vectorised, whole texts in slices) for the pieces' leading
  characters; two hits of different pieces of an item on near diagonals give item-sized windows,
  one for each diagonal. No window within K edits is lost here.
* CGK embedding. Window and item walk over their characters under shared random bits (a character
  is written out at every step, and the bit of step and character says whether to go on), which
  maps their edit distance to a Hamming distance. Bit-sampling LSH compares ``SAMPLE`` random steps
  of a walk; a pair that agrees on all of them in any repetition goes on. The share of agreeing
  steps falls with length, so items form classes of near edit budgets, and each class has the number
  of repetitions that reaches ``recall`` on edited copies of all its items, at K edits, inside other
  text and in the windows that the scan finds for them. Where ``LIMIT`` repetitions do not reach it,
  all windows of the class go on.
* Verification. The exact edit distance of the item to its best match around the window (a
  bit-parallel scan) must be at most K.

The benchmark is read in blocks of ``block_items`` items, the only thing sent to all tasks; the
documents are not shuffled. A passage that a third of all documents hold gives one row a document.

Defined cases: null or empty texts and items match nothing, nor do items that are white space only.
Repeated items count once (smallest id); repeated rows give repeated rows. Null ids are carried.
Extra columns are not read. Empty tables give an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

SAMPLE = 4
WALKS = 4
SEED_CHARS = 8
SLICE = 1_000_000
#: Most repetitions of a class, copies that a class is calibrated on at least, and cells of one embedding.
LIMIT = 4096
COPIES = 256
CELLS = 1 << 24


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def edit_match(item: str, text: str) -> tuple[int, int]:
    """(distance, end) of the item's best match anywhere in the text (Myers' bit vectors on one
    large integer); the first end among equals."""
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    up, down, now = full, 0, len(item)
    best = (now, 0)
    for at, c in enumerate(text):
        eq = masks.get(c, 0)
        diagonal = ((((eq & up) + up) ^ up) | eq) | down
        plus, minus = down | (full & ~(diagonal | up)), up & diagonal
        now += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1, (minus << 1) & full
        up, down = minus | (full & ~(diagonal | plus)), plus & diagonal & full
        if now < best[0]:
            best = (now, at + 1)
    return best


def embed(rows: np.ndarray, sizes: np.ndarray, steps: int, walk: int) -> np.ndarray:
    """The CGK walks of padded rows of characters: one written character a step, 0 past the end."""
    rng = np.random.default_rng(1000 + walk)
    mix = rng.integers(1, 1 << 63, steps, dtype=np.uint64) | np.uint64(1)
    out = np.zeros((steps, len(rows)), dtype=np.uint32)
    at, every = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows))
    for step in range(steps):
        now = rows[every, np.minimum(at, rows.shape[1] - 1)]
        out[step] = np.where(at < sizes, now, 0)
        bits = ((out[step].astype(np.uint64) + np.uint64(1)) * mix[step]) >> np.uint64(63)
        at += bits.astype(np.int64)
    return out.T


def padded(parts: list[np.ndarray], width: int) -> np.ndarray:
    rows = np.zeros((len(parts), width), dtype=np.uint32)
    for row, part in zip(rows, parts):
        row[:len(part)] = part[:width]
    return rows


def edited(text: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    out = text.tolist()
    for _ in range(edits):
        at, kind = int(rng.integers(0, len(out) + 1)), rng.integers(0, 3)
        if kind == 0:
            out.insert(at, int(rng.choice(text)))
        elif len(out) > 1 and at < len(out):
            if kind == 1:
                del out[at]
            else:
                out[at] = int(rng.choice(text))
    return np.array(out, dtype=np.uint32)


class Items:
    """A block of items with their seeds, walks and calibrated repetitions."""

    def __init__(self, items: list[tuple], max_edit: float, recall: float):
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        self.codes = [codes(t) for t in self.texts]
        self.sizes = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.edits = np.floor(max_edit * self.sizes).astype(np.int64)
        self.width = int(self.sizes.max(initial=1))
        self._seeds()
        self._calibrate(recall)

    def _seeds(self) -> None:
        """By seed length: hashes in order, and each one's item, piece and offset."""
        by_length = defaultdict(list)
        for item, (text, edits) in enumerate(zip(self.codes, self.edits.tolist())):
            pieces = min(edits + 2, len(text))
            length = max(1, min(SEED_CHARS, len(text) // pieces))
            for piece in range(pieces):
                offset = len(text) * piece // pieces
                by_length[length].append((int(rolling(text[offset:offset + length], length)[0]), item, piece, offset))
        self.seeds = {}
        for length, seeds in by_length.items():
            seeds.sort()
            hashes = np.array([s[0] for s in seeds], dtype=np.uint64)
            sieve = np.zeros(1 << 20, dtype=bool)
            sieve[hashes >> np.uint64(44)] = True
            self.seeds[length] = (hashes, *(np.array([s[k] for s in seeds], dtype=np.int64) for k in (1, 2, 3)), sieve)

    def _calibrate(self, recall: float) -> None:
        """Classes of edit budgets (four for each power of two) with their items' walks and the
        repetitions that reach the recall; LIMIT + 1 where none do. Half of the loss is left to what
        the copies do not show."""
        self.kind = np.array([e >> max(0, e.bit_length() - 3) | e.bit_length() << 3 for e in self.edits.tolist()], dtype=np.int64)
        self.place, self.walks, self.repetitions = np.zeros(len(self.codes), dtype=np.int64), {}, {}
        self.shares = np.random.default_rng(17).random((LIMIT, SAMPLE))
        rng, letters = np.random.default_rng(3), np.concatenate([np.zeros(0, dtype=np.uint32), *self.codes])
        for kind in np.unique(self.kind).tolist():
            own = np.flatnonzero(self.kind == kind)
            self.place[own] = np.arange(len(own))
            width = int(self.sizes[own].max())
            rows = padded([self.codes[i] for i in own], width)
            self.walks[kind] = [embed(rows, self.sizes[own], 2 * width, w) for w in range(WALKS)]
            of = own.repeat(-(-COPIES // len(own)))
            around = int(self.edits[own].max()) + 8
            parts = [np.concatenate((rng.choice(letters, around), edited(self.codes[i], int(self.edits[i]), rng), rng.choice(letters, around))) for i in of]
            first, step = np.full(len(of), LIMIT), max(1, CELLS // (16 * width))
            for at in range(0, len(of), step):
                first[at:at + step] = self._first_of_copies(parts[at:at + step], of[at:at + step])
            missed = int((1 - recall) / 2 * len(of))
            self.repetitions[kind] = int(np.sort(first)[len(of) - 1 - missed]) + 1
            if self.repetitions[kind] > LIMIT:
                self.walks[kind] = []

    def _first_of_copies(self, parts: list[np.ndarray], of: np.ndarray) -> np.ndarray:
        """The first repetition in which a window of each text's own item agrees; LIMIT if none."""
        chars = np.concatenate([np.append(p, np.uint32(0)) for p in parts])
        lengths = np.array([len(p) for p in parts], dtype=np.int64)
        ends = np.cumsum(lengths + 1) - 1
        doc, item, start = windows_of(chars, ends, self)
        mine = item == of[doc]
        doc, item, start = doc[mine], item[mine], start[mine]
        rows, sizes = cut_windows(chars, ends, lengths, doc, start, self.sizes[item])
        return self._first(rows, sizes, item, doc, len(parts), LIMIT)

    def _first(self, windows: np.ndarray, sizes: np.ndarray, item: np.ndarray, group: np.ndarray, groups: int, limit: int) -> np.ndarray:
        """For each group of windows of one class's items, the first repetition in which one of them
        agrees with its item on all samples; ``limit`` if none."""
        first = np.full(groups, limit)
        if not len(windows):
            return first
        own = self.walks[int(self.kind[item[0]])]
        steps = own[0].shape[1]
        batch = max(1, CELLS // steps)
        for at in range(0, len(windows), batch):
            part = slice(at, at + batch)
            some, to, size = self.place[item[part]], group[part], 2 * self.sizes[item[part], None]
            agree = [embed(windows[part, :steps // 2], sizes[part], steps, w) == own[w][some] for w in range(min(WALKS, limit))]
            left = np.arange(len(some))
            for r in range(limit):
                if r % 16 == 0:
                    left = left[first[to[left]] > r]
                    if not len(left):
                        break
                at_steps = (self.shares[r][None, :] * size[left]).astype(np.int64)
                hit = to[left[agree[r % WALKS][left[:, None], at_steps].all(axis=1)]]
                first[hit] = np.minimum(first[hit], r)
        return first

    def alike(self, windows: np.ndarray, sizes: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Which windows agree with their item on all samples of some repetition of its class."""
        found = np.ones(len(windows), dtype=bool)
        for kind in np.unique(self.kind[item]).tolist():
            some, n = np.flatnonzero(self.kind[item] == kind), self.repetitions[kind]
            if n <= LIMIT:
                found[some] = self._first(windows[some], sizes[some], item[some], np.arange(len(some)), len(some), n) < n
        return found


def cut_windows(chars: np.ndarray, ends: np.ndarray, lengths: np.ndarray, doc: np.ndarray, start: np.ndarray,
                sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows' characters, padded, and their sizes inside their documents."""
    low, high = (np.clip(x, (ends - lengths)[doc], ends[doc]) for x in (start, start + sizes))
    reach = low[:, None] + np.arange(int(sizes.max(initial=1)))[None, :]
    return np.where(reach < high[:, None], chars[np.minimum(reach, len(chars) - 1)], 0).astype(np.uint32), high - low


def rolling(text: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` characters from each position on."""
    h = (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    factors = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
    parts, step, done, offset = [], 1, 0, 0
    for bit in range(length.bit_length()):
        if length >> bit & 1:
            parts.append((h, offset))
            offset += step
        if done + 1 < length.bit_length():
            h = h[:-step] * np.uint64(factors[min(done, 2)]) + h[step:] if len(h) > step else h[:0]
            step *= 2
            done += 1
    n = len(text) - length + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for values, at in parts:
        out = (out ^ values[at:at + len(out)]) * np.uint64(0xFF51AFD7ED558CCD)
    return out


def windows_of(text: np.ndarray, ends: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, item, start): the distinct diagonals of hits that have another piece's hit near
    by. ``text`` holds documents that end before ``ends``, each followed by one separator."""
    found = [np.zeros((0, 3), dtype=np.int64)]
    for length, (hashes, item, piece, offset, sieve) in items.seeds.items():
        for at in range(0, max(len(text) - length + 1, 0), SLICE):
            h = rolling(text[at:at + SLICE + length - 1], length)
            hit = np.flatnonzero(sieve[h >> np.uint64(44)])
            lo, hi = np.searchsorted(hashes, h[hit], "left"), np.searchsorted(hashes, h[hit], "right")
            n = hi - lo
            seed = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            where = np.repeat(hit + at, n)
            key = np.searchsorted(ends, where, "right") * len(items.ids) + item[seed]
            found.append(np.column_stack((key, where - offset[seed], piece[seed])))
    hits = np.concatenate(found)
    hits = hits[np.lexsort((hits[:, 2], hits[:, 1], hits[:, 0]))]
    which = hits[:, 0] % len(items.ids)
    edits = items.edits[which]
    near = items.sizes[which] < 2  # an item of one character has one piece
    step, more = 1, len(hits) > 1
    while more:  # neighbours on diagonals at most K apart, until one of another piece is found
        a, b = hits[:-step], hits[step:]
        close = (a[:, 0] == b[:, 0]) & (b[:, 1] - a[:, 1] <= edits[:-step])
        other = close & (a[:, 2] != b[:, 2])
        near[:-step] |= other
        near[step:] |= other
        more = step + 1 < len(hits) and bool((close & ~(near[:-step] & near[step:])).any())
        step += 1
    hits = np.unique(hits[near][:, :2], axis=0)
    return hits[:, 0] // len(items.ids), hits[:, 0] % len(items.ids), hits[:, 1]


def matches(texts: list[str], items: Items) -> list[tuple[int, int, int, int]]:
    """(text, item, distance, end) of each text's best match of each item, in normalised text."""
    shown = [normal(t) for t in texts]
    chars = codes("\0".join(shown) + "\0")
    lengths = np.array([len(t) for t in shown], dtype=np.int64)
    ends = np.cumsum(lengths + 1) - 1
    doc, item, start = windows_of(chars, ends, items)
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for at in range(0, len(item), 4096):
        which, begin, of = item[at:at + 4096], start[at:at + 4096], doc[at:at + 4096]
        ok = items.alike(*cut_windows(chars, ends, lengths, of, begin, items.sizes[which]), which)
        for d, i, s in zip(of[ok].tolist(), which[ok].tolist(), (begin - (ends - lengths)[of])[ok].tolist()):
            edits, size = int(items.edits[i]), int(items.sizes[i])
            if best.get((d, i), (1, 0))[0] == 0:
                continue
            from_ = max(0, s - edits)
            distance, end = edit_match(items.texts[i], shown[d][from_:max(0, s + size + 2 * edits)])
            if distance <= edits and ((d, i) not in best or (distance, from_ + end) < best[d, i]):
                best[d, i] = (distance, from_ + end)
    return [(d, i, distance, end) for (d, i), (distance, end) in sorted(best.items())]


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", max_edit: float = 0.1,
          recall: float = 0.99, block_items: int = 2000) -> DataFrame:
    """(id, item id, edits, match_end): each document's best match of each item it holds."""
    spark, kind, item_kind = docs.sparkSession, dict(docs.dtypes)[id_col], dict(benchmark.dtypes)[item_col]
    schema = f"`{id_col}` {kind}, `{item_col}` {item_kind}, edits int, match_end long"
    found, block, seen = None, [], set()
    item_type = to_arrow_type(benchmark.schema[item_col].dataType)

    def search(part: list[tuple]) -> DataFrame:
        items = spark.sparkContext.broadcast(Items(part, max_edit, recall))

        def shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fixed = items.value
            for batch in batches:
                keys, texts = batch[id_col].to_pylist(), [t or "" for t in batch["text"].to_pylist()]
                rows = [(keys[d], fixed.ids[i], edits, end) for d, i, edits, end in matches(texts, fixed)]
                columns = list(zip(*rows)) or [()] * 4
                types = [batch.schema.field(id_col).type, item_type, pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[id_col, item_col, "edits", "match_end"])

        return docs.select(id_col, "text").mapInArrow(shape, schema)

    ordered = benchmark.where("text is not null").select(item_col, "text").orderBy(item_col)
    for row in ordered.toLocalIterator():
        text = normal(row["text"])
        if text and text not in seen:
            seen.add(text)
            block.append((row[item_col], text))
        if len(block) == block_items:
            found, block, seen = search(block) if found is None else found.unionByName(search(block)), [], set()
    if block:
        found = search(block) if found is None else found.unionByName(search(block))
    return spark.createDataFrame([], schema) if found is None else found


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; rows without an id are kept."""
    return docs.join(leaks(docs, benchmark, id_col, **options).select(id_col).distinct(), id_col, "left_anti")
