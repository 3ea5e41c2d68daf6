"""Alignment of two tokenizers' tokens by their shared byte ends.

Each text is tokenised whole by a byte-level BPE vocabulary (A) and a sentence-piece model (B). Where a
token of both ends at the same byte and the next tokens of both start with a space, there is an anchor:
anchors split a document into windows of token ids, mostly single words. The byte ends inside a window
follow from its ids alone, so a window is aligned once for each pair of id tuples and remembered.

Documents are gathered into blocks of bounded size. A block keeps each document's id pairs as positions
into the block's distinct pairs; only these, with the number of the block's documents that hold them,
are shuffled. Spark sums them over all blocks, finds the highest count of each A id, joins the counts
back and reassembles the blocks. A pair that every text holds is one row a block.

A text of characters whose class never changed between versions of Unicode is encoded for A by the
faster of two libraries (the vocabulary is the same, held against the other in the tests), others by the
one that A's file is for. Both files (some megabytes, parameters) are broadcast.

Defined cases: a text that is null or empty, or whose tokens of A or B do not spell a space and the
text (as one holding U+2581), has no tokens, all its numbers are zero and its digest is empty. Strings
of special tokens are plain text. Every row counts as a document, repeated ones too; the id may be
null. A text without spaces is one window, however long. Other columns are not read, whatever their
names. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import json
import os
import unicodedata
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.byte_bpe import _pack, _unpack
from cohortlens.llm.common import staged

BLOCK_CHARS = 10_000_000
PART_CHARS = 2_000_000  # texts tokenised at a time in a task
REMEMBERED = 200_000  # windows that a worker remembers
FEW_LINKS = 256  # groups with more links are paired by their different ids
#: FIXED VALUES: how byte-level vocabularies cut texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is printable,
    else the next one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def _ranges(lengths: np.ndarray) -> np.ndarray:
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


class Aligned(NamedTuple):
    """Texts' tokens and windows; per text: its A and B tokens and windows, none if it has no tokens."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_windows: np.ndarray
    window: np.ndarray  # the number of each window among those remembered


class Pair:
    """Both tokenizers, and what a worker remembers of windows."""

    def __init__(self, a: str, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = tokenizers.Tokenizer.from_str(a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        symbol = byte_symbols()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(symbol[c] for c in name) if all(c in symbol for c in name) else name.encode() for name in names]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(self.b.id_to_piece(list(range(self.b.get_piece_size()))))]
        self.a_size, self.b_size = (np.array(list(map(len, t)), dtype=np.int64) for t in (self.a_bytes, self.b_bytes))
        self.a_space, self.b_space = (np.array([t.startswith(b" ") for t in table]) for table in (self.a_bytes, self.b_bytes))
        # an id as text with what follows it: inside a group's side, and at its end
        self.text = [b"%d%s" % (i, after) for i in range(len(self.a_bytes)) for after in (b",", b"|")]
        self.text += [b"%d%s" % (i, after) for i in range(len(self.b_bytes)) for after in (b",", b";")]
        self.fast, self.stable = _by_ranks(json.loads(a), symbol), {}
        self.forget()

    def forget(self) -> None:
        """Start anew with windows."""
        self.windows: dict[tuple[bytes, bytes], int] = {}
        self.shown: list[bytes] = []  # the groups of a window as text, a semicolon after each
        self.n_groups = self.n_links = self.n_pairs = self.pair = self.times = np.array([], dtype=np.int64)

    def _is_stable(self, text: str, data: bytes) -> bool:
        """Whether every Unicode version gives all characters of the text the same class."""
        if np.frombuffer(data, dtype=np.uint8).max(initial=0) < 0xC9:  # below U+0240
            return True
        stable = self.stable
        for c in set(text):
            if c not in stable:
                old = unicodedata.ucd_3_2_0.category(c)
                stable[c] = old != "Cn" and old == unicodedata.category(c)
            if not stable[c]:
                return False
        return True

    def _a_ids(self, texts: list[str], data: list[bytes]) -> list[list[int]]:
        """A's ids of a space and each text."""
        out: list = [[]] * len(texts)
        slow = []
        for i, (text, coded) in enumerate(zip(texts, data)):
            if self.fast and self._is_stable(text, coded):
                out[i] = self.fast.encode_ordinary(" " + text)
            else:
                slow.append(i)
        for i, e in zip(slow, self.a.encode_batch([" " + texts[i] for i in slow], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def align(self, texts: list[str]) -> Aligned:
        if len(self.windows) > REMEMBERED:
            self.forget()
        data = [t.encode() for t in texts]
        ids = [self._a_ids(texts, data), self.b.encode(texts, num_threads=1)]
        a_bytes, b_bytes = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        good = [t != b"" and b"".join(map(a_bytes, a)) == b" " + t and b"".join(map(b_bytes, b)) == b" " + t for t, a, b in zip(data, *ids)]
        (n_a, a), (n_b, b) = (_joined([i if g else [] for i, g in zip(side, good)]) for side in ids)
        good = np.array(good, dtype=bool)
        # bytes of all texts in a row: a text's last end is shared
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        other = np.searchsorted(b_end, a_end)
        one = np.flatnonzero(b_end[other] == a_end) if len(a) else other
        other = other[one]
        last = np.zeros(len(a), dtype=bool)
        last[np.cumsum(n_a)[good] - 1] = True
        anchor = np.flatnonzero(last[one] | (np.append(self.a_space[a], False)[one + 1] & np.append(self.b_space[b], False)[other + 1]))
        one, other = np.append(0, one + 1), np.append(0, other + 1)  # group g: from [g] to [g + 1]
        first = np.append(0, anchor + 1)  # the same of windows, in groups
        keys = []
        for side, end in ((a, one), (b, other)):
            flat, at = side.astype("<u4").tobytes(), (4 * end[first]).tolist()
            keys.append([flat[x:y] for x, y in zip(at, at[1:])])
        windows, numbers, new = self.windows, [], []
        for place, key in enumerate(zip(*keys)):
            number = windows.get(key)
            if number is None:
                number = windows[key] = len(windows)
                new.append(place)
            numbers.append(number)
        if new:
            new = np.array(new)
            size = first[new + 1] - first[new]
            group = np.repeat(first[new], size) + _ranges(size)
            self._remember(size, a, one[group], one[group + 1], b, other[group], other[group + 1])
        doc = np.searchsorted(np.cumsum(n_a), one[first[1:]], "left")
        return Aligned(n_a, n_b, np.bincount(doc, minlength=len(texts)), np.array(numbers, dtype=np.int64))

    def _remember(self, size: np.ndarray, a: np.ndarray, a_from: np.ndarray, a_to: np.ndarray, b: np.ndarray, b_from: np.ndarray, b_to: np.ndarray) -> None:
        """Add windows of ``size`` groups each: the numbers, links and text that follow from their ids."""
        n_a, n_b, window = a_to - a_from, b_to - b_from, np.repeat(np.arange(len(size)), size)
        links, lead = n_a * n_b, np.cumsum(size) - size
        few = np.flatnonzero(links <= FEW_LINKS)
        which = np.repeat(few, links[few])
        k, wide = _ranges(links[few]), n_b[which]
        found = [(window[which], a[a_from[which] + k // wide] * len(self.b_bytes) + b[b_from[which] + k % wide], np.ones(len(k), dtype=np.int64))]
        for g in np.flatnonzero(links > FEW_LINKS).tolist():  # by different ids, never by occurrence
            (x, m), (y, n) = (np.unique(ids, return_counts=True) for ids in (a[a_from[g]:a_to[g]], b[b_from[g]:b_to[g]]))
            found.append((np.full(len(x) * len(y), window[g]), (x[:, None] * len(self.b_bytes) + y).ravel(), (m[:, None] * n).ravel()))
        owner, pair, times = _summed(*(np.concatenate(c) for c in zip(*found)), len(self.a_bytes) * len(self.b_bytes))
        self.n_groups = np.concatenate((self.n_groups, size))
        self.n_links = np.concatenate((self.n_links, np.add.reduceat(links, lead)))
        self.n_pairs = np.concatenate((self.n_pairs, np.bincount(owner, minlength=len(size))))
        self.pair, self.times = np.concatenate((self.pair, pair)), np.concatenate((self.times, times))
        both = n_a + n_b
        end = np.cumsum(both)
        code = np.empty(int(both.sum()), dtype=np.int64)
        for side, start, n, shift, base in ((a, a_from, n_a, end - both, 0), (b, b_from, n_b, end - n_b, 2 * len(self.a_bytes))):
            k = _ranges(n)
            code[np.repeat(shift, n) + k] = base + 2 * side[np.repeat(start, n) + k] + (k + 1 == np.repeat(n, n))
        spelt = list(map(self.text.__getitem__, code.tolist()))
        cuts = end[lead + size - 1].tolist()
        self.shown += [b"".join(spelt[x:y]) for x, y in zip([0, *cuts], cuts)]

    def groups_shown(self, windows: list[int]) -> bytes:
        """The groups of windows in a row, as text."""
        return b"".join(map(self.shown.__getitem__, windows))[:-1]


def _by_ranks(model: dict, symbol: dict[str, int]) -> tiktoken.Encoding | None:
    """The same vocabulary for the faster library, if ids follow the order of the merges and the texts
    are cut by the usual pattern of byte-level vocabularies."""
    vocab, merges = model["model"]["vocab"], model["model"]["merges"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    cut = model["pre_tokenizer"] or {}
    if [vocab.get(x + y) for x, y in pairs] != list(range(256, 256 + len(pairs))) or model["normalizer"] or             (cut.get("type"), cut.get("use_regex"), cut.get("add_prefix_space")) != ("ByteLevel", True, False):
        return None
    ranks = {bytes(symbol[c] for c in t): i for t, i in vocab.items() if i < 256 + len(pairs)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _joined(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The lists' lengths, and their items in a row."""
    size = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return size, np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(size.sum()))


def _summed(owner: np.ndarray, pair: np.ndarray, times: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows sorted by owner and pair (below ``wide``), the times of equal ones added."""
    key = owner * wide + pair
    order = np.argsort(key)
    key = key[order]
    lead = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.array([], dtype=np.int64)
    times = np.add.reduceat(times[order], lead) if len(key) else lead
    return key[lead] // wide, key[lead] % wide, times


_loaded: dict[int, Pair] = {}


def _pair(files: Broadcast) -> Pair:
    """The worker's tokenizers (one pair at a time)."""
    key = hash(files.value)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Pair(*files.value)
    return _loaded[key]


def _files(df: DataFrame, a_path: str, b_path: str) -> Broadcast:
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return df.sparkSession.sparkContext.broadcast((a.read(), b.read()))


def _parts(batch: pa.RecordBatch, id_col: str) -> Iterator[tuple[list, list[str]]]:
    """Ids and whole texts, some at a time."""
    ids, texts, size = [], [], 0
    for key, text in zip(batch[id_col].to_pylist(), batch["text"]):
        ids.append(key)
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= PART_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def alignments(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, groups): each text's groups of A ids and B ids between shared byte ends, in order, and the
    byte of a space and the text that each group ends before."""
    files, kind = _files(docs, a_path, b_path), dict(docs.dtypes)[id_col]
    item = pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("end", pa.int64())])

    def shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _pair(files)
        for batch in batches:
            for ids, texts in _parts(batch, id_col):
                found, out, at = both.align(texts), [], 0
                for n in found.n_windows.tolist():
                    groups, end = [], 0
                    for group in both.groups_shown(found.window[at:at + n].tolist()).split(b";") if n else ():
                        one, other = ([int(x) for x in side.split(b",")] for side in group.split(b"|"))
                        end += sum(len(both.a_bytes[x]) for x in one)
                        groups.append({"a": one, "b": other, "end": end})
                    out.append(groups)
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(id_col).type), pa.array(out, pa.list_(item))], names=[id_col, "groups"])

    return docs.select(id_col, "text").mapInArrow(shape, f"`{id_col}` {kind}, groups array<struct<a: array<int>, b: array<int>, end: long>>")


NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def _blocks(docs: DataFrame, files: Broadcast, id_col: str, block_chars: int) -> DataFrame:
    """block, the documents' ids, numbers and digests, their packed pairs, and the block's different
    pairs with the number of documents that hold each."""
    kind = dict(docs.dtypes)[id_col]

    def shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, number, id_type = _pair(files), TaskContext.get().partitionId() << 32, None
        ids, numbers, digests, held, chars = [], [], [], [], 0

        def block():
            count, pair, times = (np.concatenate(c) for c in zip(*held))
            kinds, place, docs_of = np.unique(pair, return_inverse=True, return_counts=True)
            columns = [c.tolist() for c in np.concatenate(numbers).T]
            packed = [_pack(count), _pack(place), _pack(times & 0xFFFFFFFF), _pack(times >> 32)]
            pairs = pa.StructArray.from_arrays([pa.array(kinds, pa.int64()), pa.array(docs_of, pa.int32())], names=["pair", "docs"])
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([ids], pa.list_(id_type)), *(pa.array([c], pa.list_(pa.int64())) for c in columns),
                 pa.array([digests], pa.list_(pa.string())), *(pa.array([p], pa.binary()) for p in packed), pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pairs)],
                names=["block", "ids", *NUMBERS, "digests", "counts", "places", "times", "times_high", "pairs"])

        for batch in batches:
            id_type = batch.schema.field(id_col).type
            for keys, texts in _parts(batch, id_col):
                found = both.align(texts)
                at = np.concatenate(([0], np.cumsum(found.n_windows)))
                w = found.window
                sums = [np.concatenate(([0], np.cumsum(c[w]))) for c in (both.n_groups, both.n_links)]
                numbers.append(np.column_stack((found.n_a, found.n_b, *(s[at[1:]] - s[at[:-1]] for s in sums))))
                shown = w.tolist()
                for x, y in zip(at.tolist(), at[1:].tolist()):
                    digests.append(hashlib.sha256(both.groups_shown(shown[x:y])).hexdigest() if y > x else "")
                # each document's different pairs and how often it links them
                first, size = np.concatenate(([0], np.cumsum(both.n_pairs)))[w], both.n_pairs[w]
                entry = np.repeat(first, size) + _ranges(size)
                doc = np.repeat(np.repeat(np.arange(len(texts)), found.n_windows), size)
                doc, pair, times = _summed(doc, both.pair[entry], both.times[entry], len(both.a_bytes) * len(both.b_bytes))
                held.append((np.bincount(doc, minlength=len(texts)), pair // len(both.b_bytes) << 32 | pair % len(both.b_bytes), times))
                ids.extend(keys)
                chars += sum(map(len, texts))
                if chars >= block_chars or len(ids) >= 100_000:
                    yield block()
                    number, ids, numbers, digests, held, chars = number + 1, [], [], [], [], 0
        if ids:
            yield block()

    schema = f"block long, ids array<{kind}>, " + ", ".join(f"{c} array<long>" for c in NUMBERS) + ", digests array<string>, " \
        + "counts binary, places binary, times binary, times_high binary, pairs array<struct<pair: long, docs: int>>"
    return docs.select(id_col, "text").mapInArrow(shape, schema)


def link_statistics(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document: id, n_a, n_b (tokens), n_groups, n_links (pairs of an A and a B token of one group),
    n_best (links whose id pair is in as many documents as any pair of its A id), count_sum (over the
    links, documents that hold the pair) and digest (of the groups)."""
    kind = dict(docs.dtypes)[id_col]
    blocks = staged(_blocks(docs, _files(docs, a_path, b_path), id_col, block_chars))
    held = blocks.select("block", F.posexplode("pairs").alias("place", "p")).select("block", "place", "p.pair", "p.docs")
    counts = held.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.shiftright("pair", 32))
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    judged = counts.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    back = held.drop("docs").join(judged, "pair").select(F.col("block").alias("of_block"), "place", "n", "best")

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        n, best = np.zeros((2, len(right) + 1), dtype=np.int64)
        n[right["place"].to_numpy()] = right["n"].to_numpy()
        best[right["place"].to_numpy()] = right["best"].to_numpy()
        columns = {c: [] for c in (id_col, *NUMBERS, "n_best", "count_sum", "digest")}
        for row in left.to_pylist():
            place = _unpack(row["places"])
            times = _unpack(row["times"]).astype(np.int64) | _unpack(row["times_high"]).astype(np.int64) << 32
            ends = np.cumsum(_unpack(row["counts"]).astype(np.int64))
            for name, values in (("n_best", best), ("count_sum", n)):
                total = np.concatenate(([0], np.cumsum(times * values[place])))
                columns[name] += (total[ends] - total[np.concatenate(([0], ends[:-1]))]).tolist()
            for name, source in [(id_col, "ids"), *((c, c) for c in NUMBERS), ("digest", "digests")]:
                columns[name] += row[source]
        types = {id_col: left.schema.field("ids").type.value_type, "digest": pa.string()}
        return pa.table({c: pa.array(v, types.get(c, pa.int64())) for c, v in columns.items()})

    return (blocks.drop("pairs").groupBy("block").cogroup(back.groupBy("of_block"))
            .applyInArrow(assemble, f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in (*NUMBERS, "n_best", "count_sum")) + ", digest string"))
