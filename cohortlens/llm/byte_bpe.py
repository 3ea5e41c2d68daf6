"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Texts are split into pre-tokens and gathered into blocks of bounded size. A block keeps its
distinct pre-tokens once and each document as positions into them (packed). The words are exploded
by part, the hash of the word; each part encodes each distinct word of the whole corpus once and
sends the ids back to the blocks, where the documents are reassembled by position. A word that
every text holds is one entry per block, not per occurrence. Decoding joins token ids with the
token-byte table of the vocabulary.

The vocabulary (a rank file of at most some 10^5 entries, a parameter) is the only thing broadcast.
The number of parts grows with the text, so a part holds about as many words as a block.

Defined cases: a null or empty text has no tokens and decodes to nothing. Repeated rows give
repeated rows. Extra columns are not read; the id column may be null. Empty tables give empty
results. Special-token strings are ordinary text.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import staged

BLOCK_CHARS = 10_000_000


def load_ranks(path: str) -> dict[bytes, int]:
    """The token bytes and ids of a rank file (one base64 token and its id a line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


_encoders: dict[int, tuple] = {}


def _piece_encoder(ranks: dict[bytes, int], pattern: str):
    """The library's encoder of one pre-token, built once in a worker process."""
    if id(ranks) not in _encoders:
        _encoders.clear()
        _encoders[id(ranks)] = ranks, tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[id(ranks)][1]._encode_single_piece


def _pack(values: np.ndarray) -> bytes:
    """Unsigned 32-bit values by planes of bytes, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=9).compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def pack_positions(at: np.ndarray, words: int) -> tuple[bytes, bytes, bytes]:
    """Positions into words numbered by first occurrence, as (codes, rest, ranked): 0 for a word's
    first occurrence, else one more than its rank by frequency; ranks from 254 on go to ``rest``."""
    counts = np.bincount(at, minlength=words)
    ranked = np.argsort(-counts, kind="stable")[:int((counts > 1).sum())]
    rank = np.zeros(words, dtype=np.int32)
    rank[ranked] = np.arange(1, len(ranked) + 1)
    code = rank[at]
    code[np.diff(np.maximum.accumulate(at), prepend=-1) > 0] = 0  # numbered by first occurrence
    codes = zstandard.ZstdCompressor(level=9).compress(np.minimum(code, 255).astype(np.uint8).tobytes())
    return codes, _pack(code[code >= 255]), _pack(ranked)


def unpack_positions(codes: bytes, rest: bytes, ranked: bytes) -> np.ndarray:
    code = np.frombuffer(zstandard.ZstdDecompressor().decompress(codes), dtype=np.uint8).astype(np.int32)
    code[code == 255] = _unpack(rest)
    at = np.empty(len(code), dtype=np.int32)
    first = code == 0
    at[first] = np.arange(first.sum())
    at[~first] = _unpack(ranked)[code[~first] - 1]
    return at


WORDS = pa.list_(pa.struct([("part", pa.int64()), ("flat", pa.binary()), ("sizes", pa.binary())]))


def _blocks(docs: DataFrame, pattern: str, id_col: str, block_chars: int, parts: int) -> DataFrame:
    """block, ids, counts (pre-tokens of each text), their packed positions, each word's part, and
    words: the distinct pre-tokens by part."""
    kind = dict(docs.dtypes)[id_col]
    packed = ["counts", "codes", "rest", "ranked", "parts"]

    def shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        number, id_type = TaskContext.get().partitionId() << 32, None
        ids, seqs, index, held = [], [], {}, 0

        def block():
            counts, at = _pack(np.array(list(map(len, seqs)))), np.concatenate(seqs)
            seqs.clear()
            words = [w.encode() for w in index]
            index.clear()
            part = np.array([zlib.crc32(w) % parts for w in words], dtype=np.int64)
            order = np.argsort(part, kind="stable")
            edges = np.flatnonzero(np.concatenate(([True], np.diff(part[order]) != 0, [True]))) if len(order) else np.array([0])
            sent = []
            for x, y in zip(edges.tolist(), edges[1:].tolist()):
                some = [words[i] for i in order[x:y].tolist()]
                sent.append({"part": int(part[order[x]]), "flat": zstandard.ZstdCompressor(level=9).compress(b"".join(some)),
                             "sizes": _pack(np.array(list(map(len, some))))})
            values = [counts, *pack_positions(at, len(words)), _pack(part)]
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([ids], pa.list_(id_type)),
                                               *(pa.array([v], pa.binary()) for v in values), pa.array([sent], WORDS)],
                                              names=["block", "ids", *packed, "words"])

        for batch in batches:
            id_type = batch.schema.field(id_col).type
            for key, text in zip(batch[id_col].to_pylist(), batch["text"]):
                text = text.as_py() or ""
                ids.append(key)
                seqs.append(np.array([index.setdefault(w, len(index)) for w in find(text)], dtype=np.int32))
                held += len(text)
                if held >= block_chars or len(ids) >= 100_000:
                    yield block()
                    number, ids, seqs, index, held = number + 1, [], [], {}, 0
        if ids:
            yield block()

    return docs.select(id_col, "text").mapInArrow(
        shape, f"block long, ids array<{kind}>, " + ", ".join(f"{c} binary" for c in packed)
        + ", words array<struct<part: long, flat: binary, sizes: binary>>")


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, tokens): every whole text's token ids as little-endian unsigned 32-bit integers, as the
    tiktoken library would encode it without special tokens."""
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(load_ranks(vocabulary))
    kind = dict(docs.dtypes)[id_col]
    total = docs.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    blocks = staged(_blocks(docs, pattern, id_col, block_chars, -(-total // block_chars) or 1))

    def encode_words(table: pa.Table) -> pa.Table:
        piece = _piece_encoder(ranks.value, pattern)
        known: dict[bytes, list[int]] = {}
        out = []
        for flat, sizes in zip(table["flat"], table["sizes"]):
            flat, at, ids, lengths = zstandard.ZstdDecompressor().decompress(flat.as_py()), 0, [], []
            for size in _unpack(sizes.as_py()).tolist():
                word = flat[at:at + size]
                at += size
                tokens = known.get(word)
                if tokens is None:
                    tokens = known[word] = piece(word)
                ids += tokens
                lengths.append(len(tokens))
            out.append((_pack(np.array(ids)), _pack(np.array(lengths))))
        return pa.table({"block": table["block"], "part": table["part"], "tokens": pa.array([o[0] for o in out], pa.binary()),
                         "lengths": pa.array([o[1] for o in out], pa.binary())})

    words = blocks.select("block", F.explode("words").alias("w")).select(F.col("w.part").alias("part"), "block", "w.flat", "w.sizes")
    back = words.groupBy("part").applyInArrow(encode_words, "block long, part long, tokens binary, lengths binary")

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        replies = sorted(zip(*(right[c].to_pylist() for c in ("part", "tokens", "lengths"))))
        none = [np.array([], dtype="<u4")]
        flat = np.concatenate([_unpack(r[1]) for r in replies] or none)
        lengths = np.concatenate([_unpack(r[2]) for r in replies] or none).astype(np.int64)
        ids, out = [], []
        for row in left.to_pylist():
            order = np.argsort(_unpack(row["parts"]), kind="stable")  # words in the order of the replies
            sizes, starts = np.empty_like(lengths), np.empty_like(lengths)
            sizes[order], starts[order] = lengths, np.cumsum(lengths) - lengths
            at = unpack_positions(row["codes"], row["rest"], row["ranked"])
            ends = np.cumsum(_unpack(row["counts"]).astype(np.int64))
            for a, b in zip([0, *ends.tolist()], ends.tolist()):
                n = sizes[at[a:b]]
                shift = np.repeat(starts[at[a:b]] - (np.cumsum(n) - n), n)
                out.append(flat[shift + np.arange(len(shift))].tobytes())
            ids.extend(row["ids"])
        return pa.table({id_col: pa.array(ids, left.schema.field("ids").type.value_type), "tokens": pa.array(out, pa.binary())})

    return (blocks.drop("words").groupBy("block")
            .cogroup(back.select(F.col("block").alias("of_block"), "part", "tokens", "lengths").groupBy("of_block"))
            .applyInArrow(assemble, f"`{id_col}` {kind}, tokens binary"))


def token_bytes(vocabulary: str) -> list[bytes]:
    ranks = load_ranks(vocabulary)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def decode(tokens: DataFrame, vocabulary: str, id_col: str = "doc_id") -> DataFrame:
    """``tokens`` (id, tokens) plus ``decoded``: the bytes that the ids stand for."""
    table = tokens.sparkSession.sparkContext.broadcast(token_bytes(vocabulary))
    kind = dict(tokens.dtypes)[id_col]

    def shape(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = table.value.__getitem__
        for part in parts:
            texts = [b"".join(map(of, np.frombuffer(t.as_py() or b"", dtype="<u4").tolist())) for t in part["tokens"]]
            yield pa.RecordBatch.from_arrays([part[id_col], part["tokens"], pa.array(texts, pa.binary())], names=[id_col, "tokens", "decoded"])

    return tokens.select(id_col, "tokens").mapInArrow(shape, f"`{id_col}` {kind}, tokens binary, decoded binary")
