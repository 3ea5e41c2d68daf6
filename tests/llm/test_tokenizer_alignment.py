import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from cohortlens.llm import tokenizer_alignment as T
from cohortlens.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


@pytest.fixture(scope="module")
def both():
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        return T.Pair(a.read(), b.read())


def plain(libraries, text):
    """Groups [(A ids, B ids)] of a text by comparing all byte ends; None without tokens."""
    a, b = libraries
    if not text:
        return None
    shown = {c: bytes([x]) for c, x in T.byte_symbols().items()}
    ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)]
    spelt = [[b"".join(shown[c] for c in a.id_to_token(i)) for i in ids[0]],
             [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]]
    if any(b"".join(s) != b" " + text.encode() for s in spelt):
        return None
    ends = []
    for tokens in spelt:
        at, of = 0, {}
        for i, t in enumerate(tokens):
            at += len(t)
            of[at] = i + 1
        ends.append(of)
    out, x, y = [], 0, 0
    for end in sorted(ends[0].keys() & ends[1].keys()):
        out.append((ids[0][x:ends[0][end]], ids[1][y:ends[1][end]]))
        x, y = ends[0][end], ends[1][end]
    return out


def expected(libraries, rows):
    all_groups = [plain(libraries, t) for _, t in rows]
    links = [Counter((a, b) for g in groups or [] for a in g[0] for b in g[1]) for groups in all_groups]
    count = Counter(p for held in links for p in held)
    top = Counter()
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = []
    for (i, _), groups, held in zip(rows, all_groups, links):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups or [])
        out.append((i, sum(len(a) for a, _ in groups or []), sum(len(b) for _, b in groups or []), len(groups or []), sum(held.values()),
                    sum(m for p, m in held.items() if count[p] == top[p[0]]), sum(m * count[p] for p, m in held.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


STRANGE = ["a▁b", " ", "  two  spaces ", "\n\n x", "tabs\tand hard spaces ᠎ y", "<|endoftext|> <s></s><unk> <0x41>", "don't  we'll 'S",
           "漢字仮名 مرحبا \U0001f600\U0001f468‍\U0001f469‍\U0001f467", "é́ ﻿ \x00 \x1c \x85 z", " a   b　c", "1234567 89.5e-3"]


def random_texts(seed, n):
    rng = random.Random(seed)
    letters = [" ", " ", "  ", "\n", "\t", " ", "᠎", "\x1c", "'", "s", "ll", "the", "Z", "9", "42", ".", "--", "é", "Ω", "漢", "\U0001f600", "́", "ing"]
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


def test_both_libraries_encode_alike(libraries, both, corpus, odd):
    texts = STRANGE + random_texts(1, 600) + [t for _, t in corpus[:80] if t] + [t for _, t in odd if t]
    data = [t.encode() for t in texts]
    assert both.fast and {both._is_stable(t, d) for t, d in zip(texts, data)} == {True, False}
    for text, ids in zip(texts, both._a_ids(texts, data)):
        assert ids == libraries[0].encode(" " + text, add_special_tokens=False).ids


def test_every_token_is_reached_by_its_merges(libraries, both):
    """The faster library takes a pre-token that is a token whole; so do the merges."""
    model = libraries[0].model
    for i in range(256, len(both.a_bytes) - 1):
        assert [t.id for t in model.tokenize(libraries[0].id_to_token(i))] == [i]


def test_other_vocabularies_are_left_to_their_library():
    import json

    with open(A, encoding="utf-8") as file:
        model = json.load(file)
    symbol = T.byte_symbols()
    assert T._by_ranks(model, symbol)
    assert T._by_ranks({**model, "normalizer": {"type": "NFC"}}, symbol) is None
    swapped = [model["model"]["merges"][1], model["model"]["merges"][0], *model["model"]["merges"][2:]]
    assert T._by_ranks({**model, "model": {**model["model"], "merges": swapped}}, symbol) is None


@pytest.mark.parametrize("block", [3_000, T.BLOCK_CHARS])
def test_statistics_as_brute_force(docs_of, libraries, corpus, odd, block):
    texts = STRANGE + random_texts(2, 60) + [t for _, t in corpus[:40]] + ["", None, "the the the"] * 2
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, "the cat"), (5000, "x" * 30_000), (5001, "word " * 8_000),
                                                                    (5002, "\n" * 5_000 + "a" + "\u3000" * 700)]
    got = [tuple(r) for r in T.link_statistics(docs_of(rows), A, B, block_chars=block).collect()]
    assert sorted(got, key=str) == sorted(expected(libraries, rows), key=str)


def test_forgetting_changes_nothing(libraries, both, monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED", 3)
    for text in random_texts(4, 60):
        found = both.align([text, "", text])
        shown = both.groups_shown(found.window[:found.n_windows[0]].tolist()).decode()
        assert shown == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in plain(libraries, text))
        assert found.n_windows.tolist() == [found.n_windows[0], 0, found.n_windows[0]]


def test_groups_of_each_text(docs_of, libraries):
    rows = list(enumerate([*STRANGE, "", None]))
    for r in T.alignments(docs_of(rows), A, B).collect():
        groups = plain(libraries, rows[r["doc_id"]][1]) or []
        assert [(g["a"], g["b"]) for g in r["groups"]] == groups
        assert not groups or r["groups"][-1]["end"] == 1 + len(rows[r["doc_id"]][1].encode())


def test_clashing_columns_and_empty_table(docs_of):
    df = docs_of([(1, "a b", "x", "y")], "doc_id long, text string, digest string, block string")
    assert [r["n_groups"] for r in T.link_statistics(df, A, B).collect()] == [2]
    assert T.link_statistics(docs_of([]), A, B).collect() == []


def test_query_as_brute_force(spark, libraries, corpus):
    out = QUERIES["op12_tokenizer_alignment"](spark, "/root/testdata/sf0.001")
    assert [f"{n} {t}" for n, t in out.dtypes] == ["doc_id bigint", "n_a bigint", "n_b bigint", "n_groups bigint", "n_links bigint", "n_best bigint",
                                                   "count_sum bigint", "groups_sha256 string"]
    assert sorted(tuple(r) for r in out.collect()) == sorted(expected(libraries, corpus))
