import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from cohortlens.llm import byte_bpe as B

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=B.load_ranks(PATH), special_tokens={})


def run(df, **options):
    return B.decode(B.encode(df, PATH, PATTERN, **options), PATH).collect()


def test_as_the_library_and_back(docs_of, corpus, odd, library):
    rng = random.Random(3)
    strange = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x250), rng.randrange(0x2000, 0x2070), rng.randrange(0x1F300, 0x1F600),
                                       rng.choice([9, 10, 11, 12, 13, 28, 31, 32, 133, 160])])) for _ in range(rng.randrange(1, 80))) for _ in range(150)]
    texts = [t for _, t in corpus[:60]] + [t for _, t in odd] + strange + ["<|endoftext|> as text", "don't we'll 'S it's   \n\n x"]
    rows = list(enumerate(texts))
    for block in (2_000, B.BLOCK_CHARS):
        out = {r["doc_id"]: r for r in run(docs_of(rows), block_chars=block)}
        assert len(out) == len(rows)
        for i, text in rows:
            assert np.frombuffer(out[i]["tokens"], "<u4").tolist() == library.encode_ordinary(text or "")
            assert bytes(out[i]["decoded"]) == (text or "").encode()


def test_pattern_splits_all_text(odd):
    for _, text in odd:
        assert "".join(regex.findall(PATTERN, text or "")) == (text or "")


def test_repeats_null_ids_extra_columns_and_empty(docs_of):
    df = docs_of([(1, "a b", "m"), (1, "a b", "m"), (None, "c", "m"), (2, None, "m")], "doc_id long, text string, tokens string")
    out = sorted(((r["doc_id"], bytes(r["decoded"])) for r in run(df)), key=str)
    assert out == sorted([(1, b"a b"), (1, b"a b"), (None, b"c"), (2, b"")], key=str)
    assert run(docs_of([])) == []
