import random

import numpy as np
import pytest

from cohortlens.llm import decontamination as D


def slow_match(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


@pytest.fixture(scope="module")
def items():
    import duckdb

    return duckdb.sql("SELECT item_id, text FROM '/root/testdata/sf0.001/benchmark.parquet' ORDER BY item_id").fetchall()


def test_edit_match_against_dynamic_programming():
    rng = random.Random(2)
    for _ in range(300):
        item, text = ("".join(rng.choice("abc") for _ in range(rng.randrange(lo, 20))) for lo in (1, 0))
        distance, end = D.edit_match(item, text)
        assert distance == slow_match(item, text)
        assert end == 0 or slow_match(item, text[:end]) == distance


def test_corpus_against_brute_force(spark, docs_of, corpus, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(d, t) for d, t in corpus if len(t) < 3000]
    want = {(d, i) for d, t in rows for i, x in items if D.edit_match(D.normal(x), D.normal(t))[0] <= int(0.1 * len(D.normal(x)))}
    out = D.leaks(docs_of(rows), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == want and want
    blocks = D.leaks(docs_of(rows), bench, block_items=7).collect()
    assert {(r["doc_id"], r["item_id"]) for r in blocks} == want


def test_recall_of_edited_passages(items):
    known = [(i, D.normal(t)) for i, t in items]
    fitted = D.Items(known, 0.1, 0.99)
    rng, texts, want = np.random.default_rng(4), [], []
    filler = "some other words that stand around the passage in the document " * 4
    for k in range(200):
        i = k % len(known)
        changed = "".join(map(chr, D.edited(fitted.codes[i], int(fitted.edits[i]), rng)))
        if slow_match(known[i][1], changed) <= fitted.edits[i]:
            texts.append(f"{filler}{changed} {filler}")
            want.append(i)
    found = {(d, i) for d, i, _, _ in D.matches(texts, fitted)}
    assert np.mean([(d, i) in found for d, i in enumerate(want)]) >= 0.97


def recall_of(sizes, longest, copies, seed):
    """Of copies of the longest items, edited to the limit, the share found beside many shorter items."""
    rng = np.random.default_rng(seed)
    draw = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))
    known = [(i, draw(n)) for i, n in enumerate(sizes)]
    fitted = D.Items(known, 0.1, 0.99)
    at = [i for i, n in enumerate(sizes) if n == longest]
    found = []
    for k in range(copies):
        i = at[k % len(at)]
        changed = "".join(map(chr, D.edited(fitted.codes[i], int(fitted.edits[i]), rng)))
        found.append((0, i) in {m[:2] for m in D.matches([draw(90) + changed + draw(90)], fitted)})
    return np.mean(found), fitted


def test_recall_of_long_items_among_short_ones():
    assert recall_of([80] * 60 + [1000] * 2, 1000, 100, 5)[0] >= 0.97


def test_a_class_that_does_not_reach_the_recall_is_checked_exactly(monkeypatch):
    monkeypatch.setattr(D, "LIMIT", 1)
    share, fitted = recall_of([80] * 20 + [400] * 2, 400, 60, 6)
    assert share == 1 and set(fitted.repetitions.values()) == {2}


def test_case_white_space_and_distance(spark, docs_of):
    item = "The quick brown fox jumps over the lazy dog near the old river bank today."
    bench = spark.createDataFrame([(7, item), (8, item), (9, None), (10, "  "), (11, "")], "item_id long, text string")
    rows = [(1, "Start. THE QUICK\n\nbrown fox  jumps over the lazy dog near the old river bank today. End"), (2, item.replace("lazy", "hazy")),
            (3, item[:40]), (None, item), (4, None), (5, ""), (6, item), (6, item), (7, "the the the " * 20_000)]
    out = D.leaks(docs_of(rows, "doc_id long, text string"), bench).collect()
    assert sorted(((r["doc_id"], r["item_id"], r["edits"]) for r in out), key=str) == sorted(
        [(1, 7, 0), (2, 7, 1), (None, 7, 0), (6, 7, 0), (6, 7, 0)], key=str)
    kept = D.without_leaks(docs_of(rows), bench).collect()
    assert sorted((r["doc_id"] for r in kept), key=str) == sorted([3, None, 4, 5, 7], key=str)


def test_short_items_and_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([(1, "é"), (2, "ab"), (3, "abcdefghijkl")], "item_id long, text string")
    out = D.leaks(docs_of([(1, "x é y"), (2, "cab"), (3, "abcdefXhijkl"), (4, "zzz")]), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == {(1, 1), (2, 2), (3, 2), (3, 3)}
    assert D.leaks(docs_of([]), bench).collect() == []
    assert D.leaks(docs_of([(1, "a")]), bench.limit(0)).collect() == []
