import random
import re
import zlib

import numpy as np
import pytest

from cohortlens.llm import quality_classifier as C
from cohortlens.llm import quality_rules as Q
from cohortlens.llm.text_stats import text_stats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_stats(text):
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


def test_statistics_against_brute_force(corpus, odd):
    rng = random.Random(1)
    texts = [t for _, t in corpus[:30]] + [t or "" for _, t in odd if len(t or "") < 1000]
    texts += [" ".join(rng.choice(["a", "b", "c#", "\n", "\x1f", "é|"]) for _ in range(rng.randrange(0, 60))) for _ in range(200)]
    for text in texts:
        assert tuple(text_stats(text)[0][:5]) == brute_stats(text)


def labelled(rng, n):
    """Clean and symbol-ridden texts of random words."""
    rows, marks = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(60, 150))]
        bad = i % 6 == 0
        rows.append((i, " ".join(w + ("###" if bad else "") for w in words)))
        if i % 2 == 0:
            marks.append((i, 0 if bad else 1))
    return rows, marks


def test_rules_and_forest(spark, docs_of, odd):
    rows, marks = labelled(random.Random(2), 300)
    labels = spark.createDataFrame(marks + [(None, 0), (5, None), (9999, 0)], "doc_id long, quality int")
    rows = rows + [(1000 + i, t) for i, t in odd] + [(7, rows[7][1]), (None, rows[8][1])]
    out = Q.judge(docs_of(rows), labels, trees=40).collect()
    assert len(out) == len(rows)
    text = dict(rows)
    for r in out:
        if r["doc_id"] is None or r["doc_id"] < 1000:
            assert not r["base_failed"] and r["kept"] == (r["doc_id"] is None or r["doc_id"] % 6 != 0)
        elif len(text[r["doc_id"]] or "") < 1000:
            stats = brute_stats(text[r["doc_id"]] or "")
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == stats
            assert r["base_failed"] and not r["kept"]


def test_rules_without_labels_or_documents(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r["kept"] for r in Q.judge(docs_of(labelled(random.Random(3), 30)[0]), labels, trees=5).collect())
    assert Q.judge(docs_of([]), labels).collect() == []


def test_labels_are_not_sent_to_the_driver(spark, docs_of, tmp_path, monkeypatch):
    """A label file of a few MB holds millions of rows: whatever its size, no plan collects and broadcasts them."""
    rows, marks = labelled(random.Random(4), 60)
    path = f"{tmp_path}/labels.parquet"
    spark.createDataFrame(marks, "doc_id long, quality int").write.parquet(path)
    plans, staged = [], Q.staged
    monkeypatch.setattr(Q, "staged", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or staged(df))
    out = Q.judge(docs_of(rows), spark.read.parquet(path), trees=10)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert sum("Join" in p for p in plans) == 1 and not any("Broadcast" in p for p in plans)
    assert out.count() == len(rows)


def test_isolated_points_score_higher():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(500, 3))
    scores = Q.anomaly(np.vstack([rows, [[9, 9, 9]]]), Q.fit_forest(rows, 60))
    assert scores[-1] > scores[:-1].max()


def test_labels_decide_below_any_fixed_limit(spark, docs_of):
    """Bad texts of 5 % digits, or of few symbols, differ from clean ones and the labels say so."""
    rng, rows, marks = random.Random(9), [], []
    for i in range(400):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(100)]
        if i % 10 == 0:
            words[::4] = [w + "1" for w in words[::4]]
        elif i % 10 == 1:
            words[::25] = [w + "#" for w in words[::25]]
        rows.append((i, " ".join(words)))
        if i % 3:
            marks.append((i, int(i % 10 > 1)))
    out = Q.judge(docs_of(rows), spark.createDataFrame(marks, "doc_id long, quality int"), trees=70).collect()
    assert all(r["kept"] == (r["doc_id"] % 10 > 1) for r in out) and len({r["anomaly"] for r in out}) > 100


def test_threshold():
    assert Q.threshold([(1, 100, 990), (1, 1500, 2), (0, 1400, 50), (0, 100, 5)], 0.005) == pytest.approx((101 + 1400) // 2 / Q.BINS)
    assert Q.threshold([(1, 100, 10)], 0.005) == 2.0
    assert Q.threshold([], 0.005) == 2.0


def test_factorisation_identity():
    """The linear-time logit equals the sum over all pairs."""
    machine = C.Machine()
    rng = np.random.default_rng(1)
    machine.w[:] = rng.normal(size=machine.w.shape)
    columns, values = rng.choice(C.DIMS, 20, replace=False), rng.normal(size=20).astype(np.float32)
    slow = machine.bias + (machine.w[columns] * values).sum() + sum(
        machine.v[columns[i]] @ machine.v[columns[j]] * values[i] * values[j] for i in range(20) for j in range(i))
    assert machine.logits(columns, values, np.array([0]))[0][0] == pytest.approx(slow, rel=1e-3, abs=1e-3)


def test_held_out_accuracy_and_odd_rows(spark, docs_of, odd):
    rows, marks = labelled(random.Random(5), 600)
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    rows = rows + [(1000 + i, t) for i, t in odd] + [(None, "a b"), (3, rows[3][1])]
    out = C.score(docs_of(rows), labels).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    tested = [r for r in out if r["held_out"] and r["doc_id"] < 600]
    assert np.mean([r["predicted"] == int(r["doc_id"] % 6 != 0) for r in tested]) > 0.97


def test_labels_of_the_held_out_part_do_not_matter(spark, docs_of):
    rows, marks = labelled(random.Random(6), 200)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q) for i, q in marks]
    scores = [sorted((r["doc_id"], r["score"]) for r in C.score(docs_of(rows), spark.createDataFrame(m, "doc_id long, quality int")).collect()) for m in (marks, turned)]
    assert scores[0] == scores[1]


def test_samples_of_tiny_shares_and_one_row_a_document(spark, docs_of):
    from cohortlens.llm.common import sampled

    n = spark.range(4_000_000).where(sampled(5e-7 * 10, "id")).count()
    assert 5 <= n <= 50
    assert spark.range(1).select(sampled(1e-12, "id").alias("s")).schema["s"].dataType.typeName() == "boolean"
    assert spark.range(40_000_000).where(sampled(5e-7, "id")).count() > 0  # 2^20 steps have no such share
    docs = docs_of([(7, "a b c")] * 50 + [(8, "d e f")])
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, quality int")
    rows, y = C.training_rows(docs, labels, "doc_id", 100)
    assert len(rows) == len(y) == 2


def test_no_training_rows_clashes_and_empty_table(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    df = docs_of([(1, "a b c", "en", 5.0)], "doc_id long, text string, lang string, score double")
    row = C.score(df, labels).first()
    assert row["score"] == 0.5 and row["lang"] == "en"
    assert C.score(docs_of([]), labels).collect() == []
