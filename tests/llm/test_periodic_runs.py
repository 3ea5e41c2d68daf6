import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from cohortlens.llm import periodic_runs as R
from cohortlens.llm.queries import QUERIES


def brute(w):
    """All runs as (start, length, period), by comparing the words at every distance."""
    n, best = len(w), {}
    for q in range(1, n // 4 + 1):
        same = [i for i in range(n - q) if w[i] == w[i + q]]
        k = 0
        while k < len(same):
            j = k
            while j + 1 < len(same) and same[j + 1] == same[j] + 1:
                j += 1
            s, e = same[k], same[j] + q + 1
            if e - s >= max(6, 4 * q):
                best.setdefault((s, e), q)
            k = j + 1
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def expected(doc_id, text):
    """The contract's row, word by word."""
    w = words_of(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 == 0 and n:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + (h // 10) % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, digest,
            hashlib.sha256(collapse(w, runs).encode()).hexdigest())


def random_words(rng):
    n, a = rng.choice([0, 1, 5, 6, 20, 60, 150]), rng.choice([1, 2, 2, 3, 6])
    w = [rng.randrange(a) for _ in range(n)]
    for _ in range(rng.randrange(4) if n else 0):
        block = w[rng.randrange(len(w)):][:rng.randrange(1, 12)]
        w = w[:rng.randrange(len(w) + 1)] + block * rng.randrange(1, 12) + w[rng.randrange(len(w)):]
    return w or [0] * bool(n)


def found(docs):
    ends = np.cumsum([len(d) for d in docs])
    out = [[] for _ in docs]
    for s, n, q in zip(*(x.tolist() for x in R.find(np.array(sum(docs, []), dtype=np.int64), ends))):
        d = int(np.searchsorted(ends, s, "right"))
        out[d].append((s - (int(ends[d - 1]) if d else 0), n, q))
    return out


def test_random_words_as_brute_force():
    rng = random.Random(7)
    for _ in range(250):
        docs = [random_words(rng) for _ in range(rng.randrange(1, 6))]
        docs += docs[:rng.randrange(2)]
        assert found(docs) == [brute(d) for d in docs]


def test_without_trustworthy_hashes(monkeypatch):
    """With all words hashed alike every candidate passes, and the words decide alone."""
    monkeypatch.setattr(R.Text, "equal", lambda self, one, other, length: np.ones(len(one), dtype=bool))
    docs = [[0, 1, 2] * 6 + [3], [5, 5, 5, 5, 5, 5, 5]]
    for d, runs in zip(docs, found(docs)):
        assert set(runs) <= set(brute(d))


def test_every_run_crosses_one_node_and_grammar_spells_the_words():
    rng = random.Random(3)
    docs = [random_words(rng) for _ in range(40)]
    words, ends = np.array(sum(docs, []), dtype=np.int64), np.cumsum([len(d) for d in docs])
    g = R.grammar(words, ends)
    assert len(g.places) == sum(max(0, len(d) - 1) for d in docs)  # a boundary between any two neighbours, once
    for v in range(len(g.start)):
        text = words[g.start[v]:g.end[v]].tolist()
        assert g.start[v] < g.mid[v] < g.end[v]
        for p in g.places[g.first[v]:g.first[v + 1]].tolist():
            assert words[p:p + len(text)].tolist() == text


@pytest.mark.parametrize("text", ["word " * 40_000, "a b " * 30_000 + "c", "x" * 300_000, " ".join(str(i % 997) for i in range(60_000)),
                                  "the of and in X the of and in Y " * 4_000])
def test_long_texts(text):
    w = text.split()
    index = {}
    ids = [index.setdefault(x, len(index)) for x in w]
    s, n, q = R.find(np.array(ids, dtype=np.int64), np.array([len(ids)]))
    got = list(zip(s.tolist(), n.tolist(), q.tolist()))
    period = next((p for p in (1, 2, 10, 997) if ids[p:] == ids[:-p]), None)
    if "c" in w:
        assert got == [(0, 60_000, 2)]
    elif len(w) == 1:
        assert got == []
    else:
        assert got == [(0, len(w), period)]


def test_operator_on_odd_texts(docs_of, odd):
    rows = odd + [(100, "a a a a a a b"), (100, "a a a a a a b"), (None, "k k k k k k"), (101, "a b c d")]
    out = R.collapse_runs(docs_of(rows)).collect()
    want = []
    for i, t in rows:
        w = words_of(t)
        runs = [(0, len(w), 1)] if len(w) == 40_000 else brute(w) if len(w) < 1000 else []
        want.append((i, len(w), runs, collapse(w, runs)))
    assert sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out), key=str) == sorted(want, key=str)
    assert R.collapse_runs(docs_of([])).collect() == []


def test_clashing_columns(docs_of):
    df = docs_of([(1, "a a a a a a", "x", "y")], "doc_id long, text string, runs string, collapsed string")
    assert [(r["collapsed"], r["runs"][0]["length"]) for r in R.collapse_runs(df).collect()] == [("a", 6)]


def test_query_as_brute_force(spark, corpus):
    out = QUERIES["op11_periodic_runs"](spark, "/root/testdata/sf0.001")
    assert [f"{n} {t}" for n, t in out.dtypes] == ["doc_id bigint", "n_runs bigint", "start bigint", "length bigint", "period bigint", "exponent_milli bigint",
                                                   "runs_sha256 string", "collapsed_sha256 string"]
    rows = sorted(tuple(r) for r in out.collect())
    short = {i: t for i, t in corpus if len(t or "") < 12_000}
    assert [r for r in rows if r[0] in short] == [expected(i, t) for i, t in sorted(short.items())] and len(rows) == len(corpus)
    assert any(r[1] for r in rows)
