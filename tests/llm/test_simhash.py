import random

import numpy as np
import xxhash

from cohortlens.llm import simhash as S
from cohortlens.llm.components import components


def slow_fingerprint(text, n=3):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ")
             .replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps, bits):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(fps))]


def test_fingerprints(corpus, odd):
    for _, text in corpus[:40] + [o for o in odd if len(o[1] or "") < 1000]:
        assert S.fingerprint(text or "") == slow_fingerprint(text)


def test_groups_against_brute_force(docs_of, corpus, odd):
    rng = random.Random(8)
    rows = [(i, t) for i, t in corpus[:120]] + [(1000 + i, t) for i, t in odd]
    for i, t in corpus[:60]:
        words = t.split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((2000 + i, " ".join(words)))
    ids = [r[0] for r in rows]
    order = np.argsort(ids)
    fps = [S.fingerprint(rows[k][1] or "") for k in order]
    want = {rows[order[i]][0]: rows[order[g]][0] for i, g in enumerate(brute_groups(fps, 3))}
    out = S.near_groups(docs_of(rows)).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == want
    assert {r["doc_id"]: r["fingerprint"] for r in out} == {rows[k][0]: f"{f:016x}" for k, f in zip(order, fps)}


def test_links_of_large_keys(spark):
    """Random fingerprints around a few centres, dealt once and dealt again."""
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(4)]
    fps = sorted({c ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(0, 6))) & (2**64 - 1) for c in centres for _ in range(150)})
    want = brute_groups(fps, 3)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    distinct = spark.createDataFrame([(s,) for s in signed], "fp long")
    for split_over in (4096, 20):
        labels = {r["u"]: r["v"] for r in components(S.fingerprint_links(distinct, 3, split_over)).collect()}
        groups = {}
        for s, g in zip(signed, want):
            groups.setdefault(g, set()).add(labels.get(s, s))
        assert all(len(v) == 1 for v in groups.values()) and len({min(v) for v in groups.values()}) == len(groups)


def test_components_of_a_long_chain(spark):
    n = 200
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(500, 501), (7, 7)], "u long, v long")
    out = dict(components(links).collect())
    assert out == {**{i: 0 for i in range(1, n + 1)}, 501: 500}


def test_null_ids_repeats_and_empty_table(spark, docs_of):
    out = S.near_groups(docs_of([(3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (None, "only here x"), (9, None), (8, "")])).collect()
    by = sorted(((r["doc_id"], r["component_id"]) for r in out), key=str)
    assert by == sorted([(3, 3), (3, 3), (None, 3), (None, None), (9, 8), (8, 8)], key=str)
    assert S.near_groups(docs_of([])).collect() == []
    kept = S.keep_one(docs_of([(3, "a b c d"), (4, "a b c d"), (None, "a b c d")])).collect()
    assert sorted((r["doc_id"] for r in kept), key=str) == [3, None]
