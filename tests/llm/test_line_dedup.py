import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from cohortlens.llm.line_dedup import dedup_lines

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute(rows, min_chars, min_docs):
    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars and d is not None:
                holders[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs and d != max(holders[key(x)]))]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in df.collect()), key=str)


def test_against_brute_force(docs_of):
    rng = random.Random(4)
    pool = ["Alpha beta", " alpha BETA\t", "ÄLPHA beta", "älpha beta", "gamma delta", "short", "", "İstanbul line", " alpha beta"]
    rows = [(rng.choice([i, i, i // 2]), "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 9)))) for i in range(60)]
    assert got(dedup_lines(docs_of(rows), 6, 5)) == brute(rows, 6, 5)


def test_odd_texts_nulls_and_repeats(docs_of, odd):
    common = "The same Line that everybody has in common."
    rows = odd + [(20 + i, f"{common}\nown {i}") for i in range(6)] + [(25, f"{common}\nown 5"), (None, common), (None, None)]
    out = dedup_lines(docs_of(rows))
    assert got(out) == brute(rows, 40, 5)
    assert dict(out.where("doc_id >= 20").select("doc_id", "n_dropped").collect()) == {20: 1, 21: 1, 22: 1, 23: 1, 24: 1, 25: 0}


def test_clashing_columns_and_empty_table(spark, docs_of):
    df = docs_of([(1, "a\nb")]).withColumns({c: F.lit("mine") for c in ("n_lines", "_pos", "_h", "_lines", "_drop", "line", "_fp", "_last")})
    out = dedup_lines(df)
    assert out.first()["n_lines"] == 2 and out.first()["line"] == "mine"
    assert dedup_lines(docs_of([])).collect() == []


def test_many_dropped_lines_in_one_text(docs_of):
    lines = [f"a line that is long enough to be counted here {i}" for i in range(3000)]
    rows = [(d, "\n".join(lines)) for d in range(5)]
    out = {r["doc_id"]: r for r in dedup_lines(docs_of(rows)).collect()}
    assert [out[d]["n_dropped"] for d in range(5)] == [3000] * 4 + [0]
    assert hashlib.sha256(out[4]["text"].encode()).hexdigest() == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert out[0]["text"] == ""
