"""The pipeline's stages against brute force on the smallest driver tables, and its registration."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as P
from cohortlens.llm import byte_bpe, decontamination, quality_classifier, simhash
from cohortlens.llm.common import read, staged
from test_line_dedup import brute as brute_lines
from test_simhash import brute_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The documents before the first stage and after each one."""
    docs = read(spark, SF, "documents")
    out = [docs.collect()]
    for _, stage in P.STAGES:
        docs = staged(stage(spark, docs, SF))
        out.append(docs.collect())
    return out


def test_columns_and_stages(steps):
    assert [n for n, _ in P.STAGES] == ["quality classifier", "line dedup", "simhash near-dedup", "benchmark decontamination", "byte-level bpe"]
    assert all(rows[0].__fields__ == steps[0][0].__fields__ for rows in steps[:-1])


def test_rejected_documents_go_and_the_rest_stays(spark, steps):
    scored = quality_classifier.score(read(spark, SF, "documents"), read(spark, SF, "labels")).collect()
    assert sorted(steps[1]) == sorted(r for r in steps[0] if {s["doc_id"]: s["predicted"] for s in scored}[r["doc_id"]] == 1)


def test_frequent_lines_go(steps):
    want = {d: t for d, t, _, _ in brute_lines([(r["doc_id"], r["text"]) for r in steps[1]], 40, 5)}
    assert {r["doc_id"]: r["text"] for r in steps[2]} == want and all(r["n_chars"] == len(r["text"]) for r in steps[2])


def test_one_document_of_each_group_stays(steps):
    rows = sorted(steps[2])
    groups = brute_groups([simhash.fingerprint(r["text"]) for r in rows], 3)
    assert sorted(r["doc_id"] for r in steps[3]) == sorted({rows[g]["doc_id"] for g in groups})


def test_leaks_go_and_the_rest_stays(spark, steps):
    items = [decontamination.normal(r["text"]) for r in read(spark, SF, "benchmark").collect()]
    leaky = {r["doc_id"] for r in steps[3]
             if any(decontamination.edit_match(i, decontamination.normal(r["text"]))[0] <= int(0.1 * len(i)) for i in items)}
    assert leaky and {r["doc_id"] for r in steps[4]} == {r["doc_id"] for r in steps[3]} - leaky


def test_tokens(steps):
    path = public_tokenizers.path(P.VOCABULARY)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(path), special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in steps[4]}
    assert {r["doc_id"] for r in steps[5]} == set(texts)
    for r in steps[5]:
        ids = np.array(library.encode_ordinary(texts[r["doc_id"]]), dtype="<u4").tobytes()
        assert (r["n_tokens"], bytes(r["tokens"]), r["ids_sha256"]) == (len(ids) // 4, ids, hashlib.sha256(ids).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_registered_queries_and_their_oracles(spark):
    import __spark_entry__ as entry
    from oracle_compare import compare, duck

    names = [q for q in entry.queries() if q.startswith("op") or q == "pipeline"]
    assert sorted(int(q[2:].split("_")[0]) for q in names if q != "pipeline") == list(range(1, 14)) and "pipeline" in names
    con = duck(SF)
    for key in ("op2_line_dedup", "op3_chat_format", "op13_nearest_vectors"):
        ok, message = compare(entry.queries()[key](spark, SF), con, entry.oracle_sql()[key])
        assert ok, message


def test_empty_documents_go_through_all_stages(spark):
    docs = read(spark, SF, "documents").limit(0)
    for _, stage in P.STAGES:
        docs = staged(stage(spark, docs, SF))
        assert docs.count() == 0
