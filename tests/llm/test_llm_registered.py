"""Registered text queries over whole tables against SQL or brute force."""

import hashlib
import zlib
from collections import defaultdict

import brute
import numpy as np
import pandas as pd
import pytest
from compare import compare, connect

import __spark_entry__ as entry
from tidemark.llm import licenses, queries

DIRECTORY = "/root/testdata/sf0.001"
TRAINED = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(DIRECTORY)


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def run(spark, name, directory=DIRECTORY):
    return entry.queries()[name](spark, directory)


def test_one_query_for_each_operator():
    numbers = sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, con, name):
    rows, problems = compare(run(spark, name), con, queries.ORACLES[name])
    assert not problems
    assert rows > 0


def test_op1_against_brute_force(spark, con, docs):
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    got = {r.doc_id: r for r in run(spark, "op1_decontaminate").collect()}
    assert len(got) == len(docs)
    for doc_id, n_words, n_hit, ids in brute.contamination(docs, items):
        row = got[doc_id]
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        assert (row.n_words, row.n_hit, row.n_items, row.items_sha256) == (n_words, n_hit, len(ids), digest)


def test_op2_and_op6_against_the_tokenizer(spark, docs):
    ids = brute.token_ids([t for _, t in docs])
    want, start = [], 0
    for (doc_id, _), x in zip(docs, ids, strict=True):
        want.append((doc_id, start, len(x), brute.crc(x)))
        start += len(x)
    assert sorted(map(tuple, run(spark, "op6_token_files").collect())) == want

    rows = run(spark, "op2_pack").collect()
    pieces = {
        (doc_id, n, at, len(x[at : at + 4096]), brute.crc(x[at : at + 4096]))
        for (doc_id, _), x in zip(docs, ids, strict=True)
        for n, at in enumerate(range(0, len(x), 4096))
    }
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == pieces
    assert len(rows) == len(pieces)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= -(-start // 4096) + 1


def test_op5_base_counts(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op5_quality").collect()}
    for doc_id, text in docs:
        r = got[doc_id]
        want = brute.base_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def test_op9_against_brute_force(spark, docs):
    prints = [brute.fingerprint(t) for _, t in docs]
    group = brute.linked(prints)
    want = [(d, f"{p:016x}", docs[g][0]) for (d, _), p, g in zip(docs, prints, group, strict=True)]
    assert sorted(map(tuple, run(spark, "op9_simhash").collect())) == want


def test_op10_against_brute_force(spark, docs):
    rules = licenses.rules()
    got = {r[0]: tuple(r)[1:] for r in run(spark, "op10_licenses").collect()}
    assert got == {d: brute.license_scan(t, rules) for d, t in docs}


def held_out(con, base, rest):
    return lambda i: zlib.crc32(str(i).encode()) % base == rest


def test_op7_held_out_accuracy(spark):
    got = run(spark, "op7_language", TRAINED).toPandas()
    truth = connect(TRAINED).execute("SELECT doc_id, lang FROM documents").df()
    both = got.merge(truth, on="doc_id")
    assert len(both) == len(truth) == len(got)
    assert (both["held_out"] == both["doc_id"].map(held_out(None, 4, 2))).all()
    assert both["score"].between(0, 1).all()
    part = both[both["held_out"]]
    assert (part["lang_pred"] == part["lang"]).mean() > 0.97


def test_op4_held_out_ranking(spark):
    directory = "/root/testdata/sf0.1"
    got = run(spark, "op4_toxicity", directory).toPandas()
    labels = connect(directory).execute("SELECT doc_id, toxic FROM labels").df()
    assert got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.5)).all()
    both = got[got["held_out"]].merge(labels, on="doc_id")
    rank, toxic = pd.Series(both["score"]).rank().to_numpy(), both["toxic"].to_numpy() == 1
    n = toxic.sum()
    auc = (rank[toxic].sum() - n * (n + 1) / 2) / (n * (~toxic).sum())
    assert auc > 0.93
    assert np.mean((both["score"] >= 0.5) == toxic) > 0.95


def test_op5_keeps_good_and_drops_bad(spark):
    got = run(spark, "op5_quality", TRAINED).toPandas()
    labels = connect(TRAINED).execute("SELECT doc_id, quality FROM labels").df()
    both = got[~got["base_failed"]].merge(labels, on="doc_id")
    assert both[both["quality"] == 1]["kept"].mean() > 0.98
    assert both[both["quality"] == 0]["kept"].mean() < 0.1
