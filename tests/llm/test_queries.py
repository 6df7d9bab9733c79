"""Every registered query of the subpackage over whole small tables, against brute force."""

import hashlib
import re
from collections import Counter
from zlib import crc32

import pytest

import __spark_entry__ as E
from tablekit.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.test_operators import brute_components, brute_stats, brute_targets, crc, encoder

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()


def got(spark, prefix):
    name = next(n for n in QUERIES if n.startswith(prefix))
    return QUERIES[name](spark, SF).collect()


def test_one_query_for_each_operator():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES] == list(range(1, 14)) and set(ORACLE_SQL) <= set(QUERIES)


def test_op1(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs]
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got(spark, "op1_")) == brute_components(rows, 4, 85, 100)


def test_op2_and_op5(spark, docs):
    enc, start = encoder(), 0
    ids = {r.doc_id: enc(r.text) for r in docs}
    pieces = got(spark, "op2_")
    assert Counter(r.doc_id for r in pieces) == {i: -(-len(x) // 2048) for i, x in ids.items()}
    assert all(r.ids_crc32 == crc(ids[r.doc_id][r.start:r.start + r.length]) for r in pieces)
    for r in sorted(got(spark, "op5_"), key=lambda r: r.doc_id):
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids[r.doc_id]), crc(ids[r.doc_id]))
        start += r.n_tokens


@pytest.mark.parametrize("prefix,mod,rest", [("op3_", 3, 1), ("op7_", 4, 2), ("op8_", 4, 2)])
def test_learned_queries(spark, docs, prefix, mod, rest):
    rows = got(spark, prefix)
    assert Counter((r.doc_id, r.held_out) for r in rows) == Counter(
        (r.doc_id, crc32(str(r.doc_id).encode()) % mod == rest) for r in docs)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, got(spark, prefix)))


def test_op6(spark, docs):
    sizes, n = Counter(), {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in docs}
    for r in docs:
        sizes[r.source] += n[r.doc_id]
    target, source = brute_targets(sizes), {r.doc_id: r.source for r in docs}
    rows = got(spark, "op6_")
    assert len(rows) == len(docs)
    for r in rows:
        assert r.size == n[r.doc_id] and abs(r.target - target[source[r.doc_id]]) < 1e-6 and r.taken <= 2 * r.size


def test_op9(spark, docs):
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter(tuple(r[c] for c in cols) for r in got(spark, "op9_")) == Counter((r.doc_id, *brute_stats(r.text)) for r in docs)


def test_op10(spark, docs):
    rows = {r.doc_id: r for r in got(spark, "op10_")}
    for k, r in enumerate(docs):
        nxt, h = docs[(k + 1) % len(docs)].text, len(r.text) // 2
        assert rows[r.doc_id].edited_sha256 == hashlib.sha256((r.text[:len(r.text) - h] + nxt[:h]).encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    from tests.oracle_harness import compare, duck_con
    r = compare(spark, duck_con(SF), name, QUERIES[name], E.oracle_sql()[name], SF)
    assert r["ok"], r["problems"]


def test_op13(spark, docs):
    from tests.llm.test_new_operators import brute_scan
    cols = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels"]
    rows = got(spark, "op13_")
    assert Counter(tuple(r[c] for c in cols) for r in rows) == Counter((r.doc_id, *brute_scan(r.text)[:6]) for r in docs)
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in rows)
