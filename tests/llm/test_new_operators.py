"""Collocations, manifest and license scan against brute force and on odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import DOCS, no_docs, odd_docs, prose  # noqa: F401 (fixtures)


# ---------------------------------------------------------------- collocations

def brute_collocations(rows, least, share, best):
    """rows (lang, text) -> {(lang, rank, phrase, a, l, r, n, score)}"""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang, text = lang if lang is not None else "und", (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out, by = set(), {}
    for (lang, p), a in cand.items():
        if any(100 * b >= share * a for (g, q), b in cand.items() if g == lang and len(q) > len(p)
               and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
            continue
        score, k = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        by.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    for lang, c in by.items():
        for rank, (s, a, p, left, right) in enumerate(sorted(c)[:best], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return out


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("tile,block", [(512, 1 << 21), (4, 300)])
def test_collocations(spark, odd_docs, no_docs, monkeypatch, tile, block):  # noqa: F811
    """Ties, repeated rows, overlaps, and a hot phrase; small blocks and tiles, dense and sparse."""
    from tablekit.llm import collocations as C
    monkeypatch.setattr(C, "TILE", tile)
    monkeypatch.setattr(C, "BLOCK_TOKENS", block)
    rng = random.Random(21)
    extra = [(1000 + i, " ".join(rng.choice(["Ab", "cd", "ef.", "gh", "a a a", "\u00e9\u00df", "x,y", "\ty"]) for _ in range(60)),
              rng.choice(["en", None, "und", "de"]), "s", 0) for i in range(60)]
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars", "score").unionByName(
        spark.createDataFrame(extra, DOCS).withColumn("score", F.lit("x"))).repartition(3)
    want = brute_collocations([(r.lang, r.text) for r in docs.collect()], 4, 50, 30)
    assert found(C.collocations(docs, least=4, best=30)) == want and len(want) > 60
    assert C.collocations(no_docs).count() == 0
    assert C.collocations(odd_docs.filter("doc_id = 7")).count() == 0       # words, but no candidate


def test_tiles_count_like_a_dictionary():
    from tablekit.llm.collocations import TILE, _pack, _unpack, tile_counts
    rng = np.random.default_rng(3)
    left = np.concatenate([rng.integers(0, 40, 60_000), rng.integers(0, 5 * TILE, 30_000), [2**31 + 5] * 7, [0]])
    right = np.concatenate([rng.integers(0, 400, 60_000), rng.integers(0, 5 * TILE, 30_000), [2**31 + 9] * 7, [2**31]])
    got = {(a, b): n for a, b, n in zip(*[x.tolist() for x in tile_counts(left, right)])}
    assert got == Counter(zip(left.tolist(), right.tolist()))
    assert all(len(x) == 0 for x in tile_counts(left[:0], right[:0]))
    for values in (left, left[:0], np.array([0]), np.array([2**62])):
        assert _unpack(_pack(values)).tolist() == values.tolist()


def test_scores_are_exact(spark):
    from tablekit.llm.collocations import _score
    rng = random.Random(5)
    rows = [(a, a + rng.randrange(10**k), a + rng.randrange(10**k)) for k in range(1, 15) for a in [rng.randrange(10, 10**k + 10)]]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    assert [r.s for r in df.select(F.expr(_score("a", "l", "r")).alias("s")).collect()] == [10**6 * a * a // (l * r) for a, l, r in rows]


# ---------------------------------------------------------------- manifest

def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_manifest(rows):
    """rows (doc_id, source, lang, n_chars, text) -> Counter of op12's rows."""
    def leaf(r):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def grow(level):
        levels = [level]
        while len(level) > 1:
            level = [sha("".join(level[i:i + 2])) for i in range(0, len(level), 2)]
            levels.append(level)
        return levels

    def path(levels, i):
        out = []
        for level in levels[:-1]:
            out.append((i & 1, level[i ^ 1] if i ^ 1 < len(level) else None))
            i >>= 1
        return out

    def key(v):
        return (v is not None, v.encode() if isinstance(v, str) else v or 0)
    trees = {}
    for r in sorted(rows, key=lambda r: (key(r[2]), key(r[0]), leaf(r))):
        trees.setdefault(r[2], []).append(r)
    grown = [grow([leaf(r) for r in own]) for own in trees.values()]
    top = grow([g[-1][0] for g in grown])
    out = Counter()
    for k, (g, own) in enumerate(zip(grown, trees.values())):
        for i, r in enumerate(own):
            steps = path(g, i) + path(top, k)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            cur = leaf((*r[:3], r[3] + 1, r[4])) if bad else leaf(r)
            for odd, sib in steps:
                cur = sha(cur if sib is None else sib + cur if odd else cur + sib)
            root = top[-1][0]
            out[r[0], leaf(r), g[-1][0], root, sha("".join(s for _, s in steps if s)), cur, cur == root] += 1
    return out


def op12(spark, monkeypatch, docs):
    from tablekit.llm import manifest as M
    monkeypatch.setattr(M, "table", lambda *_: docs)
    return Counter(tuple(r) for r in M.op12_merkle_manifest(spark, "").collect())


def fields(docs):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]


def test_manifest_edges(spark, odd_docs, no_docs, monkeypatch):  # noqa: F811
    assert op12(spark, monkeypatch, no_docs) == Counter()
    for cond in ("doc_id = 1", "lang = 'en'", "true"):
        docs = odd_docs.filter(cond)
        assert op12(spark, monkeypatch, docs) == brute_manifest(fields(docs))


def test_manifest_of_many_rounds(spark, monkeypatch):
    """Several records deep, one row standing there hundreds of times, a language of one row."""
    from tablekit.llm import manifest as M
    rows = [(i, f"t{i}", "en" if i % 3 else "de", "s", i % 9 or None) for i in range(700)]
    rows += [(5, "same", "en", "s", 1)] * 300 + [(1, "x", None, "s", 1), (2, "y", "z\u00e9", None, None)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    assert op12(spark, monkeypatch, docs) == brute_manifest(fields(docs))
    leaves = docs.select(M.tree_name().alias("tree"), "doc_id", M.leaf_digest().alias("leaf"))
    m = M.build_manifest(leaves)
    assert m.records.count() == m.records.select("digest").distinct().count()
    some = M.proofs(m, m.leaves.filter("doc_id % 50 = 0")).select("*", M.folded("leaf").alias("to")).collect()
    assert len(some) == 14 and {r.to for r in some} == {m.root}


def test_manifest_of_equal_blocks(spark):
    """Equal blocks are one record, and every proof through it still holds."""
    from tablekit.llm import manifest as M
    docs = spark.range(1024).select(F.lit(1).cast("long").alias("doc_id"), F.lit("a").alias("source"), F.lit("en").alias("lang"),
                                    F.lit(1).alias("n_chars"), F.lit("same").alias("text"))
    m = M.build_manifest(docs.select(M.tree_name().alias("tree"), "doc_id", M.leaf_digest().alias("leaf")))
    assert m.records.count() == 2
    assert M.proofs(m, m.leaves).filter(M.folded("leaf") == m.root).count() == 1024


def test_manifest_ranks_and_sizes(spark):
    """Ranks run from 0 in every tree, and each row knows its tree's size, however the ranges split the trees."""
    from tablekit.llm import manifest as M
    rows = [("1a", i % 5 or None, "x") for i in range(90)] + [("0", None, "y"), ("1b", 2, "z"), ("1b", 1, "z")]
    ranked = M._ranked(spark.createDataFrame(rows, "tree string, doc_id long, leaf string").repartition(6), ["doc_id"], ["leaf"])
    assert ranked.columns == ["tree", "doc_id", "leaf", "n", "rank"]
    got = {t: [] for t in ("0", "1a", "1b")}
    for r in ranked.orderBy("tree", "rank").collect():
        got[r.tree].append((r["rank"], r.n, r.doc_id))
    assert {t: [x[:2] for x in v] for t, v in got.items()} == {
        t: [(i, n) for i in range(n)] for t, n in (("0", 1), ("1a", 90), ("1b", 2))}
    assert all([x[2] or 0 for x in v] == sorted(x[2] or 0 for x in v) for v in got.values())


# ---------------------------------------------------------------- license scan

def brute_scan(text):
    """(n_words, n_base, first, last, base labels, labels, detections), every rule tried on its own."""
    from tablekit.llm.license_rules import BASE_PHRASES, rules
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    base = [(i, label) for p, label in BASE_PHRASES.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    line = (" " + " ".join(words) + " ").encode() if words else b""
    raw = []
    for r in rules():
        if r.keyword in line:
            raw += [(r.priority, -(m.end() - m.start()), r.order, line[:m.start()].count(b" ") - 1, line[:m.end()].count(b" "), r.label)
                    for m in r.pattern.finditer(line)]
    kept = []
    for p, _, order, s, e, label in sorted(raw, key=lambda d: (d[0], -(d[4] - d[3]), d[2], d[3])):
        if not any(a <= s and e <= b for a, b, _ in kept):
            kept.append((s, e, label))
    at = [i for i, _ in base]
    return (len(words), len(base), min(at, default=None), max(at, default=None), ",".join(sorted({b for _, b in base})),
            ",".join(sorted({b for _, b in base} | {label for _, _, label in kept})), sorted(kept))


LINES = ["licensed under the Apache License, Version 2.0", "MIT License", "CC BY-SA 4.0", "cc by", "All rights reserved.",
         "SPDX-License-Identifier: GPL-2.0-or-later", "the GNU General Public License, version 3", "GPLv2 or later",
         "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
         "documentation files", "\u00a9 2020 X", "Tous droits r\u00e9serv\u00e9s", "for personal use only", "BSD 3-Clause License",
         "https://creativecommons.org/licenses/by-nc/4.0/", "general public", "license", "word", "Rights RESERVED", "\u00e9"]


def test_scan_of_mixed_lines():
    from tablekit.llm.license_scan import scan_text
    rng = random.Random(6)
    hit = set()
    for k in range(1500):
        text = rng.choice([" ", "\n", "--", "."]).join(rng.choice(LINES) for _ in range(rng.randint(0, 8)))
        n, base, got = scan_text(text.encode())
        want = brute_scan(text)
        assert (n, len(base), sorted((s, e, label) for label, _, s, e in got)) == (want[0], want[1], want[6]), text
        hit |= {d[0] for d in got}
    assert hit >= {"apache-2.0", "mit", "cc-by-sa-4.0", "gpl-2.0-or-later", "gpl-3.0", "bsd-3-clause", "cc-by-nc", "reserved"}


def test_every_rule_can_be_reached():
    """A rule's keyword stands in what it matches: no rule is hidden by its own gate."""
    from tablekit.llm.license_rules import CONFIDENCE, rules
    all_rules = rules()
    assert len(all_rules) > 300 and {r.priority for r in all_rules} == set(CONFIDENCE)
    assert [r.order for r in all_rules] == list(range(len(all_rules)))
    for line in ("spdx license identifier mit", "apache license 2 0", "gplv3", "cc by nc sa 4 0", "mit license"):
        assert any(r.keyword in line.encode() and r.pattern.search(f" {line} ".encode()) for r in all_rules), line


def test_resolution_by_priority_length_and_order():
    from tablekit.llm.license_scan import resolved
    assert resolved([(2, 5, 0, 4, "long"), (1, 9, 1, 3, "sure"), (2, 4, 0, 4, "first"), (2, 1, 2, 4, "inner"), (3, 0, 3, 9, "other")]) == [
        ("first", 2, 0, 4), ("sure", 1, 1, 3), ("other", 3, 3, 9)]
    assert resolved([]) == []


def test_scan_edges(spark, odd_docs, no_docs, monkeypatch):  # noqa: F811
    from tablekit.llm import license_scan as S
    long = ("word " * 50_000 + "cc by\n") * 4
    docs = odd_docs.select("doc_id", "text", F.lit("clash").alias("n_words"), F.lit(1).alias("found")).union(
        spark.createDataFrame([(900, long, "x", 1), (901, "CC BY cc\tBY", "x", 1)], "doc_id long, text string, n_words string, found int"))
    monkeypatch.setattr(S, "table", lambda *_: docs)
    cols = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels"]
    got = Counter(tuple(r[c] for c in cols) for r in S.op13_license_scans(spark, "").collect())
    assert got == Counter((r.doc_id, *brute_scan(r.text)[:6]) for r in docs.collect())
    monkeypatch.setattr(S, "table", lambda *_: no_docs)
    assert S.op13_license_scans(spark, "").count() == 0
