"""The training-data operators against brute force, round trips and edge cases."""

import hashlib
import math
import random
import re
import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, stem=""):
    parts = ["the", "of", "and", "in", "er", "an", "th", "ti", "on", "re", "nd", "st"]
    return " ".join(stem + "".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def odd_docs(spark):
    """NULLs in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    rng = random.Random(4)
    base = prose(rng, 120)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    rows = [(1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, near, "en", None),
            (None, base.upper(), None, "b"), (None, None, None, None), (4, None, "en", "a"), (5, "", "en", "b"),
            (6, " \n\t ", None, "b"), (7, "one two", "en", "a"), (8, "One\nTWO", "en", "b"),
            (9, "12 34 !!", "en", "a"), (10, "x" * 70_000, "en", "a"), (11, prose(rng, 30_000), "en", "c"),
            (12, "é　ß<|endoftext|>   a\xa0 b.c's don't  \n\n x", "fr", "c"), (2, "another text for id two", "en", "a")]
    rows += [(100 + i, prose(rng, rng.randint(55, 90)), "en" if i % 2 else "de", f"s{i % 3}") for i in range(40)]
    return spark.createDataFrame([(i, t, g, s, len(t or "")) for i, t, g, s in rows], DOCS) \
        .withColumn("score", F.lit("x")).withColumn("n", F.lit(1)).withColumn("size", F.lit(None).cast("int")).cache()


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def brute_components(rows, n, num, den):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append(frozenset(zip(*[w[k:] for k in range(n)])) if len(w) >= n else frozenset([tuple(w)] if w else []))
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            c = len(a & sets[j])
            if c and den * c >= num * (len(a) + len(sets[j]) - c):
                up[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[find(i)] = min(best.get(find(i), d), d)
    return Counter((d, len(s), best.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def got_components(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_join_edges(odd_docs, no_docs):
    from tablekit.llm.ngram_join import jaccard_components
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert got_components(jaccard_components(odd_docs)) == brute_components(rows, 4, 85, 100)
    assert jaccard_components(no_docs).count() == 0


def test_join_of_many_near_copies(spark):
    """Groups larger than a tree and a cell, chains, and a passage that all documents share."""
    from tablekit.llm import ngram_join
    rng = random.Random(8)
    passage = prose(rng, 20, "p")
    rows = []
    for g in range(3):
        words = (passage + " " + prose(rng, 60, f"g{g}")).split()
        for k in range(120):
            w = list(words)
            w[rng.randrange(len(w))] = f"new{k}"
            rows.append((len(rows), " ".join(w)))
    chain = prose(rng, 80, "c").split()
    for k in range(30):                                # each close to the one before only
        chain = chain[2:] + prose(rng, 2, "d").split()
        rows.append((len(rows), " ".join(chain)))
    rows += [(len(rows) + i, passage + " " + prose(rng, 40, f"o{i}")) for i in range(40)]
    rng.shuffle(rows)
    old = ngram_join.TREE, ngram_join.CELL
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_components(rows, 4, 85, 100)
    assert got_components(ngram_join.jaccard_components(df)) == want
    try:                                               # the exact completion alone, in small cells
        ngram_join.CELL = 16
        whole = ngram_join.near_links
        ngram_join.near_links = lambda reps, by, num, den: reps.select(F.col("rep").alias("a"), F.col("rep").alias("b"))
        assert got_components(ngram_join.jaccard_components(df)) == want
    finally:
        ngram_join.TREE, ngram_join.CELL = old
        ngram_join.near_links = whole


def test_one_of_each(odd_docs, no_docs):
    from tablekit.llm.ngram_join import one_of_each
    kept = one_of_each(odd_docs, 5, 80, 100)
    assert kept.columns == odd_docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and 3 not in ids and ids[2] == 1      # of id 2 only its other text stays
    assert ids[10] == ids[11] == ids[100] == 1
    assert one_of_each(no_docs).count() == 0


def test_dual_traversal_keeps_all_links():
    from tablekit.llm.ngram_join import _signature, candidate_pairs, linked
    rng = np.random.default_rng(2)
    base = [rng.integers(0, 1 << 63, s).astype(np.uint64) for s in (40, 60, 300)]
    sets = []
    for k in range(150):
        own = base[k % 3].copy()
        at = rng.permutation(len(own))[:rng.integers(0, len(own) // 5)]
        own[at] = rng.integers(0, 1 << 63, len(at)).astype(np.uint64)
        sets.append(np.unique(own))
    size = np.array([len(s) for s in sets])
    i, j = candidate_pairs([_signature(s, len(s)) for s in sets], size, size, np.arange(len(sets)), 85, 100)
    found = {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())}
    want = {(a, b) for b in range(len(sets)) for a in range(b)
            if linked(sets[a], sets[b], size[a], size[b], 85, 100)}
    assert want <= found and len(found) < len(sets) * len(sets) // 4


def encoder():
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda s: t.encode(s or "", add_special_tokens=False).ids + [0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing(odd_docs, no_docs):
    from tablekit.llm.packing import pack_documents
    enc = encoder()
    rows = pack_documents(odd_docs).collect()
    want = Counter()
    for r in odd_docs.select("doc_id", "text").collect():
        ids = enc(r.text)
        first = (len(ids) - 1) % 2048 + 1
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        want.update((r.doc_id, k, s, e - s, crc(ids[s:e])) for k, (s, e) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(x for _, x in own[:k]) for k in range(len(own))]
        assert sum(x for _, x in own) <= 2048
    assert len(bins) <= -(-sum(r.length for r in rows) // 2048) + 1
    assert pack_documents(no_docs).count() == 0


def test_packing_rounds(spark):
    """Many cells: what they leave open is pooled; hot equal rows spread over cells."""
    from tablekit.llm.packing import best_fit, local_search, pack
    rng = random.Random(3)
    rows = [(1, rng.choice([700, 701, 650, 30, 999, 1333])) for _ in range(3000)]
    out = pack(spark.createDataFrame(rows, "doc_id long, length long").repartition(6), 2048, 300).collect()
    assert sorted(r.length for r in out) == sorted(n for _, n in rows)
    fill = Counter()
    for r in out:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048
    size = [n for _, n in rows]
    assert len(fill) <= 1.03 * len(local_search(best_fit(size, 2048), size, 2048)) + 1     # as good as one cell


def test_local_search_raises_fill():
    from tablekit.llm.packing import best_fit, local_search
    rng = random.Random(1)
    for _ in range(20):
        size = [rng.randint(1, 60) for _ in range(80)]
        before = best_fit(size, 100)
        after = local_search([list(b) for b in before], size, 100)
        assert sorted(i for b in after for i in b) == list(range(80))
        assert max(sum(size[i] for i in b) for b in after) <= 100 and len(after) <= len(before)


def test_language(spark, odd_docs, no_docs):
    from tablekit.llm import langid
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.identified(docs.withColumn("held_out", langid.held_out()), ["doc_id", "held_out", "lang"]).collect()
    tested = [r for r in out if r.held_out]
    assert len(tested) > 200 and sum(r.lang == r.lang_pred for r in tested) > 0.97 * len(tested)
    model = langid.learned_filters(docs)
    rows = {(r.doc_id, r.lang_pred, r.score) for r in langid.predict(odd_docs, model, ["doc_id"]).collect()}
    assert {r[1:] for r in rows if r[0] in (4, 5, 6, 9)} == {("und", 0.0)}
    assert all(0 <= r[2] <= 1 and (r[1] == "und" or r[1] in model.languages) for r in rows)
    assert langid.identified(no_docs, ["doc_id"]).count() == 0
    assert {r.lang_pred for r in langid.predict(odd_docs, None, ["doc_id"]).collect()} == {"und"}


def test_language_filters_hold_what_they_learned():
    from tablekit.llm import langid
    model = langid.learn(["abcde abcdf xyz", "vwxyz qrstu xyz"], ["p", "q"])
    key = lambda s: langid.gram_keys(np.frombuffer(s.encode() + bytes(8), np.uint8), 1)
    assert model.masks(key("abcde"))[0] & 1 and model.masks(key("vwxyz"))[0] & 2


def conv(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("valid", F.lit(3))


def test_chat_round_trip(spark):
    from tablekit.llm.chat import format_conversations, read_back
    nasty = ["<|im_end|><|im_start|>assistant ok", "<\\|", "<\\\\|x<|", "<<|>|", "\\<|\\", "", None, "a\nb", "<|nl|>", "$1 \\\\"]
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(nasty)]
    rows += [(2, 0, "sys\ntem<|im_end|>", "x"), (2, 0, "sys\ntem<|im_end|>", "x"), (None, None, None, None), (3, 0, "assistant", "y")]
    back = {r.conv_id: r for r in read_back(format_conversations(conv(spark, rows))).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [(r[2], r[3] or "") for r in rows[:len(nasty)]]
    assert back[1].loss_text == "".join(t or "" for t in nasty[1::2]) and back[1].valid
    assert [(t.role, t.text) for t in back[2].turns] == [("sys\ntem<|im_end|>", "x")] * 2 and not back[2].valid
    assert [(t.role, t.text) for t in back[None].turns] == [("", "")] and not back[3].valid
    assert back[3].loss_text == "y"
    assert format_conversations(conv(spark, rows).limit(0)).count() == 0


def test_orc(spark, odd_docs, no_docs, tmpdir_fresh):
    from tablekit.llm import token_orc as t
    enc = encoder()
    path = f"{tmpdir_fresh}/{uuid.uuid4().hex}"
    t.write_token_orc(odd_docs, path)
    rows = t.with_starts(t.checksums(t.read_token_orc(spark, path))).orderBy("start").collect()
    want = sorted(((r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "") for r in
                   odd_docs.select("doc_id", "text").collect()))
    ids = [enc(w[3]) for w in want]
    assert [r.doc_id for r in rows] == [w[1] if w[0] else None for w in want]
    assert [(r.n_tokens, r.ids_crc32) for r in rows] == [(len(i), crc(i)) for i in ids]
    assert [r.start for r in rows] == np.cumsum([0] + [len(i) for i in ids])[:-1].tolist()
    assert t.lookup_tokens(spark, path, 7).first().ids == enc("one two")
    assert t.read_token_orc(spark, path, 100, 109).count() == 10
    plan = t.lookup_tokens(spark, path, 7)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,7)" in plan
    empty = f"{tmpdir_fresh}/{uuid.uuid4().hex}"
    t.write_token_orc(no_docs, empty)
    assert t.read_token_orc(spark, empty).count() == 0


def brute_targets(sizes, weights=(3, 1, 2), share=1.5):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    rest, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = rest / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * level >= 2 * sizes[s]}
        if not over:
            return target | {s: w[s] * level for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            rest -= target[s]
        open_ -= over
    return target


def test_mixing(spark, odd_docs, no_docs):
    from tablekit.llm.mixing import mix, mixed_documents
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for df, near in ((docs, 0.1), (odd_docs, None)):
        rows = mix(df).collect()
        want = Counter((r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in df.select("doc_id", "source", "text").collect())
        assert Counter((r.doc_id, r.source, r.size) for r in rows) == want
        sizes = Counter()
        for (_, s, n), k in want.items():
            sizes[s] += n * k
        target, taken = brute_targets(sizes), Counter()
        for r in rows:
            assert math.isclose(r.target, target[r.source], rel_tol=1e-9, abs_tol=1e-6)
            assert 0 <= r.copies <= 2 and r.source_size == sizes[r.source]
            taken[r.source] += r.copies * r.size
        biggest = Counter()
        for r in rows:
            biggest[r.source] = max(biggest[r.source], r.size)
        for s in sizes:
            assert abs(taken[s] - target[s]) <= max(biggest.values()) if near is None else abs(taken[s] / target[s] - 1) <= near
        assert sorted(map(str, rows)) == sorted(map(str, mix(df).collect()))
    out = mixed_documents(odd_docs)
    assert out.columns == odd_docs.columns
    total = Counter((r.doc_id, r.text) for r in out.select("doc_id", "text").collect())
    copies = Counter()
    for r in mix(odd_docs).collect():
        copies[(r.doc_id, r.row_key)] += r.copies
    assert sum(total.values()) == sum(copies.values())
    assert mix(no_docs).count() == 0 and mixed_documents(no_docs).count() == 0


def test_mixing_spreads_a_hot_source(spark):
    from tablekit.llm.mixing import mix
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 17).cast("int")).alias("text"),
                                  F.when(F.col("id") % 10 < 8, "hot").otherwise("cold").alias("source"))
    got = {r.source: (r.k, r.t) for r in mix(df).groupBy("source").agg(
        F.sum(F.col("copies") * F.col("size")).alias("k"), F.first("target").alias("t")).collect()}
    assert all(abs(k / t - 1) < 0.01 for k, t in got.values())


def test_toxicity(spark, odd_docs, no_docs):
    from tablekit.llm import toxicity
    rng = random.Random(6)
    rows, marks = [], []
    for i in range(700):
        words = prose(rng, rng.randint(20, 120)).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["scum", "vequ" + prose(rng, 1)]))
        rows.append((i, " ".join(words), "en", "a", 0))
        marks.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, DOCS).withColumn("held_out", toxicity.held_out())
    labels = spark.createDataFrame(marks + [(None, None, None), (3, None, None)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity_scores(docs, labels, ["doc_id", "held_out"]).collect()
    tested = [r for r in out if r.held_out]
    assert len(tested) > 100
    assert sum((r.score >= 0.3) == (r.doc_id % 4 == 0) for r in tested) > 0.93 * len(tested)
    odd = toxicity.scored(odd_docs, toxicity.train(*toxicity.labelled_sample(docs, labels)), odd_docs.columns, "__s").collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["__s"] <= 1 for r in odd)
    assert {r["__s"] for r in odd if r.doc_id in (4, 5, 6, 9)} == {0.0}
    assert {r.score for r in toxicity.toxicity_scores(odd_docs, labels.limit(0), ["doc_id"]).collect()} == {0.0}
    assert toxicity.toxicity_scores(no_docs, labels, ["doc_id"]).count() == 0


def test_network_gradients():
    from tablekit.llm.toxicity import EMBED, HIDDEN, ATTEND, Network
    rng = np.random.default_rng(0)
    draw = lambda *s: (rng.standard_normal(s) * 0.4).astype(np.float64)
    net = Network(draw(2, EMBED), draw(2, EMBED), draw(2, 2 * EMBED, 3 * HIDDEN), draw(2, HIDDEN, 3 * HIDDEN),
                  draw(2, 3 * HIDDEN), draw(2 * HIDDEN, ATTEND), draw(ATTEND), draw(2 * HIDDEN), draw(1))
    x, first, length = draw(12, 2 * EMBED), np.array([0, 5]), np.array([5, 7])
    loss = lambda: float(net.forward(x, first, length)[0].sum())
    _, cache = net.forward(x, first, length, keep=True)
    grads, dx = net.backward(cache, np.ones(2), x.shape, first)
    for name, g in [*grads.items(), ("x", dx)]:
        p = x if name == "x" else getattr(net, name)
        at = tuple(rng.integers(0, s) for s in p.shape)
        keep, step = p[at], 1e-2
        p[at] = keep + step
        up = loss()
        p[at] = keep - step
        down = loss()
        p[at] = keep
        assert abs((up - down) / (2 * step) - g[at]) < 2e-3 + 0.02 * abs(g[at]), name


def test_quality(spark, odd_docs, no_docs):
    from tablekit.llm import rule_ensemble as q
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held_out", q.held_out())
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    out = [r for r in q.quality_scores(docs, labels, ["doc_id", "held_out"]).collect() if r.held_out and r.doc_id in truth]
    assert len(out) > 60 and sum((r.score >= 0.7) == (truth[r.doc_id] == 1) for r in out) > 0.9 * len(out)
    odd = q.quality_scores(odd_docs, labels, ["doc_id"]).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert {r.score for r in q.quality_scores(odd_docs, labels.limit(0), ["doc_id"]).collect()} == {0.0}
    assert q.quality_scores(no_docs, labels, ["doc_id"]).count() == 0


def test_rules_compile_to_columns(spark):
    from tablekit.llm import rule_ensemble as q
    rng = np.random.default_rng(1)
    x = rng.random((400, len(q.STATS)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] <= 0.6)).astype(float)
    model = q.fit(x, y)
    assert ((model.logits(x) > 0) == (y == 1)).mean() > 0.95
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{s} double" for s in q.STATS))
    assert np.allclose(sorted(r.z for r in df.select(model.logit().alias("z")).collect()), sorted(model.logits(x)))


def brute_stats(text):
    w = WORD.findall(text or "")
    tri = Counter(zip(w, w[1:], w[2:]))
    cov = {j + k for j in range(len(w) - 2) if tri[tuple(w[j:j + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cov),
            len(w) < 50 or 100 * len(cov) > 50 * len(w))


def test_outlier_statistics(spark, odd_docs, no_docs):
    from tablekit.llm.outliers import base_statistics, judged, transformed
    extra = spark.createDataFrame([(900, "a b c a b c a b c\nx\nx\n \n\nx", "en", "a", 1), (901, "a a a a", "en", "a", 1),
                                   (902, "a a a", None, None, 1), (903, "\n\n", "en", "a", 1)], DOCS)
    docs = odd_docs.select(extra.columns).union(extra)
    want = Counter((r.doc_id, *brute_stats(r.text)) for r in docs.collect())
    stats = transformed(base_statistics(docs))
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = judged(stats).collect()
    assert Counter(tuple(r[c] for c in cols) for r in rows) == want
    assert not any(r.kept and r.base_failed for r in rows)
    assert judged(transformed(base_statistics(no_docs))).count() == 0


def test_outlier_verdicts(spark):
    """The estimate equals a numpy one from the same starts; junk goes, ordinary rows stay."""
    from tablekit.llm import outliers as o
    rng = np.random.default_rng(5)
    d, names, floors = len(o.VECTOR), list(o.VECTOR), np.array(list(o.VECTOR.values()))
    x = rng.standard_normal((500, d)) @ np.diag([1, 0.3, 0.2, 0.1, 0.1]) + [6, 1.5, 0, 0, 0.1]
    x[:40] += np.array([0, 2.5, 9, 0, 0])
    df = spark.createDataFrame([(i, "en", "a", False, *map(float, r)) for i, r in enumerate(x)],
                               "doc_id long, lang string, source string, base_failed boolean, " + ", ".join(f"{n} double" for n in names))
    # the percentile of Spark: the smallest value with at least that share of rows at or below it
    pick = lambda v, p: np.sort(v)[max(0, math.ceil(p * len(v)) - 1)]
    m = np.array([pick(x[:, i], 0.5) for i in range(d)])
    s = np.maximum(1.4826 * np.array([pick(np.abs(x[:, i] - m[i]), 0.5) for i in range(d)]), floors)
    u = (x - m) / s

    def scaled(scatter):
        r = o.SHRINK * scatter / np.sqrt(np.outer(np.diag(scatter), np.diag(scatter)))
        np.fill_diagonal(r, 1)
        return r * np.outer(s, s)

    def step(m, cov):
        dist = np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(cov), x - m)
        own = x[dist <= pick(dist, o.SUPPORT)]
        return own.mean(axis=0), np.cov(own.T, bias=True) * o.consistency(d) + np.diag(floors ** 2)

    signs = u / np.linalg.norm(u, axis=1)[:, None]
    found = []
    for cov in (np.diag(s ** 2), scaled(np.cov(np.tanh(u).T, bias=True)), scaled(signs.T @ signs / len(u))):
        now = (m, cov)
        for _ in range(o.FIRST_STEPS):
            now = step(*now)
        found.append(now)
    best = min(found, key=lambda e: np.linalg.det(e[1]))
    while np.log(np.linalg.det((moved := step(*best))[1])) < np.log(np.linalg.det(best[1])) - o.STILL:
        best = moved
    m, cov = best
    dist = np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(cov), x - m)
    rows = sorted(o.judged(df).collect(), key=lambda r: r.doc_id)
    assert np.allclose([r.distance for r in rows], dist, rtol=1e-6)
    assert not any(r.kept for r in rows[:40]) and sum(r.kept for r in rows[40:]) >= 455


def test_chi_squared():
    from tablekit.llm.outliers import chi2_cdf, chi2_quantile
    assert abs(chi2_cdf(3.0, 2) - (1 - math.exp(-1.5))) < 1e-12
    assert abs(chi2_quantile(0.95, 4) - 9.487729) < 1e-5


def test_native_queries_use_no_python(spark):
    from tablekit.llm.chat import op4_chat_formatting
    from tablekit.llm.outliers import base_statistics, transformed
    for df in (op4_chat_formatting(spark, SF), transformed(base_statistics(spark.read.parquet(f"{SF}/documents.parquet")))):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_fingerprints(spark, odd_docs, no_docs):
    from tablekit.llm import fingerprint as f
    rows = f.edited_pairs(odd_docs).collect()
    want = sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in odd_docs.select("doc_id", "text").collect())
    expect = Counter()
    for k, (known, i, t) in enumerate(want):
        nxt, h = want[(k + 1) % len(want)][2], len(t) // 2
        expect[(i if known else None, len(t), hashlib.sha256((t[:len(t) - h] + nxt[:h]).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == expect
    prints = defaultdict(set)
    text_of = defaultdict(set)
    for r in f.fingerprinted(odd_docs, ["doc_id", "text"]).collect():
        prints[r.text or ""].add(r.fingerprint)
        text_of[r.fingerprint].add(" ".join(WORD.findall(r.text or "")))
    assert all(len(p) == 1 for p in prints.values()) and all(len(t) == 1 for t in text_of.values())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    whole = [r for r in rows if r.n_chars > 300]
    assert sum(r.near_edited > r.near_next for r in whole) > 0.9 * len(whole)
    assert f.edited_pairs(no_docs).count() == 0
    one = spark.createDataFrame([(5, "abc def", None, None, 1)], DOCS)
    assert f.edited_pairs(one).first().edited_sha256 == hashlib.sha256(b"abc abc").hexdigest()


def test_fingerprints_are_homomorphic():
    from tablekit.llm import fingerprint as f
    a, b, ab, ba = f.fingerprints(["one two\n", "three four five\n", "one two\nthree four five", "three four five\none two\n"])
    assert (f.combine(a, b) == ab).all() and (ab == ba).all() and (f.combine(ab, b, -1) == a).all()


def test_fingerprints_of_repeated_paragraphs_and_unspaced_text():
    from tablekit.llm import fingerprint as f
    n = 65_536
    same, half, empty = f.fingerprints(["same line\n" * n, "same line\n" * (n // 2) + "other one\n" * (n // 2), ""])
    assert not (same == empty).all() and not (same == half).all()
    near = f.likeness(np.stack([same, same, same]), np.stack([same, half, empty]))
    assert near[0] == 1 and abs(near[1] - 2 / 3) < 0.15 and near[2] < 0.05
    rng = random.Random(4)
    a, b = ("".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(4_000)) for _ in range(2))
    base, edited, other = f.fingerprints([a, a[:2_000] + b[:2_000], b])
    near = f.likeness(np.stack([base, base]), np.stack([edited, other]))
    assert 0.3 < near[0] < 0.7 and near[1] < 0.3
    # one inserted character changes the parts around it alone
    changed = f.fingerprints([a[:1_000] + "\u4e00" + a[1_000:]])
    assert f.likeness(base[None], changed)[0] > 0.85


def test_run_parts_cover_long_runs():
    from tablekit.llm import fingerprint as f
    text = ("ab" * 20 + " " + "".join(chr(97 + i * i % 23) for i in range(3_000)) + " end").encode()
    buf = np.frombuffer(text + bytes(8), np.uint8)
    start, end, continues = f.run_parts(buf, np.array([0, 41, 3_042]), np.array([40, 3_041, 3_045]))
    assert list(start[~continues]) == [0, 41, 3_042]
    inner = slice(1, len(start) - 1)
    assert start[inner][0] == 41 and end[inner][-1] == 3_041 and (start[inner][1:] == end[inner][:-1]).all()


def test_count_up_to(spark):
    from tablekit.llm.fingerprint import _count_up_to
    rng = random.Random(8)
    for size in (0, 1, 2, 5, 300):
        cuts = sorted(rng.sample(range(-1_000, 1_000), size))
        rows = spark.range(-1_010, 1_010, 7).select("id", _count_up_to(cuts, F.col("id")).alias("n")).collect()
        assert all(r.n == sum(c <= r.id for c in cuts) for r in rows)


def test_edited_pairs_over_many_ranges(spark):
    from tablekit.llm import fingerprint as f
    rng = random.Random(2)
    texts = [prose(rng, rng.randint(1, 30)) for _ in range(300)]
    df = spark.createDataFrame([(i * 7 % 307, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(7)
    order = sorted((i * 7 % 307, t) for i, t in enumerate(texts))
    got = {r.doc_id: r.edited_sha256 for r in f.edited_pairs(df).collect()}
    for k, (i, t) in enumerate(order):
        nxt, h = order[(k + 1) % 300][1], len(t) // 2
        assert got[i] == hashlib.sha256((t[:len(t) - h] + nxt[:h]).encode()).hexdigest()


def test_components(spark):
    from tablekit.llm.components import connected_components
    rng = random.Random(9)
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 100)] + [(5000, 5001), (5001, 5000), (7, 7)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(201)} | {1000 + k: 1000 for k in range(100)} | {5000: 5000, 5001: 5000}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_full_cache_keeps_frequent_stretches(monkeypatch):
    """A full cache drops stretches met once; the ids stay those of whole texts."""
    import numpy as np

    from tablekit.llm import tokens as T
    monkeypatch.setattr(T, "MAX_STRETCHES", 60)
    tok = T.BatchTokenizer(T.vocabulary_path())
    asked, real = [], tok.tokenizer

    class Seen:
        def encode_batch_fast(self, texts, **kw):
            asked.extend(texts)
            return real.encode_batch_fast(texts, **kw)
    tok.tokenizer = Seen()
    for k in range(12):
        texts = [" common words\u00e9 stay" + "".join(f" once{k}x{i}" for i in range(30)), "", f" common {k}"]
        raw = [t.encode() for t in texts]
        buf = np.frombuffer(b"".join(raw) + bytes(8), np.uint8)
        ids, bounds = tok.encode(buf, np.concatenate(([0], np.cumsum([len(x) for x in raw]))))
        assert [ids[s:e].tolist() for s, e in zip(bounds[:-1], bounds[1:])] == [
            real.encode(t, add_special_tokens=False).ids for t in texts]
    assert asked.count(" common") == asked.count(" stay") == 1 and tok.table.size < 100


def test_near_orders_are_released_one_by_one(spark, monkeypatch):
    """The shuffle of one near order is given back before the next one begins."""
    from tablekit.llm import ngram_join as J
    steps, near, release = [], J.near_links, J.release
    monkeypatch.setattr(J, "near_links", lambda reps, by, *a: (steps.append(by), near(reps, by, *a))[1])
    monkeypatch.setattr(J, "release", lambda s: (steps.append("release"), release(s))[1])
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "x y z u v w"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in J.jaccard_components(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}
    assert steps[steps.index("near1"):steps.index("near2") + 2] == ["near1", "release", "near2", "release"]


def _shuffle_mb(spark):
    import os
    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return sum(os.lstat(os.path.join(a, f)).st_size for d in dirs for a, _, names in os.walk(d) for f in names
               if f.startswith("shuffle_")) / 1e6


def test_release_gives_back_the_last_shuffle(spark):
    """One call is enough for a frame that was checkpointed just before."""
    import time
    from tablekit.llm.common import checkpointed, release
    for _ in range(2):
        release(spark)                                 # what other tests left
        time.sleep(1)
    before = _shuffle_mb(spark)
    kept = checkpointed(spark.range(500_000).select("id", F.rand(1).alias("x")).repartition(3, "x"))
    assert _shuffle_mb(spark) > before + 4
    release(spark)
    for _ in range(40):
        if _shuffle_mb(spark) < before + 1:
            break
        time.sleep(0.25)
    assert _shuffle_mb(spark) < before + 1 and kept.count() == 500_000


def test_component_rounds_are_released(spark, monkeypatch):
    from tablekit.llm import components as C
    steps, write = [], C.checkpointed
    monkeypatch.setattr(C, "checkpointed", lambda df: (steps.append("round"), write(df))[1])
    monkeypatch.setattr(C, "release", lambda s: steps.append("release"), raising=False)
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 99), (99, 98), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in C.connected_components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 98: 98, 99: 98, 100: 98}
    assert len(steps) > 4 and steps[1:] == ["round", "release"] * (len(steps) // 2)


def test_texts_move_once(spark):
    """one_of_each chooses on keys; only its last join shuffles texts, and the sets are gone by then."""
    from tablekit.llm.ngram_join import one_of_each
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame([(1, "a b c d e f", "x"), (2, "a b c d e f", "x"), (2, "a b c d e f", "x"), (3, "other words", "y"),
                                      (3, "other words", "y"), (3, "other words", "z"), (None, "a b c d e f", "x"), (None, "lone", None),
                                      (None, "lone", None), (5, None, "y"), (5, None, "y")], "doc_id long, text string, lang string")
        kept = one_of_each(docs)
        plan = spark._jvm.PythonSQLUtils.explainString(kept._jdf.queryExecution(), "formatted")
        moved = [p for p in re.split(r"\n\n", plan) if re.match(r"\(\d+\) Exchange", p.strip()) and "text#" in p]
        assert len(moved) == 1 and "grams#" not in plan
        got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
        assert got == sorted([(1, "a b c d e f"), (3, "other words"), (5, None), (None, "lone")], key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_blocks_name_their_run_of_documents(spark):
    """An n-gram block holds two numbers for its documents, however many buckets share them."""
    from tablekit.llm import ngram_join as J
    for n in (1, 1 << 16, (1 << 16) + 1):
        place = np.unique([0, n // 2, n - 1])
        run = np.array([7 << 36, n], np.int64).tobytes()
        packed = J._pack_places(place, n)
        assert J._unpack_run(run, packed).tolist() == (place + (7 << 36)).tolist()
        assert len(packed) == len(place) * (2 if n <= 1 << 16 else 4)
    docs = spark.createDataFrame([(k, f"w{k} a b c d e f{k % 3}") for k in range(50)], "doc_id long, text string")
    rows = docs.select("doc_id", F.xxhash64("text").alias("key"), "text").coalesce(1).mapInArrow(J._blocks(4, 64), J.BLOCKS).collect()
    assert {len(r.nodes) for r in rows if r.bucket < 64} == {16}
