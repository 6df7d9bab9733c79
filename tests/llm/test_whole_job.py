"""Cases in which an operator or a stage once did less than its whole job."""

import base64
import random

import numpy as np

import corpus_pipeline as cp
from tests.llm.test_operators import DOCS, prose


def test_toxicity_stage_drops_what_op7_calls_toxic(spark, monkeypatch):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(i, f"text {i}", "en", "a", 0) for i in range(100)], DOCS)
    monkeypatch.setattr(cp, "table", lambda *_: None)
    monkeypatch.setattr(cp.toxicity, "toxicity_scores",
                        lambda docs, labels, keep, score="score": docs.select(*keep, (F.col("doc_id") / 100).alias(score)))
    kept = {r.doc_id for r in cp.toxicity_stage(spark, docs, "").collect()}
    monkeypatch.setattr(cp.toxicity, "table", lambda *_: docs)
    called = {r.doc_id for r in cp.toxicity.op7_toxicity(spark, "").collect() if r.predicted == 1}
    assert len(called) == 70 and kept == set(range(100)) - called


def split(texts):
    from tablekit.llm import toxicity
    raw = [t if isinstance(t, bytes) else t.encode() for t in texts]
    offs = np.concatenate(([0], np.cumsum([len(t) for t in raw])))
    buf = np.concatenate((np.frombuffer(b"".join(raw), np.uint8), np.zeros(8, np.uint8)))
    return offs, toxicity.words_of(buf, offs)


def test_every_byte_of_a_long_run_reaches_the_network():
    from tablekit.llm import toxicity
    rng = random.Random(8)
    texts = ["".join(chr(rng.choice([rng.randint(0x4E00, 0x9FFF), rng.randint(97, 122), 0x3000, 0x1F600, 0xE9]))
                     for _ in range(n)) for n in (1, 12, 40, 445, 5000)]
    texts += ["x" * 64, "x" * 65, "short words", "", "tail " + "y" * 1000 + " end", b"\x80" * 300]
    offs, (buf, start, end, bounds) = split(texts)
    for r, t in enumerate(texts):
        own = [(s, e) for s, e in zip(start[bounds[r]:bounds[r + 1]], end[bounds[r]:bounds[r + 1]])]
        assert all(offs[r] <= s < e <= offs[r + 1] and e - s <= toxicity.LONG_RUN for s, e in own)
        read = {p for s, e in own for p in range(s, e)}
        assert read == {p for p in range(offs[r], offs[r + 1]) if buf[p] != 32}
        if isinstance(t, str):
            for s, e in own:
                buf[s:e].tobytes().decode()
    _, (buf, start, end, _) = split(["z" * 3000])
    bucket, word = toxicity.char_grams(buf, start, end)
    assert len(bucket) == sum(e - s + 3 - k for s, e in zip(start, end) for k in toxicity.GRAMS)
    assert len(np.unique(word)) == len(start)


def test_insult_far_into_a_text_without_spaces(spark):
    from tablekit.llm import toxicity
    rng = random.Random(9)
    chars = [chr(0x4E00 + rng.randrange(0x5000)) for _ in range(300)]
    rows, marks = [], []
    for i in range(900):
        text = [rng.choice(chars) for _ in range(rng.randint(100, 300))]
        if i % 4 == 0:
            text.insert(rng.randrange(50, len(text)), "\u9fa0\u9fa1\u9fa2\u9fa3")
        rows.append((i, "".join(text), "zh", "a", 0))
        marks.append((i, 1, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, DOCS).withColumn("held_out", toxicity.held_out())
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    tested = [r for r in toxicity.toxicity_scores(docs, labels, ["doc_id", "held_out"]).collect() if r.held_out]
    assert len(tested) > 150
    right = [(r.score >= toxicity.TOXIC_FROM) == (r.doc_id % 4 == 0) for r in tested]
    print(len(tested), sum(right) / len(right))
    assert sum(right) > 0.93 * len(tested)


def test_more_than_64_languages(spark):
    from tablekit.llm import langid
    rng = random.Random(10)
    rows = []
    for k in range(150):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(30)]
        rows += [(100 * k + i, " ".join(rng.choices(words, k=40)), f"l{k:03}", "a", 0) for i in range(12)]
    docs = spark.createDataFrame(rows, DOCS)
    model = langid.learned_filters(docs.filter(~langid.held_out()))
    assert len(model.languages) == 150 and len(model.tables) == 3
    out = langid.identified(docs.withColumn("held_out", langid.held_out()), ["lang", "held_out"]).collect()
    tested = [r for r in out if r.held_out]
    right = sum(r.lang == r.lang_pred for r in tested)
    print(len(tested), right)
    assert len(tested) > 400 and right > 0.97 * len(tested)
    assert {r.lang_pred for r in tested} == {r.lang for r in tested}


def test_language_stage_drops_what_no_filter_knows(spark):
    from tablekit.llm.common import table
    rng = random.Random(11)
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    noise = [base64.b64encode(rng.randbytes(300)).decode(),
             "".join(rng.choice("abcdefghijklmnopqrstuvwxyz   ") for _ in range(400)),
             "".join(chr(rng.randint(0x3B1, 0x3C9)) for _ in range(200)),
             "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(200)), "12 34", ""]
    added = spark.createDataFrame([(-1 - k, t, None, "a", 0) for k, t in enumerate(noise)] + [(-100, "de", None, "a", 0)], DOCS)
    kept = cp.language_stage(spark, docs.select(*added.columns).union(added), sf)
    assert [r.doc_id for r in kept.filter("doc_id < 0").collect()] == [-100]
    clean = docs.filter("text rlike '[a-zA-Z]'").count()
    assert kept.filter("doc_id >= 0").count() >= clean


def test_language_of_long_texts_only_is_learned(spark):
    from tablekit.llm import langid
    rng = random.Random(12)
    es = ["el", "la", "gato", "perro", "casa", "que", "muy", "grande", "cielo", "rojo", "comer", "pan"]
    en = ["the", "cat", "dog", "house", "which", "very", "large", "sky", "red", "eat", "bread", "a"]
    rows = [(i, " ".join(rng.choices(es, k=5000)) if i % 2 else " ".join(rng.choices(en, k=30)), "es" if i % 2 else "en", "a", 0)
            for i in range(60)]
    assert min(len(r[1]) for r in rows if r[2] == "es") > langid.SAMPLE_CHARS
    out = langid.identified(spark.createDataFrame(rows, DOCS), ["lang"]).collect()
    assert all(r.lang == r.lang_pred for r in out)


def test_samples_hold_a_row_for_each_id(spark):
    from tablekit.llm import toxicity
    docs = spark.createDataFrame([(1 if i % 3 else 100 + i, f"text {i} " + "x " * (20_000 if i == 7 else 1), "en", "a", 0)
                                  for i in range(300)], DOCS)
    labels = spark.createDataFrame([(1, 1, 1), *[(100 + i, 1, i % 2) for i in range(0, 300, 3)]], "doc_id long, quality int, toxic int")
    texts, marks, _ = toxicity.labelled_sample(docs, labels)
    ids = {r.doc_id for r in docs.join(labels.filter(~toxicity.held_out()), "doc_id", "left_semi").collect()}
    assert len(texts) == len(marks) == len(ids) and max(map(len, texts)) <= toxicity.SAMPLE_CHARS


def test_rows_that_differ_in_other_columns_only(spark):
    from tablekit.llm import mixing, ngram_join
    text = prose(random.Random(13), 60)
    docs = spark.createDataFrame([(1, text, "en", "a", 0), (1, text, "fr", "a", 0), (2, prose(random.Random(14), 90), "en", "a", 0)], DOCS)
    taken = [r.lang for r in mixing.mixed_documents(docs.filter("doc_id = 1")).collect()]
    assert set(taken) <= {"en", "fr"} and max(taken.count(x) for x in set(taken)) <= 2
    kept = {r.lang for _ in range(2) for r in ngram_join.one_of_each(docs).filter("doc_id = 1").collect()}
    assert len(kept) == 1


def test_search_between_any_two_bins():
    from tablekit.llm.packing import best_fit, local_search
    for lo, hi, n, most in ((500, 800, 3000, 1005), (450, 900, 3000, 1040), (300, 1100, 3000, 1045), (1, 40, 2000, 21)):
        rng = random.Random(1)
        size = [rng.randint(lo, hi) for _ in range(n)]
        out = local_search(best_fit(size, 2048), size, 2048)
        assert sorted(i for b in out for i in b) == list(range(n)) and all(sum(size[i] for i in b) <= 2048 for b in out)
        assert len(out) <= most
