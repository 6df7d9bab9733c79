"""The pipeline, stage by stage, against brute force on a small table."""

import importlib.util
import os
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as cp
from tablekit.llm import toxicity
from tablekit.llm.common import table
from tests.llm.test_operators import WORD, brute_components, brute_targets, crc, encoder

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before the first stage and after each."""
    base = tmp_path_factory.mktemp("pipeline")
    docs = table(spark, SF, "documents")
    out = [docs]
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, docs, SF).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
        out.append(docs)
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def brute_score(net, text):
    """Window by window, word by word, with no batching."""
    raw = re.sub(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]", b" ", (text or "").encode()).lower()
    words = raw.split()
    if not words:
        return 0.0
    x = []
    for w in words:
        buf = np.zeros(len(w) + 8, np.uint8)
        buf[:len(w)] = np.frombuffer(w, np.uint8)
        s, e = np.array([0]), np.array([len(w)])
        x.append(net.inputs(buf, s, e, toxicity.span_hashes(buf, s, e))[0])
    best, at = -np.inf, 0
    while True:
        part = np.array(x[at:at + toxicity.WINDOW])
        best = max(best, float(net.forward(part, np.array([0]), np.array([len(part)]))[0][0]))
        if at + toxicity.WINDOW >= len(x):
            return 1 / (1 + np.exp(-best))
        at += toxicity.STRIDE


def test_names_and_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "language ID", "n-gram Jaccard join",
                                         "mixing sources to target weights", "best-fit packing"]
    assert all(df.columns == stages[0].columns for df in stages[1:-1])


def test_toxicity_stage(spark, stages):
    net = toxicity.train(*toxicity.labelled_sample(stages[0], table(spark, SF, "labels")))
    want = Counter((i, t) for i, t in rows(stages[0]) if brute_score(net, t) < cp.TOXIC_FROM)
    assert Counter(rows(stages[1])) == want


def test_language_stage(stages):
    want = Counter((i, t) for i, t in rows(stages[1]) if any(c.isalpha() for c in t or ""))
    assert Counter(rows(stages[2])) == want


def test_near_copy_stage(stages):
    before = rows(stages[2])
    best = {c for _, _, c in brute_components(before, cp.SHINGLE_WORDS, cp.SIMILAR_PERCENT, 100)}
    assert sorted(i for i, _ in rows(stages[3])) == sorted(best)


def test_mixing_stage(stages):
    before = {r.doc_id: (r.source, r.text) for r in stages[3].collect()}
    taken = Counter(r.doc_id for r in stages[4].collect())
    assert set(taken) <= set(before) and max(taken.values()) <= 2
    sizes, got, biggest = Counter(), Counter(), Counter()
    for i, (s, t) in before.items():
        n = len(WORD.findall(t or ""))
        sizes[s] += n
        got[s] += taken[i] * n
        biggest[s] = max(biggest[s], n)
    target = brute_targets(sizes)
    assert all(abs(got[s] - target[s]) <= max(biggest.values()) for s in sizes)
    assert abs(sum(got.values()) / sum(target.values()) - 1) < 0.05


def test_packing_stage(stages):
    enc = encoder()
    want = Counter()
    for i, t in rows(stages[4]):
        ids = enc(t)
        cuts = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        want.update((i, k, s, e - s, crc(ids[s:e])) for k, (s, e) in enumerate(zip(cuts, cuts[1:])))
    got = stages[5].collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
    assert len(bins) <= -(-sum(r.length for r in got) // 2048) + 2


def test_the_rest_stands_without_this_subpackage(tmp_path):
    """Nothing outside imports llm; the entry module works when it is missing."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, names in os.walk(os.path.join(root, "tablekit")):
        for n in names:
            if n.endswith(".py") and os.path.basename(folder) != "llm":
                assert "tablekit.llm" not in open(os.path.join(folder, n)).read(), n
    spec = importlib.util.spec_from_file_location("entry_alone", os.path.join(root, "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    entry.llm_queries = entry.corpus_pipeline = None
    assert not any(re.match(r"op\d|pipeline", n) for n in entry.queries()) and entry.oracle_sql()
