"""The pipeline against a plain version of each stage, on that stage's own input."""

import re

import numpy as np
import pytest

import corpus_pipeline
from lakeferry.llm import mixing, toxicity
from lakeferry.llm.common import table, work_dir


def slow_classes(texts):
    """Smallest reachable id of every id, by the 5-word Jaccard of all pairs."""
    sets, root = {}, {k: k for k in texts}
    for k, t in texts.items():
        ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[k] = {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in texts}


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs, out = table(spark, sf, "documents"), []
    for _, f in corpus_pipeline.STAGES:
        folder = work_dir(spark, "stage")
        f(spark, docs, sf).write.mode("overwrite").parquet(folder)
        out.append((docs, docs := spark.read.parquet(folder)))
    return out


def test_stages(spark, sf, stages):
    (docs, clean), (_, single), (_, free), (_, mix), (_, ids) = stages
    for before, after in stages[:-1]:
        assert after.columns == before.columns == docs.columns
    key = lambda rows: sorted((r.doc_id, r.text) for r in rows)
    w, b = toxicity.train(docs, table(spark, sf, "labels"), toxicity.usable_for_training())
    words = toxicity.Words()
    scores = {r.doc_id: toxicity.noisy_or(toxicity.sentence_logits(words, w.astype(np.float32).astype(np.float64), r.text.encode())[0] + b) for r in docs.collect()}
    assert key(clean.collect()) == key(r for r in docs.collect() if scores[r.doc_id] < 0.3)
    classes = slow_classes({r.doc_id: r.text for r in clean.collect()})
    assert key(single.collect()) == key(r for r in clean.collect() if classes[r.doc_id] == r.doc_id)
    words_of = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    bad = set()
    for r in table(spark, sf, "benchmark").collect():
        ws = words_of(r.text)
        bad |= {tuple(ws[i : i + 10]) for i in range(max(1, len(ws) - 9))} if ws else set()
    hit = lambda t: any(tuple(ws[i : i + n]) in bad for ws in [words_of(t)] for n in {len(x) for x in bad} for i in range(len(ws) - n + 1))
    assert key(free.collect()) == key(r for r in single.collect() if not hit(r.text))
    taken = {r.doc_id: r.taken for r in mixing.plan(free).collect()}
    count = {}
    for r in mix.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert count == {k: v for k, v in taken.items() if v}
    assert sorted(r.doc_id for r in ids.collect()) == sorted(r.doc_id for r in mix.collect())


def test_run(spark, sf, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == sorted(map(tuple, stages[-1][1].collect()))
