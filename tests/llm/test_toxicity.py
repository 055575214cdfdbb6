import collections
import zlib

import numpy as np

from millrace.llm import toxicity
from millrace.llm.queries import QUERIES

from llm_help import SF

MILD, RUDE = "table window garden river morning paper".split(), "idiot scumbag worthless moron".split()


def _texts(seed, n=120):
    rng = np.random.default_rng(seed)
    labels = rng.integers(0, 2, n)
    texts = [" ".join([*rng.choice(MILD, 30), *(rng.choice(RUDE, 2) if y else [])]) for y in labels]
    return texts, labels


def packed(texts):
    return [toxicity.pack_features(t) for t in texts]


def brute_buckets(text):
    """Buckets of all n-grams of 3 to 5 bytes of the words with a space on either side, one by one."""
    out = collections.Counter()
    folded = bytes(toxicity._FOLD[np.frombuffer((text or "").lower().encode(), np.uint8)]) if text else b""
    for word in folded.split():
        word = b" " + word + b" "
        for size in (3, 4, 5):
            for at in range(len(word) - size + 1):
                code = word[at]
                for c in word[at + 1:at + size]:
                    code = (code * 16777619 + c) % 2**32
                out[((code ^ size * 0x9E3779B1 % 2**32) * 2654435761 % 2**32) >> (32 - toxicity.BITS)] += 1
    return out


def test_features_and_scores_match_brute_force(monkeypatch):
    texts, labels = _texts(7)
    weights, bias = toxicity.train(packed(texts), labels, 0.3)
    monkeypatch.setattr(toxicity, "SLICE", 61)
    for text in texts[:10] + [None, "", "a", "ab", "Été, l'IDIOT! 日本", "x" * 300, "one-two  three"]:
        want = brute_buckets(text)
        used, counts = toxicity.feature_counts(text)
        assert dict(zip(used.tolist(), counts.tolist())) == want
        n = max(1, sum(want.values()))
        bounds, columns, shares = toxicity.unpack_features([toxicity.pack_features(text)])
        assert columns.tolist() == sorted(want) and np.allclose(shares, [want[c] / n for c in sorted(want)])
        mean = sum(float(weights[b]) * k for b, k in want.items()) / n
        assert np.isclose(toxicity.score_texts([text], weights, bias)[0], 1 / (1 + np.exp(-mean - bias)))


def test_repeated_ids_teach_once(spark):
    """A labelled id in many rows is one document of the sample."""
    texts, labels = _texts(9, 60)
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])] * 50 + [(None, "idiot")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    known = spark.createDataFrame(list(enumerate(labels.tolist())), "doc_id long, toxic int")
    once = toxicity.learn(docs.dropDuplicates(["doc_id"]).where("doc_id is not null"), known)
    again = toxicity.learn(docs, known)
    assert np.array_equal(once[0], again[0]) and once[1] == again[1]


def test_learns_and_carries_over_to_misspellings():
    texts, labels = _texts(1)
    weights, bias = toxicity.train(packed(texts), labels, 0.5)
    held, truth = _texts(2)
    assert ((toxicity.score_texts(held, weights, bias) >= 0.5) == truth).mean() > 0.95
    mild = " ".join(MILD * 5)
    clean, rude, misspelt = toxicity.score_texts([mild, mild + " idiot", mild + " idiiot idiotz"], weights, bias)
    assert clean < rude and clean < misspelt


def test_slices_do_not_change_scores(monkeypatch):
    texts, labels = _texts(3)
    weights, bias = toxicity.train(packed(texts), labels, 0.3)
    every = texts + [None, "", "é" * 50, "x" * 5000]
    whole = toxicity.score_texts(every, weights, bias)
    monkeypatch.setattr(toxicity, "SLICE", 97)
    monkeypatch.setattr(toxicity, "TOGETHER", 1000)
    assert np.allclose(whole, toxicity.score_texts(every, weights, bias))
    assert np.allclose(whole, [toxicity.score_texts([t], weights, bias)[0] for t in every])


def test_query_and_odd_rows(spark, odd_docs):
    got = QUERIES["op1_toxicity"](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (3, None), (4, 0)], "doc_id long, toxic int")
    kept = toxicity.keep_clean(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.count() <= odd_docs.count()
    assert toxicity.keep_clean(odd_docs.limit(0), labels).count() == 0
    assert toxicity.keep_clean(odd_docs, labels.limit(0)).count() == odd_docs.count()
