import base64
import random
from bisect import bisect_left

import numpy as np

from millrace.llm import syncmers
from millrace.llm.queries import QUERIES

from llm_help import SF, sha


def brute_places(text):
    """Places of closed syncmers, k-mer by k-mer."""
    points = np.array([ord(c) for c in text], np.uint64)
    out = []
    for i in range(len(text) - syncmers.K + 1):
        inner = []
        for j in range(i, i + syncmers.K - syncmers.S + 1):
            code = np.zeros(1, np.uint64)
            for c in points[j:j + syncmers.S]:
                code = code * syncmers._ODD + c
            inner.append(int(syncmers.mix64(code)[0]))
        if min(inner) in (inner[0], inner[-1]):
            out.append(i)
    return out


def test_places_match_the_definition():
    text = "the quick brown fox jumps over the lazy dog, é🎉ü and " + "ab" * 20
    at, _ = syncmers.syncmers(np.array([ord(c) for c in text], np.uint64))
    assert at.tolist() == brute_places(text)


def test_anchors_do_not_depend_on_context_or_batch():
    texts = ["some words that are long enough to have anchors " * 3, "", "short", "other words before; " + "some words that are long enough to have anchors " * 3]
    alone = [syncmers.fingerprints([t])[0] for t in texts]
    for a, b in zip(alone, syncmers.fingerprints(texts)):
        assert a[0] == b[0] and (a[1] == b[1]).all() and (a[2] == b[2]).all()
    assert syncmers.likeness(alone[0], alone[0]) == 1 and syncmers.likeness(alone[1], alone[1]) == 1 and syncmers.likeness(alone[0], alone[1]) == 0
    assert syncmers.likeness(alone[0], alone[3]) > 0.6


def test_query(spark):
    rows = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r["doc_id"]: r for r in QUERIES["op7_syncmers"](spark, SF).collect()}
    assert len(got) == len(rows)
    prints = {}
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        r = got[i]
        own, changed, after = syncmers.fingerprints([text, edited, following])
        assert r["n_chars"] == len(text) and r["edited_sha256"] == sha(edited)
        assert r["fingerprint"] == syncmers.fingerprint_text(own) and r["edited_fingerprint"] == syncmers.fingerprint_text(changed)
        assert r["near_edited"] == syncmers.likeness(own, changed) and r["near_next"] == syncmers.likeness(own, after)
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert np.mean([r["near_edited"] for r in got.values()]) > 0.4 > 0.1 > np.mean([r["near_next"] for r in got.values()])


def test_odd_rows(spark, odd_docs):
    assert syncmers.compare_with_next(odd_docs).count() == odd_docs.count()
    one = spark.createDataFrame([(9, "one text only, its own next one")], "doc_id long, text string")
    assert syncmers.compare_with_next(one).first()["near_next"] == 1
    assert syncmers.compare_with_next(one.limit(0)).count() == 0


def test_likeness_counts_all_anchors_of_long_texts():
    """A passage of some hundred words in two long texts: the share of its anchors, to the last one."""
    rng = random.Random(3)
    some = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    passage = some(2000)
    a, b = some(60_000) + passage + some(58_000), some(9_000) + passage + some(109_000)
    own, other = syncmers.fingerprints([a, b])
    first = [{}, {}]
    for places, text in zip(first, (a, b)):
        at, code = syncmers.syncmers(np.array([ord(c) for c in text], np.uint64))
        for p, h in zip(at.tolist(), (code >> np.uint64(32)).tolist()):
            places.setdefault(h, p)
    common = sorted((first[0][h], first[1][h]) for h in first[0].keys() & first[1].keys())
    tails = []
    for _, p in common:
        k = bisect_left(tails, p)
        tails[k:k + 1] = [p]
    assert len(tails) > 400
    assert syncmers.likeness(own, other) == len(tails) / max(map(len, first)) > 0.01


def test_fingerprint_text_holds_every_anchor():
    text = "some words that are long enough to have anchors, then one letter " + "a" * 1000 + " and words again " + "xyz" * 20
    count, hashes, places = syncmers.fingerprints([text])[0]
    number, code = syncmers.fingerprint_text((count, hashes, places)).split(":")
    raw = base64.b64decode(code)
    got, at, k = [], 0, 0
    for _ in range(count):
        step, k = raw[k], k + 1
        if step == 255:
            step, k = int.from_bytes(raw[k:k + 4], "little"), k + 4
        got.append(at := at + step)
    assert int(number) == count == len(hashes) and got == sorted(places.tolist()) and max(np.diff(got)) > 255
    assert np.frombuffer(raw[k:], "<u4").tolist() == hashes[np.argsort(places)].tolist()
