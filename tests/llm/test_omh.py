import random

import numpy as np

from millrace.llm import omh
from millrace.llm.common import WordBatch, shingles
from millrace.llm.queries import QUERIES

from llm_help import SF, near_classes


def test_query_matches_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert {r["doc_id"]: r["class_id"] for r in QUERIES["op8_near_dedup"](spark, SF).collect()} == near_classes(rows)


def test_group_of_edited_copies(spark):
    """Copies of one text with few to many edits: those within reach are one class, the others their own."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 120):
        copy = list(base)
        for _ in range(rng.randrange(7)):
            copy[rng.randrange(len(copy))] = f"z{rng.randrange(9)}"
        rows.append((i, " ".join(copy)))
    rows += [(200, " ".join(base[75:] + base[:75])), (201, " ".join(base[:60]))]
    got = omh.near_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == near_classes(rows)


def test_alignment():
    def labels(text):
        return shingles(WordBatch([text]), 5)[0]

    words = [f"w{i}" for i in range(100)]
    assert omh.aligned(labels(" ".join(words)), labels(" ".join(words)))
    assert omh.aligned(labels(" ".join(words)), labels(" ".join(words[3:])))
    assert not omh.aligned(labels(" ".join(words)), labels(" ".join(words[50:] + words[:50])))
    assert not omh.aligned(labels("a"), labels(""))
    assert omh.rising([3, 1, 2, 5, 4, 6]) == 4


def test_sketch_does_not_depend_on_batch():
    texts = ["one two three", " ".join(f"w{i % 40}" for i in range(300)), "", " ".join(f"v{i}" for i in range(30))]
    labels, doc = shingles(WordBatch(texts), 5)
    together = omh.sketch(labels, doc, len(texts))
    for n, text in enumerate(texts):
        own, zero = shingles(WordBatch([text]), 5)
        if len(own):
            assert (omh.sketch(own, zero, 1)[0] == together[n]).all()
    assert len(np.unique(labels[doc == 1])) == 296


def test_odd_rows(spark, odd_docs):
    kept = omh.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    got = sorted((str(r["doc_id"]), (r["text"] or "")[:5]) for r in kept.collect())
    # the three copies and the longer one are a class; null, empty and blank texts are one
    assert got == [("1", "w0 w1"), ("3", ""), ("4", "x"), ("6", "token"), ("7", "anoth"), ("7", "été ß")]
    assert omh.keep_one(odd_docs.limit(0)).count() == 0
