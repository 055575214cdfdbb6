"""Toxicity: averaged subword embeddings under a linear softmax.

A text is lower-cased and cut into words of letters and digits.  Its features
are the byte n-grams of 3 to 5 characters of every word, the word's bounds
included, hashed into ``BUCKETS`` rows of an embedding table.  The mean of the
rows is the text's vector, and a linear softmax turns it into two class
probabilities.  Embeddings and softmax are trained together, so a misspelling
that was never seen still lands near the words it shares n-grams with.

Training takes place in numpy on a bounded, seeded sample of labelled rows:
at most ``PER_CLASS`` documents of either class (a documented limit of the
classifier; all else covers all rows).  Their n-grams are counted in tasks, and
one row of at most ``BUCKETS`` counts comes to the driver for each document,
never a text.  Sampling is by class, so the bias is moved back to the class
frequencies of all labelled rows.  Scoring is one Arrow pass over whole texts,
some at a time and in slices of a buffer, so that memory grows neither with a
batch nor with the work on a long text.

Defined cases: a null or empty text has no features and scores the prior; a
label row without a class, or without a document, teaches nothing; where label
rows of a document disagree, toxic wins; without labels of both classes the
score is the smoothed prior; repeated rows are scored each; an empty table
gives an empty result; other columns are carried by ``score`` unchanged.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import extended, give_back, lean, set_aside, table, text_groups, text_parts

BITS, DIM = 18, 6
BUCKETS = 1 << BITS
SIZES = (3, 4, 5)
#: At most so many labelled rows of class 0 and of class 1 are learnt from.
PER_CLASS = (5000, 2500)
EPOCHS, RATE, SCALE, BATCH, DECAY = 12, 0.3, 24.0, 128, 1e-6
#: A small sample is gone through more often, up to this many minibatches.
STEPS = 240
#: Positions of a slice, characters of the texts that are folded together, and of those read from a batch at a time.
SLICE, TOGETHER, READ = 1 << 17, 1 << 19, 1 << 22
SPACE = 0x20

_FOLD = np.full(256, SPACE, np.uint8)
for _low, _high in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
    _FOLD[_low:_high] = np.arange(_low, _high, dtype=np.uint8)


def feature_slices(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of the joined texts: starts of the texts in the slice, and per n-gram size bucket and validity."""
    raw = [(t or "").lower().encode("utf-8") for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    data = _FOLD[np.frombuffer(b" " + b" ".join(raw) + b" " * (1 + max(SIZES)), np.uint8)]
    total = int(ends[-1]) if len(raw) else 0
    for at in range(0, total, SLICE):
        n = min(SLICE, total - at)
        part = data[at:at + n + max(SIZES) - 1]
        inner = part != SPACE
        code = part[:-1].astype(np.uint32) * np.uint32(16777619) + part[1:]
        valid = np.ones(n, bool)
        buckets, valids = [], []
        for size in SIZES:
            code = code[:len(part) - size + 1] * np.uint32(16777619) + part[size - 1:]
            valid = valid & inner[size - 2:size - 2 + n]
            key = (code[:n] ^ np.uint32(size * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(2654435761)
            buckets.append(key >> np.uint32(32 - BITS))
            valids.append(valid)
        yield np.clip(np.concatenate(([0], ends)) - at, 0, n), np.array(buckets), np.array(valids)


def feature_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text in rising order, and how often each occurs."""
    counts = np.zeros(BUCKETS, np.uint32)
    for _, buckets, valids in feature_slices([text]):
        for bucket, valid in zip(buckets, valids):
            counts += np.bincount(bucket[valid], minlength=BUCKETS).astype(np.uint32)
    used = np.flatnonzero(counts)
    return used.astype(np.uint32), counts[used]


def pack_features(text: str | None) -> bytes:
    """The counts of a text: steps between its buckets and the counts, compressed."""
    used, counts = feature_counts(text)
    return zlib.compress(np.concatenate((np.diff(used, prepend=np.uint32(0)), counts)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack_features(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of bucket frequencies: row bounds, buckets, shares (each row's shares sum to 1)."""
    bounds = np.cumsum([0] + [len(zlib.decompress(r)) >> 3 for r in rows])
    columns, shares = np.empty(bounds[-1], np.int32), np.empty(bounds[-1], np.float32)
    for r, a, b in zip(rows, bounds, bounds[1:]):
        steps, counts = np.ascontiguousarray(np.frombuffer(zlib.decompress(r), np.uint8).reshape(4, -1).T).view("<u4").reshape(2, -1)
        columns[a:b] = np.cumsum(steps)
        shares[a:b] = counts / max(1.0, float(counts.sum()))
    return bounds, columns, shares


def train(features: list[bytes], labels: np.ndarray, prior: float, seed: int = 5) -> tuple[np.ndarray, float]:
    """Train embeddings and softmax together on packed features; returns each bucket's log-odds weight, and the bias.

    Adagrad on minibatches.  The two classes' softmax depends only on the
    difference of their weight rows, which is what scoring needs.
    """
    odds = float(np.log(prior / (1 - prior)))
    if len(set(labels.tolist())) < 2:
        return np.zeros(BUCKETS, np.float32), odds
    rng = np.random.default_rng(seed)
    bounds, columns, shares = unpack_features(features)
    table_ = (rng.standard_normal((BUCKETS, DIM)) * 0.05).astype(np.float32)
    softmax = (rng.standard_normal((DIM, 2)) * 0.5).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen_table, seen_softmax, seen_bias = np.full((BUCKETS, DIM), 1e-8, np.float32), np.full((DIM, 2), 1e-3, np.float32), np.full(2, 1e-3, np.float32)
    target = np.eye(2, dtype=np.float32)[labels]
    epochs = max(EPOCHS, -(-STEPS // -(-len(labels) // BATCH)))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(len(labels))
        for begin in range(0, len(order), BATCH):
            rows = order[begin:begin + BATCH]
            width = bounds[rows + 1] - bounds[rows]
            where = np.repeat(bounds[rows] - np.concatenate(([0], np.cumsum(width)[:-1])), width) + np.arange(width.sum())
            cols, share, row = columns[where], shares[where], np.repeat(np.arange(len(rows)), width)
            used, slot = np.unique(cols, return_inverse=True)
            rows_of = table_[used]
            mean = np.stack([np.bincount(row, share * rows_of[slot, k], len(rows)) for k in range(DIM)], 1).astype(np.float32) * np.float32(SCALE)
            logits = mean @ softmax + bias
            logits -= logits.max(1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(1, keepdims=True)
            miss = (p - target[rows]) / len(rows)
            back = (miss @ softmax.T) * np.float32(SCALE)
            grad = np.stack([np.bincount(slot, share * back[row, k], len(used)) for k in range(DIM)], 1).astype(np.float32) + np.float32(DECAY) * rows_of
            seen_table[used] += grad * grad
            table_[used] = rows_of - np.float32(rate) * grad / np.sqrt(seen_table[used])
            grad = mean.T @ miss
            seen_softmax += grad * grad
            softmax -= np.float32(rate) * grad / np.sqrt(seen_softmax)
            grad = miss.sum(0)
            seen_bias += grad * grad
            bias -= np.float32(rate) * grad / np.sqrt(seen_bias)
    weights = (table_ @ (softmax[:, 1] - softmax[:, 0])) * np.float32(SCALE)
    share = float(labels.mean())
    return weights.astype(np.float32), float(bias[1] - bias[0]) + odds - float(np.log(share / (1 - share)))


def score_texts(texts: list[str | None], weights: np.ndarray, bias: float) -> np.ndarray:
    """Probability of class 1 for every text."""
    total, count = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    for a, b in text_groups(texts, TOGETHER):
        for starts, buckets, valids in feature_slices(texts[a:b]):
            weight = np.zeros(buckets.shape[1])
            for bucket, valid in zip(buckets, valids):
                weight += weights[bucket] * valid
            value, number = np.zeros(len(weight) + 1), np.zeros(len(weight) + 1, np.int64)
            np.cumsum(weight, out=value[1:])
            np.cumsum(valids.sum(0), out=number[1:])
            total[a:b] += np.diff(value[starts])
            count[a:b] += np.diff(number[starts])
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + bias, -500, 500)))


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def learn(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = PER_CLASS, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights and bias from the labelled rows that are not held out.

    A seeded hash picks at most ``per_class`` documents of the two classes; only
    their features come to the driver.
    """
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    classes = {r["toxic"]: r["n"] for r in known.where("toxic in (0, 1)").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    positive, negative = classes.get(1, 0), classes.get(0, 0)
    chosen = None
    for value in (0, 1):
        some = known.where(F.col("toxic") == value).orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(per_class[value])
        chosen = some if chosen is None else chosen.union(some)
    turn = F.xxhash64(F.lit(seed + 1), "doc_id").alias("turn")
    sample = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
              .groupBy("doc_id").agg(F.first("toxic").alias("toxic"), F.min("text").alias("text")).select("text", "toxic", turn))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [pack_features(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column(1), batch.column(2)], names=["features", "toxic", "turn"])

    known_to = labels.schema["toxic"].dataType.simpleString()
    rows = sorted(sample.mapInArrow(lean(features), f"features binary, toxic {known_to}, turn long").collect(), key=lambda r: (r["turn"], r["features"]))
    give_back()
    return train([bytes(r["features"]) for r in rows], np.array([r["toxic"] for r in rows], np.int64),
                 (positive + 1) / (positive + negative + 3), seed)


def score(docs: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """``docs`` with a column toxic_score, from their texts alone."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast((weights, bias))
    place = docs.columns.index("text")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = model.value
        for part, texts in (run for batch in batches for run in text_parts(batch, place, READ)):
            result = score_texts(texts, w, b)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(result, pa.float64())], names=[*part.schema.names, "toxic_score"])

    schema = extended(docs.schema, toxic_score="double")
    return docs.mapInArrow(lean(scored), schema)


def keep_clean(docs: DataFrame, labels: DataFrame, most: float = 0.5) -> DataFrame:
    """``docs`` without those that score ``most`` or higher."""
    narrow, restore = set_aside(docs, "doc_id", "text")
    weights, bias = learn(docs.select("doc_id", "text"), labels)
    return restore(score(narrow, weights, bias).where(F.col("toxic_score") < most))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    weights, bias = learn(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return score(docs, weights, bias).select(
        "doc_id", held_out().alias("held_out"), F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"))
