"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A text is its sequence of five-word shingles, each labelled with which
occurrence it is, so labels are distinct within a text.  For each of ``HASHES``
hash functions the sketch holds a hash of the ``TOGETHER`` labels with the
smallest values, in text order: two texts agree there if they share those
labels and keep their order, which edits disturb and reordering does too.

Similarity is that of an alignment: M matched labels in order give
M / (|a| + |b| - M).  Labels are distinct, so the longest common subsequence
is the longest increasing run of places.  At a similarity of 0.8 or more the
places of matched labels differ by at most (|a| + |b|) / 9, hence the band is
exact.  Links are pairs that share a sketch value and align at 0.8 or more;
classes are the connected components of links.

Equal texts (equal word sequences) are one node.  Pairs are not enumerated
within the groups that share a sketch value:

1. Every group is compared with one member, the one whose sketch values are
   the most common (in a group of copies, the text they were made from).
2. Where a group still holds several components, links between them could be
   missing.  What each member lacks of the group's hub and has beside it gives
   the number of common labels of any two members; pairs of different
   components that have enough of them are aligned too, so no link between
   components is lost.

Defined cases: a null text counts as empty, and texts without words are equal;
a text of fewer than five words has one shingle; repeated rows are copies; a
null doc_id is a document, and a class is named by its smallest doc_id that is
not null; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import functools
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BASE_A, BASE_B, U64, WordBatch, extended, id_number, materialize, mix64, set_aside, shingles, span_hashes, table, text_groups

WIDTH, SIMILARITY = 5, 0.8
HASHES, TOGETHER = 24, 4
#: Values below this many times the mean spacing are looked at first.
EXPECTED = 16.0
#: Characters of the texts that are sketched together.
TEXTS = 1 << 19


def text_keys(batch: WordBatch) -> np.ndarray:
    """16 bytes for each text that are equal for equal word sequences: two independent 64-bit hashes."""
    one = span_hashes(batch.ids(BASE_A), batch.first[:-1], batch.first[1:], BASE_B)
    two = span_hashes(batch.ids(BASE_B), batch.first[:-1], batch.first[1:], BASE_A)
    return np.stack([one, two], 1).astype(">u8")


def _key_array(keys: np.ndarray) -> pa.Array:
    return pa.array([k.tobytes() for k in keys], pa.binary())


def sketch(labels: np.ndarray, doc: np.ndarray, texts: int) -> np.ndarray:
    """Order MinHash values, HASHES for each text; the rows of texts without labels are not meant to be read."""
    out = np.zeros((texts, HASHES), U64)
    if not len(labels):
        return out
    count = np.bincount(doc, minlength=texts)
    first = np.concatenate(([0], np.cumsum(count)))
    near = np.minimum(1.0, EXPECTED / np.maximum(count, 1)) * 2.0**64
    limit = np.where(near >= 2.0**63, np.uint64(2**64 - 1), np.minimum(near, 2.0**63).astype(U64))[doc]
    wanted = np.minimum(count, TOGETHER)
    rng = np.random.default_rng(11)
    seeds = rng.integers(0, 1 << 63, (HASHES, 2)).astype(U64)
    for j in range(HASHES):
        value = (labels ^ seeds[j, 0]) * (seeds[j, 1] | U64(1))
        value ^= value >> U64(29)
        some = np.flatnonzero(value <= limit)
        few = np.flatnonzero(np.bincount(doc[some], minlength=texts) < wanted)
        if len(few):
            again = np.concatenate([np.arange(first[d], first[d + 1]) for d in few])
            some = np.union1d(some, again)
        some = some[np.lexsort((value[some], doc[some]))]
        owner = doc[some]
        start = np.searchsorted(owner, np.arange(texts))
        rank = np.arange(len(some)) - start[owner]
        chosen = np.sort(some[rank < TOGETHER])
        owner = doc[chosen]
        used, begin = np.unique(owner, return_index=True)
        place = np.arange(len(chosen)) - np.repeat(begin, np.diff(np.append(begin, len(chosen))))
        weight = np.array([pow(BASE_B, k + 1, 1 << 64) for k in range(TOGETHER)], U64)
        out[used, j] = mix64(np.add.reduceat(labels[chosen] * weight[place], begin) + U64((j + 1) * BASE_A % (1 << 64)))
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, key, n_labels, sketch (empty for a text without words)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in text_groups(texts, TEXTS):
                words = WordBatch(texts[a:b])
                labels, doc = shingles(words, WIDTH)
                count = np.bincount(doc, minlength=b - a)
                values = sketch(labels, doc, b - a).view(np.int64)
                lists = [v if n else () for v, n in zip(values, count)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), _key_array(text_keys(words)), pa.array(count), pa.array(lists, pa.list_(pa.int64()))],
                    names=["doc_id", "key", "n_labels", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(build, "doc_id long, key binary, n_labels long, sketch array<long>")


def with_key(docs: DataFrame) -> DataFrame:
    """``docs`` with its text's key as a column near_key."""
    place = docs.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            keys = [_key_array(text_keys(WordBatch(texts[a:b]))) for a, b in text_groups(texts, TEXTS)]
            column = pa.concat_arrays(keys) if keys else pa.array([], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, "near_key"])

    return docs.mapInArrow(add, extended(docs.schema, near_key="binary"))


# -- verification --------------------------------------------------------------


def rising(places: list[int]) -> int:
    """Length of the longest strictly increasing subsequence."""
    tails: list[int] = []
    for p in places:
        k = bisect_left(tails, p)
        if k == len(tails):
            tails.append(p)
        else:
            tails[k] = p
    return len(tails)


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether two label sequences align at ``least`` or more."""
    both = len(a) + len(b)
    needed = least * both / (1 + least) - 1e-9
    if not both or min(len(a), len(b)) < needed:
        return False
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(i) < needed:
        return False
    band = both - 2 * needed + 1
    kept = np.abs(i - j) <= band
    i, j = i[kept], j[kept]
    j = j[np.argsort(i)]
    return bool(len(j) >= needed and ((np.diff(j) > 0).all() or rising(j.tolist()) >= needed))


@functools.lru_cache(maxsize=32)
def labels_of(text: str) -> np.ndarray:
    """Labels of a text; a hub's text comes in many rows, mostly in a row."""
    return shingles(WordBatch([text]), WIDTH)[0]


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts align; ``texts`` is (key, text), one row for each key."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            good = [aligned(labels_of(x), shingles(WordBatch([y]), WIDTH)[0]) for x, y in zip(one, two)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    joined = (pairs.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
              .join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a"))
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(check, "a binary, b binary")


def compare_with_hubs(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """For each (hub, key): whether they align, the number of the hub's labels, the places of those
    that key lacks (missing), and key's labels that the hub lacks (extra)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, size, missing, extra = [], [], [], []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                hub, own = labels_of(x), shingles(WordBatch([y]), WIDTH)[0]
                linked.append(aligned(hub, own))
                size.append(len(hub))
                missing.append(np.flatnonzero(~np.isin(hub, own)).astype(np.int32))
                extra.append(own[~np.isin(own, hub)].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(linked, pa.bool_()), pa.array(size, pa.int64()),
                 pa.array(missing, pa.list_(pa.int32())), pa.array(extra, pa.list_(pa.int64()))],
                names=["hub", "key", "linked", "hub_labels", "missing", "extra"])

    joined = (pairs.join(texts, "key").join(texts.select(F.col("key").alias("hub"), F.col("text").alias("text_hub")), "hub"))
    return joined.select("hub", "key", "text_hub", "text").mapInArrow(
        compare, "hub binary, key binary, linked boolean, hub_labels long, missing array<int>, extra array<long>")


# -- connected components ------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(a, b) -> (key, component), the smallest key that can be reached; keys without links have no row.

    Each round takes the smallest label among the neighbours and then the
    label of that label; only a count of changes comes to the driver.
    """
    both = materialize(links.union(links.select("b", "a")), "links")
    labels = materialize(both.groupBy(F.col("a").alias("key")).agg(F.least(F.col("key"), F.min("b")).alias("component")), "labels")
    while True:
        heard = (both.join(labels.withColumnRenamed("key", "b"), "b")
                 .groupBy(F.col("a").alias("key")).agg(F.min("component").alias("heard")))
        nearer = labels.join(heard, "key").select("key", F.least("component", "heard").alias("component"), F.col("component").alias("was"))
        nearer = materialize(nearer, "labels")
        jumped = (nearer.join(nearer.select(F.col("key").alias("component"), F.col("component").alias("next")), "component")
                  .select("key", F.least("component", "next").alias("component"), "was"))
        jumped = materialize(jumped, "labels")
        labels = jumped.select("key", "component")
        if not jumped.where("component != was").limit(1).count():
            return labels


# -- classes -------------------------------------------------------------------


def near_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, key, component, class_id: one row for each row of ``docs``.

    Classes are told apart by component; class_id names one by its smallest doc_id.
    """
    known = materialize(sketches(docs), "sketches")
    nodes = known.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("n_labels").alias("n_labels"), F.first("sketch").alias("sketch"))
    nodes = materialize(nodes, "nodes")
    cells = nodes.select("key", "n_labels", F.explode("sketch").alias("cell"))
    sizes = cells.groupBy("cell").agg(F.count("*").alias("size")).where("size > 1")
    shared = materialize(cells.join(sizes, "cell"), "cells")
    ranks = shared.groupBy("key").agg(F.sum("size").alias("rank"))
    hubs = shared.join(ranks, "key").groupBy("cell").agg(F.max(F.struct("rank", "key"))["key"].alias("hub"))
    members = materialize(shared.drop("size").join(hubs, "cell"), "members")

    # the texts of all nodes that share a cell; doc_id finds them, the key confirms them
    number = id_number()
    wanted = nodes.join(shared.select("key"), "key", "left_semi").select(number.alias("number"), F.col("key").alias("near_key"))
    texts = (with_key(docs.select(number.alias("number"), "text").join(wanted.select("number"), "number", "left_semi"))
             .join(wanted, ["number", "near_key"], "left_semi")
             .dropDuplicates(["number", "near_key"]).select(F.col("near_key").alias("key"), "text"))
    texts = materialize(texts, "texts")

    compared = materialize(compare_with_hubs(members.where("key != hub").select("hub", "key").distinct(), texts), "compared")
    links = compared.where("linked").select(F.greatest("hub", "key").alias("a"), F.least("hub", "key").alias("b"))
    labels = components(links)

    placed = (members.join(labels, "key", "left")
              .select("cell", "hub", "key", "n_labels", F.coalesce("component", "key").alias("component")))
    mixed = placed.groupBy("cell").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("cell")
    # with what each member lacks of the cell's hub and has beside it, the common labels of two members are counted exactly
    open_ = materialize(placed.join(mixed, "cell", "left_semi").join(compared.drop("linked"), ["hub", "key"], "left").select(
        "cell", "key", "component", "n_labels", F.coalesce("hub_labels", "n_labels").alias("hub_labels"),
        F.coalesce("missing", F.array().cast("array<int>")).alias("missing"),
        F.coalesce("extra", F.array().cast("array<long>")).alias("extra")), "open-cells")
    x, y = open_.alias("x"), open_.alias("y")
    needed = SIMILARITY / (1 + SIMILARITY) * (F.col("x.n_labels") + F.col("y.n_labels")) - 1e-6
    most = (F.col("x.hub_labels") - F.greatest(F.size("x.missing"), F.size("y.missing")) + F.least(F.size("x.extra"), F.size("y.extra")))
    common = (F.col("x.hub_labels") - F.size(F.array_union("x.missing", "y.missing")) + F.size(F.array_intersect("x.extra", "y.extra")))
    more = (x.join(y, (F.col("x.cell") == F.col("y.cell")) & (F.col("x.component") < F.col("y.component"))
                   & (F.least("x.n_labels", "y.n_labels") >= needed) & (most >= needed) & (common >= needed))
            .select(F.greatest("x.key", "y.key").alias("a"), F.least("x.key", "y.key").alias("b")).distinct())
    further = materialize(verify(more, texts), "links-between")
    if further.limit(1).count():
        labels = components(links.union(further))

    classes = nodes.join(labels, "key", "left").select("key", "doc_id", F.coalesce("component", "key").alias("component"))
    names = classes.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    named = classes.join(names, "component").select("key", "component", "class_id")
    return known.select("doc_id", "key").join(named, "key").select("doc_id", "key", "component", "class_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest doc_id, null last."""
    narrow, restore = set_aside(docs, "doc_id", "text")
    classes = near_classes(docs.select("doc_id", "text"))
    first = F.min(F.struct(id_number().alias("number"), "key"))
    winners = classes.groupBy("component").agg(first.alias("w")).select(F.col("w.number").alias("winner_no"), F.col("w.key").alias("winner_key"))
    kept = (with_key(narrow).join(winners, (id_number() == F.col("winner_no")) & (F.col("near_key") == F.col("winner_key")), "left_semi")
            .dropDuplicates(["doc_id", "near_key"]))
    return restore(kept)


def op8_near_dedup(spark, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near_classes(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "class_id")
