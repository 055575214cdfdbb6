"""Substring dedup: prefix-partitioned suffix trees over words, kept to what they need.

A repeat is a run of at least ``WINDOW`` words that also starts earlier (in a
document with a smaller id, or earlier in the same document).  In a suffix tree
of all texts these are the nodes at a depth of ``WINDOW`` words or more with
several leaves, and every leaf but the first marks words to remove.  Deeper
nodes only chain nodes of that depth, so subtrees are built to that depth and
their edges are held as fingerprints of the words they spell.

1. Prefixes.  Every suffix of ``WINDOW`` words is filed under the run of
   ``PREFIX`` words in it that has the smallest hash.  Neighbouring suffixes
   mostly share it, so they travel as one row, and equal suffixes always do.
   The rows are counted by prefix; a prefix that stands in one place only has a
   subtree without inner nodes and is dropped.
2. Subtrees.  The suffixes under the other prefixes are sent to groups by
   prefix.  A prefix with more than ``MEMORY`` runs would not fit a group:
   its suffixes are split by their longer prefix, the whole window.  These
   prefixes, at most one for each ``MEMORY`` runs, are listed before any suffix
   is sent, so where a suffix goes depends on its words alone.  Within a
   group, sorting by label brings the leaves of a node together.
3. Removal.  Marked windows go back to their document.

Before each exchange a task keeps only the first of its equal labels, so a
passage that a third of all documents share costs one row for each part of a
task's input.  Labels are 96-bit hashes; two different windows are taken for
equal with a chance of about n*n / 2**97.

Defined cases: a null text has no words; documents that share an id are taken
in order of their texts, equal rows in any order; a null id counts as the
largest; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import BASE_A, BASE_B, U64, WordBatch, partitions, span_hashes, table, text_groups

WINDOW, PREFIX = 20, 8
MEMORY = 1 << 20

_RUNS = "group int, label binary, number binary, place binary, start binary, length binary, settled binary"
_SUFFIXES = "group int, high binary, low binary, number binary, place binary, start binary, settled binary"
#: Runs of windows of one document: place (which of the documents of that id), start, length, prefix bits.
_MARK = np.dtype([("place", "<u4"), ("start", "<u4"), ("length", "<u4"), ("prefix", "<u4")])
_MARKED = "number long, marks binary"
_CROWDED = "prefixes binary"


def _steps(values: np.ndarray, kind: str) -> bytes:
    """Differences of neighbours, all lowest bytes first, then all next ones: they compress well in a shuffle."""
    steps = np.diff(values.astype(kind), prepend=np.zeros(1, kind))
    return steps.view(np.uint8).reshape(-1, steps.itemsize).T.tobytes()


def _unsteps(parts: list[bytes], kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    steps = (np.ascontiguousarray(np.frombuffer(p, np.uint8).reshape(size, -1).T).view(kind).ravel() for p in parts)
    return np.concatenate([np.cumsum(s, dtype=kind) for s in steps] or [np.zeros(0, kind)])


def _joined(parts: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(parts), kind)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours."""
    best, reach = values, 1
    while reach * 2 <= width:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(best[:len(best) - rest], best[rest:]) if rest else best


class _Windows:
    """All windows of a batch of texts: word number, text, prefix label."""

    def __init__(self, texts: list[str | None]):
        self.words = WordBatch(texts)
        self.ids = self.words.ids(BASE_A)
        n = len(self.ids)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.words.first))
        self.valid = np.zeros(0, bool)
        if n >= WINDOW:
            at = np.arange(n - PREFIX + 1)
            self.grams = span_hashes(self.ids, at, at + PREFIX, BASE_B)
            self.prefix = _sliding_least(self.grams, WINDOW - PREFIX + 1)
            at = np.arange(n - WINDOW + 1)
            self.valid = at + WINDOW <= self.words.first[1:][self.doc[:len(at)]]


def _blocks(group: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each group number and the rows that are in it."""
    order = np.argsort(group, kind="stable")
    numbers, begin = np.unique(group[order], return_index=True)
    for g, part in zip(numbers.tolist(), np.split(order, begin[1:])):
        yield g, part


def _spread(number: np.ndarray, groups: int) -> np.ndarray:
    return ((number.astype(U64) * U64(BASE_A)) >> U64(33)).astype(np.int64) % groups


def prefix_runs(docs: DataFrame, groups: int) -> DataFrame:
    """(number, place, text) -> runs of windows that share a prefix, packed by group."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, places, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist()
            rows = []
            for a, b in text_groups(texts):
                w = _Windows(texts[a:b])
                if not w.valid.any():
                    continue
                at = np.flatnonzero(w.valid)
                label = w.prefix[at]
                new = np.ones(len(at), bool)
                new[1:] = (label[1:] != label[:-1]) | (at[1:] != at[:-1] + 1)
                begin = np.flatnonzero(new)
                length = np.diff(np.append(begin, len(at)))
                label, at = label[begin], at[begin]
                # a run in which the prefix stands twice may hold equal windows itself
                span = length + WINDOW - PREFIX
                offset = np.cumsum(span) - span
                inside = np.repeat(at - offset, span) + np.arange(span.sum())
                twice = np.add.reduceat(w.grams[inside] == np.repeat(label, span), offset, dtype=np.int64) > 1
                doc = w.doc[at]
                start, number, place = at - w.words.first[doc], numbers[a:b][doc], places[a:b][doc]
                _, first, inverse, count = np.unique(label, return_index=True, return_inverse=True, return_counts=True)
                settled = twice | (count[inverse] > 1)
                # of equal labels here only the first asks elsewhere, and tells how many there are
                is_first = first[inverse] == np.arange(len(label))
                group = np.where(is_first, (label >> U64(40)).astype(np.int64) % groups, _spread(number, groups))
                weight = np.where(is_first, np.minimum(count[inverse], 1 << 30), 0)
                for g, part in _blocks(group):
                    rows.append((g, label[part].tobytes(), _steps(number[part], "<i8"), _steps(place[part], "<u4"),
                                 _steps(start[part], "<i4"), length[part].astype("<u4").tobytes(),
                                 (weight[part] << 1 | settled[part]).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_pylist([dict(zip(("group", "label", "number", "place", "start", "length", "settled"), r)) for r in rows],
                                             schema=_arrow(_RUNS))

    return docs.select("number", "place", "text", "doc_id").mapInArrow(runs, _RUNS)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def _by_document(number: np.ndarray, marks: np.ndarray) -> pa.Table:
    """One row for each document with its marks."""
    order = np.lexsort((marks["start"], marks["place"], number))
    number, marks = number[order], marks[order]
    numbers, begin = np.unique(number, return_index=True)
    raw, size = marks.tobytes(), marks.dtype.itemsize
    bounds = np.append(begin, len(number)).tolist()
    return pa.table({"number": pa.array(numbers, pa.int64()),
                     "marks": pa.array([raw[a * size:b * size] for a, b in zip(bounds, bounds[1:])], pa.binary())})


def repeated_prefixes(rows: pa.Table) -> pa.Table:
    """One group of runs -> the runs whose prefix occurs again, by document."""
    c = {n: rows[n].to_pylist() for n in rows.column_names}
    label, number, place = _joined(c["label"], "<u8"), _unsteps(c["number"], "<i8"), _unsteps(c["place"], "<u4")
    start, length, settled = _unsteps(c["start"], "<i4"), _joined(c["length"], "<u4"), _joined(c["settled"], "<u4")
    # rows that are not their task's first carry no weight and are sent here only to be passed on
    asks = settled >> 1 > 0
    total = np.zeros(len(label))
    _, inverse = np.unique(label[asks], return_inverse=True)
    total[asks] = np.bincount(inverse, (settled[asks] >> 1))[inverse] if len(inverse) else 0
    kept = (settled & 1 == 1) | (total > 1)
    marks = np.zeros(int(kept.sum()), _MARK)
    marks["place"], marks["start"], marks["length"] = place[kept], start[kept], length[kept]
    marks["prefix"] = (label[kept] >> U64(32)).astype(np.uint32)
    return _by_document(number[kept], marks)


def crowded_prefixes(memory: int):
    """A function of one group of runs: the bits of the prefixes that more than ``memory`` runs share, as one row."""

    def crowded(rows: pa.Table) -> pa.Table:
        label, settled = (_joined(rows[n].to_pylist(), kind) for n, kind in (("label", "<u8"), ("settled", "<u4")))
        # all runs of a label are told here by those that are their task's first
        asks = settled >> 1 > 0
        prefixes, inverse = np.unique(label[asks] >> U64(32), return_inverse=True)
        total = np.bincount(inverse, settled[asks] >> 1, minlength=len(prefixes))
        return pa.table({"prefixes": pa.array([prefixes[total > memory].astype("<u4").tobytes()], pa.binary())})

    return crowded


def suffixes(docs: DataFrame, groups: int) -> DataFrame:
    """(number, place, text, marks, crowded) -> the labels of marked windows, packed by group."""

    def labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, places = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts, lists = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            # the same list in every row
            crowded = _joined(batch.column(4)[0].as_py() if len(texts) else [], "<u4")
            rows = []
            for a, b in text_groups(texts):
                words = WordBatch(texts[a:b])
                marks = [_joined(x, _MARK) for x in lists[a:b]]
                doc = np.repeat(np.arange(b - a), [len(m) for m in marks])
                marks = np.concatenate(marks)
                own = marks["place"] == places[a:b][doc]
                marks, doc = marks[own], doc[own]
                if not len(marks):
                    continue
                length = marks["length"].astype(np.int64)
                nth = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
                doc = np.repeat(doc, length)
                start = np.repeat(marks["start"].astype(np.int64), length) + nth
                at = words.first[doc] + start
                high = span_hashes(words.ids(BASE_A), at, at + WINDOW, BASE_B)
                low = (span_hashes(words.ids(BASE_B), at, at + WINDOW, BASE_A) >> U64(32)).astype(np.uint32)
                number, place = numbers[a:b][doc], places[a:b][doc]
                order = np.lexsort((start, place, number, low, high))
                again = np.zeros(len(order), bool)
                again[order[1:]] = (high[order[1:]] == high[order[:-1]]) & (low[order[1:]] == low[order[:-1]])
                split = np.repeat(np.isin(marks["prefix"], crowded), length)
                home = np.where(split, high >> U64(32), np.repeat(marks["prefix"], length).astype(U64))
                group = np.where(again, _spread(number, groups), (home % U64(groups)).astype(np.int64))
                for g, part in _blocks(group):
                    rows.append((g, high[part].tobytes(), low[part].tobytes(), _steps(number[part], "<i8"), _steps(place[part], "<u4"),
                                 _steps(start[part], "<i4"), again[part].tobytes()))
            yield pa.RecordBatch.from_pylist([dict(zip(("group", "high", "low", "number", "place", "start", "settled"), r)) for r in rows],
                                             schema=_arrow(_SUFFIXES))

    return docs.select("number", "place", "text", "marks", "crowded", "doc_id").mapInArrow(labels, _SUFFIXES)


def later_leaves(rows: pa.Table) -> pa.Table:
    """One group of suffixes -> all leaves of its deep nodes but each node's first, by document, as runs."""
    c = {n: rows[n].to_pylist() for n in rows.column_names}
    high, low, number = _joined(c["high"], "<u8"), _joined(c["low"], "<u4"), _unsteps(c["number"], "<i8")
    place, start, settled = _unsteps(c["place"], "<u4"), _unsteps(c["start"], "<i4"), _joined(c["settled"], "?")
    ask = np.flatnonzero(~settled)
    order = ask[np.lexsort((start[ask], place[ask], number[ask], low[ask], high[ask]))]
    later = settled.copy()
    later[order[1:]] = (high[order[1:]] == high[order[:-1]]) & (low[order[1:]] == low[order[:-1]])
    number, place, start = number[later], place[later], start[later]
    order = np.lexsort((start, place, number))
    number, place, start = number[order], place[order], start[order]
    new = np.ones(len(start), bool)
    new[1:] = (number[1:] != number[:-1]) | (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
    begin = np.flatnonzero(new)
    marks = np.zeros(len(begin), _MARK)
    marks["place"], marks["start"] = place[begin], start[begin]
    marks["length"] = np.diff(np.append(begin, len(start)))
    return _by_document(number[begin], marks)


def _removal(docs: DataFrame) -> DataFrame:
    """(doc_id, place, text, marks) -> doc_id, n_words, removed, kept_text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(1).to_pylist()
            counts, spans, kept = [], [], []
            for text, place, blobs in zip(batch.column(2).to_pylist(), places, batch.column(3).to_pylist()):
                words = (text or "").encode("utf-8").split()
                marks = _joined(blobs or [], _MARK)
                marks = marks[marks["place"] == place]
                counts.append(len(words))
                if not len(marks):
                    spans.append([])
                    kept.append(b" ".join(words))
                    continue
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, marks["start"], 1)
                np.add.at(edge, marks["start"] + marks["length"] + (WINDOW - 1), -1)
                gone = np.cumsum(edge[:-1]) > 0
                bounds = np.flatnonzero(np.diff(gone.view(np.int8), prepend=0, append=0))
                spans.append([{"start": s, "end": e} for s, e in bounds.reshape(-1, 2).tolist()])
                kept.append(b" ".join(compress(words, ~gone)))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "removed", "kept_text"])

    return docs.mapInArrow(cut, "doc_id long, n_words long, removed array<struct<start: long, end: long>>, kept_text string")


def remove_repeats(docs: DataFrame, memory: int | None = None) -> DataFrame:
    """(doc_id, text) -> doc_id, n_words, removed (spans of words, end exclusive), kept_text.

    A prefix with more than ``memory`` runs (``MEMORY`` if None) is split.
    """
    n = partitions(docs.sparkSession)
    groups = 4 * n
    number: Column = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    placed = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), number.alias("number"), "text").repartition(n, "number")
              .withColumn("place", F.row_number().over(Window.partitionBy("number").orderBy("text")) - 1))

    # every branch below asks for the same columns of ``placed``, so its exchange is written once and read three times
    def back(marked: DataFrame) -> DataFrame:
        return marked.groupBy("number").agg(F.collect_list("marks").alias("marks"))

    # the exchange by group is written once, too
    runs = prefix_runs(placed, groups).groupBy("group")
    prefixes = runs.applyInArrow(repeated_prefixes, _MARKED)
    crowded = (runs.applyInArrow(crowded_prefixes(MEMORY if memory is None else memory), _CROWDED).where(F.length("prefixes") > 0)
               .agg(F.sort_array(F.collect_list("prefixes")).alias("crowded")))
    labels = suffixes(placed.join(back(prefixes), "number").crossJoin(F.broadcast(crowded)), groups)
    leaves = labels.groupBy("group").applyInArrow(later_leaves, _MARKED)
    return _removal(placed.join(back(leaves), "number", "left").select("doc_id", "place", "text", "marks"))


def op5_substrings(spark, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated passages."""
    return (remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
            .select("doc_id", "n_words", F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("n_removed"),
                    F.sha2(F.col("kept_text"), 256).alias("kept_sha256")))
