"""Similarity join of documents by Jaccard of word n-grams, on prefix trees.

A document is the set of its distinct four-word shingles; two documents link
when 100 * common >= 85 * together.  Equal sets are one node of the join.

1. ``shared_counts`` deals all shingles into buckets and counts, for every set,
   those that another set has too.  A linked set shares at least 85 % of its
   own, so all others are done; shingles travel once, four bytes each.
2. The shingles of the rest get a global order: the less frequent first.  Two
   linked sets meet in a shingle of their prefixes, the first n - 0.85 n + 1.
3. Rounds of cells (sets that agree in the smallest value of a hash function)
   compare all their sets, and so settle most pairs, linked or not.
4. What they left is settled exactly.  Only prefix shingles whose sets are
   still in several components can hold new links; of those with the same sets,
   one is enough.  Sets of such a group are candidates if they are in different
   components, met in no cell before, and could have enough in common by their
   sizes and by what follows the shingle in either.  Where one component fills
   most of a group, its members meet the others only, not each other.  Each set
   with candidates has a cell with them.

A cell holds a bounded number of shingles: larger ones are cut into blocks.  In
a cell the sets, all in one order, form a trie with whole runs as edges.  Each
set that asks goes down the trie, so sets that share a beginning share the count
of common shingles, and a subtree is left where

* its sets are all too small or too large,
* the count so far and what is left of either set, at most, make too few, or
* its sets are all in the component of the one that asks.

Shingles are 64-bit hashes, sets are told apart by 128 bits.

Defined cases: a null text, or one without words, is an empty set, linked with
nothing; fewer than four words are one shingle; words differ by everything but
the case of A to Z; repeated rows are copies; a document without an id has a
component, which is named by its smallest id that is not null; an empty table
gives an empty result; other columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import BASE_A, BASE_B, U64, WordBatch, id_number, materialize, mix64, partitions, span_hashes, table, text_groups
from millrace.llm.omh import components

WIDTH, LEAST = 4, 85
#: Characters of a batch of texts, and mean numbers of sets and of shingles in a block of a cell.
BATCH, BLOCK_SETS, BLOCK_SHINGLES = 1 << 22, 2048, 1 << 20
ROUNDS = 4
#: Bits of the map of wanted rows (a multiple of 32768): 16 MB.
SPOTS = 1 << 27


def enough(common, one, other):
    """Whether sets of the given sizes with so many common elements link."""
    return (100 + LEAST) * common >= LEAST * (one + other)


# -- sets ------------------------------------------------------------------------


class Sets:
    """Distinct shingles of a list of texts: ``values`` in order of (text, hash), ``sizes`` and a 16-byte key of each set."""

    def __init__(self, texts: list[str | None], width: int = WIDTH):
        words = WordBatch([t and t.encode("utf-8").lower().decode("utf-8") for t in texts])   # bytes lower A to Z only
        count = np.diff(words.first)
        doc = np.repeat(np.arange(len(texts)), count)
        at, end = np.arange(len(doc)), words.first[1:][doc]
        begin = np.flatnonzero((end - at >= width) | (at == words.first[:-1][doc]))
        values = span_hashes(words.ids(BASE_A), begin, np.minimum(begin + width, end[begin]), BASE_B)
        doc = doc[begin]
        order = np.lexsort((values, doc))
        values, doc = values[order], doc[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
        self.values, self.doc = values[new], doc[new]
        self.sizes = np.bincount(self.doc, minlength=len(texts))
        self.first = np.concatenate(([0], np.cumsum(self.sizes)))
        sums = [self._sum(mix64(self.values ^ U64(seed))) for seed in (BASE_A, BASE_B)]
        self.keys = np.stack([mix64(s + self.sizes.astype(U64)) for s in sums], 1)

    def _sum(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate((np.zeros(1, U64), np.cumsum(values, dtype=U64)))
        return total[self.first[1:]] - total[self.first[:-1]]

    def key_array(self) -> pa.Array:
        return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(self.keys), [None, pa.py_buffer(self.keys.tobytes())]).cast(pa.binary())


def _dealt(values: np.ndarray, sizes: np.ndarray, parts: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every bucket: the values that fall into it, set by set, and how many of each set."""
    bucket = ((values >> U64(32)) % U64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(parts + 1))
    for p in range(parts):
        some = order[bounds[p]:bounds[p + 1]]
        yield values[some], np.bincount(owner[some], minlength=len(sizes)).astype(np.uint32)


def _bucket(values: np.ndarray, counts: np.ndarray, keys: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """What of a batch goes to a bucket: 32 bits of its values, which sets have any (a bit each), and their counts and keys."""
    present = counts > 0
    return values.astype(np.uint32).tobytes(), np.packbits(present).tobytes(), counts[present].tobytes(), keys[present].tobytes()


def _batch_name(number: int, content: bytes) -> str:
    """Batches are numbered in their task; the checksum tells apart what a repeated task may have read in another order."""
    return f"{TaskContext.get().partitionId()}-{number}-{zlib.crc32(content):08x}"


def _complete(batch: pa.Table, parts: int) -> pa.Table:
    if batch.num_rows != parts:
        raise RuntimeError(f"a batch came back with {batch.num_rows} of {parts} buckets: its task read its input in another order when repeated")
    return batch


def _bounds(counts: np.ndarray) -> np.ndarray:
    """Where each of some runs of the given lengths begins, and the end of the last."""
    return np.concatenate(([0], np.cumsum(counts.astype(np.int64))))


def _u4(column, k: int) -> np.ndarray:
    return np.frombuffer(column[k].as_buffer(), np.uint32)


def shared_counts(docs: DataFrame, parts: int) -> DataFrame:
    """(doc_id, text_hash, text) -> doc_id, text_hash, set_key, n (shingles), shared (those that another set has too).

    ``shared`` may count a shingle too many where 32 bits and the bucket agree by
    chance, never one too few.  A bucket gets the keys and counts of those sets
    only that have shingles in it, so what travels does not grow with the number
    of buckets but with the shingles.
    """
    dealt = ("part int, batch string, hashes binary, present binary, counts binary, keys binary, "
             "doc_ids array<long>, text_hashes array<long>, which binary, set_keys binary, sizes binary")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in text_groups(texts, BATCH):
                sets = Sets(texts[a:b])
                # equal sets of a batch travel once
                _, one, which = np.unique(sets.keys[:, 0] ^ mix64(sets.keys[:, 1]), return_index=True, return_inverse=True)
                chosen = np.zeros(b - a, bool)
                chosen[one] = True
                place = np.cumsum(chosen) - 1
                which = place[one][which].astype(np.uint32)
                sizes, keys = sets.sizes[chosen], sets.keys[chosen]
                name = _batch_name(number, sets.keys.tobytes())
                number += 1
                rows = []
                for p, (values, counts) in enumerate(_dealt(sets.values[chosen[sets.doc]], sizes, parts)):
                    first = p == 0
                    rows.append((p, name, *_bucket(values, counts, keys[:, 0]),
                                 batch.column(0).slice(a, b - a).to_pylist() if first else None,
                                 batch.column(1).slice(a, b - a).to_pylist() if first else None,
                                 which.tobytes() if first else None, keys.tobytes() if first else None,
                                 sizes.astype(np.uint32).tobytes() if first else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    longs = pa.list_(pa.int64())
    names = ["part", "batch", "hashes", "present", "counts", "keys", "doc_ids", "text_hashes", "which", "set_keys", "sizes"]
    types = [pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), longs, longs, pa.binary(), pa.binary(), pa.binary()]

    def count(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        counts = [_u4(rows["counts"], k) for k in range(rows.num_rows)]
        keys = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in rows["keys"]])
        owner = np.repeat(np.arange(len(keys)), np.concatenate(counts))
        values = np.concatenate([_u4(rows["hashes"], k) for k in range(rows.num_rows)])
        shared = np.zeros(len(keys), np.uint32)
        if len(values):
            order = np.argsort(values, kind="stable")
            owner = owner[order]
            start = np.flatnonzero(np.concatenate(([True], values[order][1:] != values[order][:-1])))
            key = keys[owner]
            several = np.minimum.reduceat(key, start) != np.maximum.reduceat(key, start)
            several = np.repeat(several, np.diff(np.append(start, len(values))))
            shared = np.bincount(owner[several], minlength=len(keys)).astype(np.uint32)
        cut = np.concatenate(([0], np.cumsum([len(c) for c in counts])))
        found = pa.array([shared[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())
        return rows.select(["batch", "present", "doc_ids", "text_hashes", "which", "set_keys", "sizes"]).append_column("shared", found)

    def gather(rows: pa.Table) -> pa.Table:
        rows = _complete(rows, parts)
        head = next(k for k in range(rows.num_rows) if rows["which"][k].is_valid)
        which, keys, sizes = _u4(rows["which"], head), rows["set_keys"][head].as_py(), _u4(rows["sizes"], head).astype(np.int64)
        shared = np.zeros(len(sizes), np.int64)
        for k in range(rows.num_rows):
            present = np.unpackbits(np.frombuffer(rows["present"][k].as_buffer(), np.uint8), count=len(sizes)).view(bool)
            shared[present] += _u4(rows["shared"], k)
        return pa.Table.from_arrays(
            [rows["doc_ids"][head].values, rows["text_hashes"][head].values, pa.array([keys[16 * u:16 * u + 16] for u in which.tolist()], pa.binary()),
             pa.array(sizes[which]), pa.array(shared[which])], names=["doc_id", "text_hash", "set_key", "n", "shared"])

    counted = docs.mapInArrow(deal, dealt).groupBy("part").applyInArrow(
        count, "batch string, present binary, doc_ids array<long>, text_hashes array<long>, which binary, set_keys binary, sizes binary, shared binary")
    return counted.groupBy("batch").applyInArrow(gather, "doc_id long, text_hash long, set_key binary, n long, shared long")


def ordered_sets(sets: DataFrame, parts: int) -> DataFrame:
    """(set_key, n, shingles) -> set_key, n, shingles: those that several sets have, the least frequent first."""
    names = ["part", "batch", "shingles", "counts", "keys", "sizes"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            every = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(2)]
            bounds, held = [0], 0
            for k, own in enumerate(every):   # batches of bounded size
                held += len(own)
                if k > bounds[-1] and held > BATCH >> 3:
                    bounds.append(k)
                    held = len(own)
            for a, b in zip(bounds, [*bounds[1:], len(every)] if every else []):
                keys, sizes = b"".join(batch.column(0).slice(a, b - a).to_pylist()), batch.column(1).slice(a, b - a).to_numpy()
                name = _batch_name(number, keys)
                number += 1
                found = _dealt(np.concatenate(every[a:b]), np.array([len(x) for x in every[a:b]]), parts)
                rows = [(p, name, values.tobytes(), counts.tobytes(), None if p else keys, None if p else sizes.tobytes()) for p, (values, counts) in enumerate(found)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    types = [pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]

    def count(rows: pa.Table) -> pa.Table:
        values = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows["shingles"]]
        _, code, times = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
        times = times[code].astype(np.uint32)
        cut = np.concatenate(([0], np.cumsum([len(v) for v in values])))
        out = []
        for k, value in enumerate(values):
            own = times[cut[k]:cut[k + 1]]
            kept = own > 1
            total = np.concatenate(([0], np.cumsum(kept)))
            left = np.diff(total[_bounds(_u4(rows["counts"], k))])
            out.append((rows["batch"][k].as_py(), value[kept].tobytes(), own[kept].tobytes(), left.astype(np.uint32).tobytes(),
                        rows["keys"][k].as_py(), rows["sizes"][k].as_py()))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types[1:2] + [pa.binary()] * 5)],
                                    names=["batch", "shingles", "times", "counts", "keys", "sizes"])

    def gather(rows: pa.Table) -> pa.Table:
        rows = _complete(rows, parts)
        values = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in rows["shingles"]])
        times = np.concatenate([_u4(rows["times"], k) for k in range(rows.num_rows)])
        owner = np.concatenate([np.repeat(np.arange(len(c)), c) for c in (_u4(rows["counts"], k) for k in range(rows.num_rows))])
        order = np.lexsort((values, times, owner))
        head = next(k for k in range(rows.num_rows) if rows["keys"][k].is_valid)
        keys, sizes = rows["keys"][head].as_py(), np.frombuffer(rows["sizes"][head].as_buffer(), np.int64)
        cut = np.searchsorted(owner[order], np.arange(len(sizes) + 1)).tolist()
        values = values[order]
        return pa.Table.from_arrays(
            [pa.array([keys[16 * u:16 * u + 16] for u in range(len(sizes))], pa.binary()), pa.array(sizes),
             pa.array([values[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())], names=["set_key", "n", "shingles"])

    counted = (sets.select("set_key", "n", "shingles").mapInArrow(deal, "part int, batch string, shingles binary, counts binary, keys binary, sizes binary")
               .groupBy("part").applyInArrow(count, "batch string, shingles binary, times binary, counts binary, keys binary, sizes binary"))
    return counted.groupBy("batch").applyInArrow(gather, "set_key binary, n long, shingles binary")


# -- the prefix tree ---------------------------------------------------------------


class PrefixTree:
    """A trie over sets of ranks, each in rising order, with runs as edges.

    The sets are sorted, so every node covers a range of them, and its edge is a
    slice of the first one.  Nodes 0 to len(sets) - 1 are the sets' ends.
    """

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        self.order = sorted(range(len(sets)), key=lambda k: sets[k].astype(">u4").tobytes())
        chosen = [sets[k] for k in self.order]
        self.sizes = sizes[self.order]
        lengths = np.array([len(s) for s in chosen])
        self.flat = np.concatenate(chosen) if chosen else np.zeros(0, np.int64)
        offset = np.concatenate(([0], np.cumsum(lengths)))
        self.leaves = leaves = len(chosen)
        depth, low, high, parent = lengths.tolist() + [0], list(range(leaves)) + [0], list(range(1, leaves + 1)) + [leaves], [-1] * (leaves + 1)
        stack = [leaves]   # the root
        for i in range(1, leaves + 1):
            same = 0
            if i < leaves:
                a, b = chosen[i - 1], chosen[i]
                m = min(len(a), len(b))
                differ = np.flatnonzero(a[:m] != b[:m])
                same = int(differ[0]) if len(differ) else m
            child = i - 1
            while depth[stack[-1]] > same:
                top = stack.pop()
                high[top], parent[child] = i, top
                child = top
            if depth[stack[-1]] < same:
                depth.append(same), low.append(low[child]), high.append(i), parent.append(-1)
                stack.append(len(depth) - 1)
            parent[child] = stack[-1]
        self.depth, self.low, self.high = np.array(depth), np.array(low), np.array(high)
        self.parent = np.array(parent)
        above = self.depth[np.maximum(self.parent, 0)]
        self.above = np.where(self.parent < 0, 0, above)
        self.edge = offset[self.low] + self.above
        self.least, self.most = self.over(np.minimum, self.sizes), self.over(np.maximum, self.sizes)
        self.longest = self.over(np.maximum, lengths)
        self.children = np.argsort(self.parent, kind="stable")[1:]   # without the root
        self.first = np.searchsorted(self.parent[self.children], np.arange(len(depth) + 1))

    def over(self, what: np.ufunc, values: np.ndarray) -> np.ndarray:
        """``what`` over the sets below each node."""
        ends = np.stack([self.low, self.high], 1).ravel()
        return what.reduceat(np.append(values, values[-1:]), ends)[::2] if len(values) else np.zeros(len(self.low), np.int64)

    def below(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The children of ``nodes``, and for each the place of its parent among them."""
        count = self.first[nodes + 1] - self.first[nodes]
        which = np.repeat(np.arange(len(nodes)), count)
        return self.children[np.repeat(self.first[nodes] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())], which

    def linked(self, own: np.ndarray, size: int, hit: np.ndarray, closed: np.ndarray) -> np.ndarray:
        """The sets (places in sorted order) that link with ``own``; ``hit`` marks its ranks, ``closed`` marks nodes to leave."""
        nodes, which = self.below(np.array([self.leaves]))
        common, passed = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
        found = []
        while len(nodes):
            length = self.depth[nodes] - self.above[nodes]
            could = common + np.minimum(len(own) - passed, self.longest[nodes] - self.above[nodes])
            kept = (~closed[nodes] & (100 * self.most[nodes] >= LEAST * size) & (LEAST * self.least[nodes] <= 100 * size)
                    & enough(could, size, self.least[nodes]))
            nodes, common, passed, length = nodes[kept], common[kept], passed[kept], length[kept]
            if not len(nodes):
                break
            end = np.cumsum(length)
            run = self.flat[np.repeat(self.edge[nodes] - (end - length), length) + np.arange(end[-1])]
            hits = np.concatenate(([0], np.cumsum(hit[run])))
            common = common + hits[end] - hits[end - length]
            some = length > 0
            passed = passed.copy()
            passed[some] = np.searchsorted(own, run[end[some] - 1], "right")
            leaf = nodes < self.leaves
            ends = nodes[leaf]
            found.append(ends[enough(common[leaf], size, self.sizes[ends])])
            inner = np.flatnonzero(~leaf)
            nodes, which = self.below(nodes[inner])
            common, passed = common[inner][which], passed[inner][which]
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def cell_links(shingles: list[np.ndarray], sizes: np.ndarray, group: np.ndarray, asks: np.ndarray, told: np.ndarray) -> list[tuple[int, int]]:
    """Links between the sets that ``asks`` and those that ``told`` marks, as many as connect what belongs together.

    ``group`` numbers components, from 0; no links within one are sought.  The
    order of shingles is the cell's own, again the less frequent first.
    """
    values, code, times = np.unique(np.concatenate(shingles), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, times))] = np.arange(len(values))
    cut = np.concatenate(([0], np.cumsum([len(s) for s in shingles])))
    ranks = [np.sort(rank[code[a:b]]) for a, b in zip(cut, cut[1:])]
    members = np.flatnonzero(told)
    tree = PrefixTree([ranks[k] for k in members], sizes[members])
    members = members[tree.order]
    root = np.arange(int(group.max()) + 1)
    hit = np.zeros(len(values), bool)
    links: list[tuple[int, int]] = []

    def lowest_and_highest() -> tuple[np.ndarray, np.ndarray]:
        roots = root[group[members]]
        return tree.over(np.minimum, roots), tree.over(np.maximum, roots)

    low, high = lowest_and_highest()
    for k in np.flatnonzero(asks):
        mine = root[group[k]]
        hit[ranks[k]] = True
        ends = tree.linked(ranks[k], int(sizes[k]), hit, (low == mine) & (high == mine))
        hit[ranks[k]] = False
        joined = False
        for other in members[ends].tolist():
            theirs = root[group[other]]
            if theirs != root[group[k]]:
                links.append((int(k), other))
                root[root == theirs] = root[group[k]]
                joined = True
        if joined:
            low, high = lowest_and_highest()
    return links


def cell_by_cell(rows: DataFrame, work: Callable[[pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` on the rows of each cell; its name is in the columns c1, c2, c3, which come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        cell = None
        for batch in batches:
            cells = list(zip(*(batch.column(k).to_pylist() for k in range(3))))
            bounds = [0] + [k for k in range(1, len(cells)) if cells[k] != cells[k - 1]] + [len(cells)]
            for a, b in zip(bounds, bounds[1:]):
                if a == b:
                    continue
                if held and cells[a] != cell:
                    yield work(pa.Table.from_batches(held))
                    held = []
                cell = cells[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield work(pa.Table.from_batches(held))

    parts = partitions(rows.sparkSession)
    return rows.repartition(parts, "c1", "c2", "c3").sortWithinPartitions("c1", "c2", "c3").mapInArrow(run, schema)


def links_in_cells(rows: DataFrame) -> DataFrame:
    """(cell columns c1, c2, c3; set_key, component, asks, told, n, shingles) -> a, b: links found in the cells."""
    names = ["c1", "c2", "c3", "set_key", "component", "asks", "told", "n", "shingles"]

    def links(rows: pa.Table) -> pa.RecordBatch:
        keys = rows["set_key"].to_pylist()
        group = rows["component"].combine_chunks().dictionary_encode().indices.to_numpy()
        found = cell_links([np.frombuffer(x.as_buffer(), np.uint64) for x in rows["shingles"]], rows["n"].to_numpy(), group, rows["asks"].to_numpy(zero_copy_only=False), rows["told"].to_numpy(zero_copy_only=False))
        pairs = [(max(keys[x], keys[y]), min(keys[x], keys[y])) for x, y in found]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return cell_by_cell(rows.select(*names), links, "a binary, b binary")


# -- the join ------------------------------------------------------------------------


def _smallest(sets: DataFrame, rounds: int) -> DataFrame:
    """set_key, size and the smallest value of each hash function over the set's shingles."""

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(1)]
            found = [[int(mix64(v ^ U64((r + 3) * BASE_B % (1 << 64))).min().view(np.int64)) for r in range(rounds)] for v in every]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(v) for v in every], pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["set_key", "size", "least"])

    return sets.select("set_key", "shingles").mapInArrow(smallest, "set_key binary, size long, least array<long>")


def _prefixes(sets: DataFrame) -> DataFrame:
    """(set_key, component, n, shingles) -> set_key, component, n, place (in the set's order), shingle: one row for
    each shared shingle of the prefix."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                every = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column(3)]
                n, size = part.column(2).to_numpy(), np.array([len(v) for v in every])
                # the shingles that no other set has come first, and take up part of the prefix
                long = np.minimum(np.maximum(n - (LEAST * n + 99) // 100 + 1 - (n - size), 0), size)
                again = np.repeat(np.arange(len(every)), long)
                place = np.arange(len(again)) - np.repeat(np.cumsum(long) - long, long) + (n - size)[again]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(again)), part.column(1).take(pa.array(again)), pa.array(n[again]), pa.array(place),
                     pa.array(np.concatenate([v[:m] for v, m in zip(every, long)]))], names=["set_key", "component", "n", "place", "shingle"])

    return sets.select("set_key", "component", "n", "shingles").mapInArrow(
        prefixes, "set_key binary, component binary, n long, place long, shingle long")


def chosen_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text) -> set_key, n, shingles of the rows that ``wanted`` (number, text_hash) names, and of few others.

    A bitmap of fixed size goes to all tasks, so texts stay where they are
    read.  It may let other rows pass, the more the fuller it is, and never
    stops a wanted one; the caller joins the result with what it wants.
    """
    spark = docs.sparkSession
    spot = F.pmod(F.xxhash64(id_number().alias("number"), "text_hash"), F.lit(SPOTS))
    marks = (wanted.withColumn("spot", F.pmod(F.xxhash64("number", "text_hash"), F.lit(SPOTS)))
             .groupBy(F.expr("spot div 32768").alias("at")).agg(F.bitmap_construct_agg(F.col("spot") % 32768).alias("marks")).collect())
    bits = np.zeros(SPOTS >> 3, np.uint8)
    for r in marks:
        bits[r["at"] << 12:(r["at"] + 1) << 12] = np.frombuffer(r["marks"], np.uint8)
    shared = spark.sparkContext.broadcast(bits)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_numpy()
            texts = batch.column(1).filter(pa.array((shared.value[at >> 3] >> (at & 7)) & 1 > 0)).to_pylist()
            for a, b in text_groups(texts, BATCH):
                sets = Sets(texts[a:b])
                bounds = sets.first.tolist()
                yield pa.RecordBatch.from_arrays(
                    [sets.key_array(), pa.array(sets.sizes.astype(np.int64)),
                     pa.array([sets.values[x:y].tobytes() for x, y in zip(bounds, bounds[1:])], pa.binary())], names=["set_key", "n", "shingles"])

    return docs.select(spot.alias("spot"), "text").mapInArrow(build, "set_key binary, n long, shingles binary")


def _grows(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the documents: it is shuffled at every size, never broadcast."""
    return side.hint("merge")


def _blocks(sets, shingles):
    """How many blocks hold so many sets and shingles."""
    return F.greatest(F.ceil(sets / BLOCK_SETS), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def _first_cells(sets: DataFrame, rounds: int) -> DataFrame:
    """set_key, c1, c2, c3: cells of sets that agree in the smallest value of a hash function, cut into blocks at random."""
    least = materialize(_smallest(sets, rounds).select("set_key", "size", F.posexplode("least").alias("round", "cell")), "ngram-least")
    groups = (least.groupBy("round", "cell").agg(F.count("*").alias("members"), F.sum("size").alias("shingles")).where("members > 1")
              .select("round", "cell", _blocks(F.col("members"), F.col("shingles")).alias("blocks")))
    return least.join(_grows(groups), ["round", "cell"]).select(
        "set_key", F.col("round").cast("long").alias("c1"), F.col("cell").alias("c2"),
        F.pmod(F.xxhash64("round", "set_key"), "blocks").cast("long").alias("c3"))


def _candidates(sets: DataFrame, cells: DataFrame, rounds: int) -> DataFrame:
    """x, y, n (of x): pairs of sets of different components (column component of ``sets``) that no cell of
    ``cells`` has compared and that a prefix shingle and the sizes allow to link."""
    rows = materialize(_prefixes(sets), "ngram-prefixes")
    members = [F.expr(f"bit_xor(xxhash64({seed}, set_key))").alias(f"x{seed}") for seed in (1, 2)]
    open_ = (rows.groupBy("shingle").agg(F.count("*").alias("sets"), F.min("component").alias("low"), F.max("component").alias("high"), *members)
             .where("low != high").groupBy("sets", "x1", "x2").agg(F.min("shingle").alias("shingle")).select("shingle"))
    # the cells that a set was in, one for each round; a set alone has one of its own
    cell = F.xxhash64("c1", "c2", "c3")
    been = cells.groupBy("set_key").agg(F.count("*").alias("cells"), *[F.max(F.when(F.col("c1") == r, cell)).alias(f"r{r}") for r in range(rounds)])
    met = (rows.join(_grows(open_), "shingle").join(_grows(been), "set_key", "left")
           .select("shingle", "set_key", "component", "n", "place",
                   F.array(*[F.coalesce(f"r{r}", F.xxhash64(F.lit(r), "set_key")) for r in range(rounds)]).cast("array<long>").alias("cells")))
    met = materialize(met, "ngram-open")
    # the largest component of a group against the rest
    shares = met.groupBy("shingle", "component").agg(F.count("*").alias("sets"))
    shares = shares.withColumn("large", F.row_number().over(Window.partitionBy("shingle").orderBy(F.col("sets").desc(), "component")) == 1)
    plan = (shares.groupBy("shingle").agg(
        F.max(F.when(F.col("large"), F.col("component"))).alias("largest"),
        F.sum(F.when(F.col("large"), 0).otherwise(F.col("sets"))).alias("rest"), F.sum(F.when(F.col("large"), F.col("sets")).otherwise(0)).alias("large"))
        .select("shingle", "largest", F.ceil(F.col("rest") / BLOCK_SETS).cast("int").alias("rest"), F.ceil(F.col("large") / BLOCK_SETS).cast("int").alias("large")))
    own = F.pmod(F.xxhash64("set_key"), F.when(F.col("component") == F.col("largest"), F.col("large")).otherwise(F.col("rest"))).cast("int")
    placed = met.join(_grows(plan), "shingle").withColumn("block", own).withColumn("is_large", F.col("component") == F.col("largest"))
    # blocks of the rest are 0 to rest - 1, those of the largest component follow; a block of the rest meets every block from it on
    every = F.transform(F.sequence(F.lit(0), F.col("rest") - 1), lambda a: F.struct(a.alias("a"), (F.col("rest") + F.col("block")).alias("b")))
    asked = F.transform(F.sequence(F.col("block"), F.col("rest") + F.col("large") - 1), lambda b: F.struct(F.col("block").alias("a"), b.alias("b")))
    told = F.transform(F.sequence(F.lit(0), F.col("block")), lambda a: F.struct(a.alias("a"), F.col("block").alias("b")))
    number = F.when(F.col("is_large"), F.col("rest") + F.col("block")).otherwise(F.col("block"))
    meeting = (placed.withColumn("cell", F.explode(F.when(F.col("is_large"), every).otherwise(F.array_distinct(F.concat(asked, told)))))
               .select(F.col("shingle").alias("c1"), F.col("cell.a").cast("long").alias("c2"), F.col("cell.b").cast("long").alias("c3"),
                       "set_key", "component", (number == F.col("cell.a")).alias("asks"), (number == F.col("cell.b")).alias("told"), "n", "place", "cells"))

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        keys = rows["set_key"].to_pylist()
        group = rows["component"].combine_chunks().dictionary_encode().indices.to_numpy()
        n, rest = rows["n"].to_numpy(), rows["n"].to_numpy() - rows["place"].to_numpy()
        been = rows["cells"].combine_chunks().flatten().to_numpy().reshape(len(keys), rounds)
        asks, told = (np.flatnonzero(rows[c].to_numpy()) for c in ("asks", "told"))
        found = []
        for at in range(0, len(asks), 256):
            a = asks[at:at + 256]
            good = ((group[a][:, None] != group[told]) & enough(np.minimum(rest[a][:, None], rest[told]), n[a][:, None], n[told]))
            for r in range(rounds):
                good &= been[a, r][:, None] != been[told, r]
            i, j = np.nonzero(good)
            found += [(max(keys[x], keys[y]), min(keys[x], keys[y]), max(int(n[x]), int(n[y]))) for x, y in zip(a[i].tolist(), told[j].tolist())]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], t) for k, t in enumerate((pa.binary(), pa.binary(), pa.int64()))], names=["x", "y", "n"])

    return cell_by_cell(meeting, pairs, "x binary, y binary, n long").groupBy("x", "y").agg(F.max("n").alias("n"))


def _links_between(candidates: DataFrame, sets: DataFrame) -> DataFrame:
    """The candidates that link, found in a cell for each x (in blocks of its partners)."""
    load = candidates.groupBy("x").agg(F.count("*").alias("sets"), F.max("n").alias("n")).select(
        "x", _blocks(F.col("sets"), F.col("sets") * F.col("n")).alias("blocks"))
    name = [F.xxhash64(F.lit(seed), "x").alias(c) for seed, c in ((1, "c1"), (2, "c2"))]
    told = candidates.join(_grows(load), "x").select(
        *name, F.pmod(F.xxhash64("y"), "blocks").cast("long").alias("c3"), F.col("y").alias("set_key"), F.lit(False).alias("asks"), F.lit(True).alias("told"))
    asks = load.select(*name, F.explode(F.expr("sequence(0L, blocks - 1L)")).alias("c3"), F.col("x").alias("set_key"),
                       F.lit(True).alias("asks"), F.lit(False).alias("told"))
    return links_in_cells(told.unionByName(asks).withColumn("component", F.col("set_key")).join(_grows(sets.select("set_key", "n", "shingles")), "set_key"))


def linked_sets(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text) -> the sets of all documents (doc_id, set_key, n), and links a, b of sets that connect all that belong together."""
    spark = docs.sparkSession
    parts = 4 * partitions(spark)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    known = materialize(shared_counts(narrow, parts), "ngram-sets")
    wanted = (known.where((F.col("n") > 0) & (100 * F.col("shared") >= LEAST * F.col("n")))
              .groupBy("set_key").agg(F.min(F.struct(id_number().alias("number"), "text_hash")).alias("at")).select("set_key", "at.*"))
    wanted = materialize(wanted, "ngram-wanted")

    sets = (chosen_sets(narrow, wanted).join(_grows(wanted.select("set_key")), "set_key", "left_semi").dropDuplicates(["set_key"]))
    ordered = ordered_sets(materialize(sets, "ngram-shingles"), parts)
    ordered = materialize(ordered.where(100 * F.length("shingles") >= 8 * LEAST * F.col("n")), "ngram-ordered")

    cells = materialize(_first_cells(ordered, ROUNDS), "ngram-cells")
    links = materialize(links_in_cells(cells.join(_grows(ordered), "set_key").select(
        "*", F.col("set_key").alias("component"), F.lit(True).alias("asks"), F.lit(True).alias("told"))), "ngram-links")
    labels = components(links)
    placed = (ordered.join(_grows(labels.withColumnRenamed("key", "set_key")), "set_key", "left")
              .withColumn("component", F.coalesce("component", "set_key")))
    candidates = materialize(_candidates(placed, cells, ROUNDS), "ngram-candidates")
    return known, links.unionByName(materialize(_links_between(candidates, ordered), "ngram-links"))


def join_components(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, n_shingles, component_id: one row for each row of ``docs``."""
    known, links = linked_sets(docs)
    labels = components(links).withColumnRenamed("key", "set_key")
    nodes = (known.where("n > 0").groupBy("set_key").agg(F.min("doc_id").alias("doc_id")).join(labels, "set_key", "left")
             .withColumn("component", F.coalesce("component", "set_key")))
    nodes = materialize(nodes, "ngram-nodes")
    names = nodes.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = nodes.join(names, "component").select("set_key", "component_id")
    filled = known.where("n > 0").join(_grows(named), "set_key").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return filled.unionByName(known.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def op13_ngram_join(spark, sf_dir: str) -> DataFrame:
    """The component of every document under links of 85 % of common four-word shingles."""
    return join_components(table(spark, sf_dir, "documents", "doc_id", "text"))
