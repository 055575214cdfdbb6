"""Best-fit packing of token sequences by minimum bin slack.

A document is its token ids and an end id.  Longer ones are cut into pieces of
``CAPACITY`` tokens, the first of which takes what is left over and may be
shorter.  Whole pieces fill a sequence each.  The others go to shards of about
``SHARD`` pieces by a hash; in a shard, each sequence starts with the longest
piece left, and dynamic programming over the bits of an integer finds which
sums the remaining lengths can reach.  Trying lengths from long to short, it
stops at a perfect fill or ends with the fullest feasible combination, whose
pieces are then removed.  Only (piece, length) rows travel to a shard; a shard
wastes at most about one sequence, whatever the size of the table.

Defined cases: a null or empty text is one piece that holds the end id; equal
rows are packed each; an empty table gives an empty result; other columns play
no part.  Documents are told apart by the order number of their row, so a
repeated or null doc_id is packed like any other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import extended, lean, materialize, table, text_parts
from millrace.llm.tokens import AT_ONCE, encoder

CAPACITY = 2048
SHARD = 16_000
END_ID = 0

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, vocabulary: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, text) -> one row for each piece: doc_id, piece, start, length, ids_crc32."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary)
        for part, texts in (run for batch in batches for run in text_parts(batch, 1, AT_ONCE)):
            ids = tokens.encode([t or "" for t in texts])
            rows: list[tuple[int, int, int, int, int]] = []
            for n, raw in enumerate(ids):
                one = np.append(np.frombuffer(raw, tokens.dtype), end_id).astype("<u4")
                first = len(one) % capacity or capacity
                bounds = [0, *range(first, len(one) + 1, capacity)]
                rows += [(n, k, a, b - a, zlib.crc32(one[a:b])) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]
            columns = np.array(rows, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(columns[0])), pa.array(columns[1].astype(np.int32)), *map(pa.array, columns[2:])],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(cut), PIECES)


def fullest(lengths: list[int], left: list[int], room: int) -> list[int]:
    """Lengths whose sum is the largest reachable one up to ``room``; left[n] pieces of length n remain.

    Bit s of ``reach`` says that some chosen pieces add up to s.  ``lengths`` is
    in falling order.
    """
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for n in lengths:
        if n > room:
            continue
        for _ in range(min(left[n], room // n)):
            wider = (reach | reach << n) & mask
            if wider == reach:
                break
            steps.append((n, reach))
            reach = wider
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, []
    for n, before in reversed(steps):
        if not before >> total & 1:
            chosen.append(n)
            total -= n
    return chosen


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length."""
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left = np.bincount(lengths, minlength=capacity + 1).tolist()
    #: the pieces of length n are order[first[n]:][:left[n]]; those taken come off the end
    ranked = lengths[order]
    first = np.searchsorted(-ranked, -np.arange(capacity + 1), side="left").tolist()
    sizes = sorted((n for n in range(capacity + 1) if left[n]), reverse=True)
    number = 0
    while sizes:
        longest = sizes[0]
        left[longest] -= 1
        combination = [longest] + fullest(sizes, left, capacity - longest)
        at = 0
        for k, n in enumerate(combination):
            if k:
                left[n] -= 1
            piece = order[first[n] + left[n]]
            sequence[piece], offset[piece] = number, at
            at += n
        number += 1
        if any(not left[n] for n in combination):
            sizes = [n for n in sizes if left[n]]
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """``pieces`` (with a column length) with sequence_id and offset.

    ``pieces`` should be materialized: it is counted and read twice.
    """
    columns = pieces.columns
    short = pieces.where(F.col("length") < capacity)
    shards = max(1, round(short.count() / shard))
    whole = (pieces.where(F.col("length") == capacity)
             .withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long")))
    placed_schema = extended(short.schema, shard="int", sequence_id="bigint", offset="bigint")

    def place(key: tuple, rows: pa.Table) -> pa.Table:
        sequence, offset = pack_lengths(rows["length"].to_numpy().astype(np.int64), capacity)
        number = (int(key[0].as_py()) << 32) + sequence
        return rows.append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset))

    sharded = short.withColumn("shard", F.pmod(F.xxhash64(*columns), F.lit(shards)).cast("int"))
    packed = sharded.groupBy("shard").applyInArrow(place, placed_schema)
    return whole.unionByName(packed.drop("shard")).select(*columns, "sequence_id", "offset")


def op10_pack(spark, sf_dir: str) -> DataFrame:
    """Where every piece of every document is placed."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    pieces = materialize(cut_pieces(docs, public_tokenizers.path("byte_bpe_50k.json")), "pieces")
    return pack(pieces)
