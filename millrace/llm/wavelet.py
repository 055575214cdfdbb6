"""Token ids in binary files: a wavelet matrix for each shard.

Ids are kept as bit planes, most significant first.  After each plane the ids
are dealt anew, those with bit 0 before those with bit 1 and otherwise in
order, so the ids that share leading bits stand together further down.  With
counts of ones at every ``STRIDE`` bits, one pass over the planes answers which
id stands at a place, how often an id occurs up to a place, and where its n-th
occurrence is, without unpacking the file.

File format, one Parquet record for each shard: shard (number, in order of
ids of documents), part (a shard of many tokens has several), n_tokens, levels
(number of planes), zeros (how many 0 bits each plane has), planes (the planes,
each padded to a whole byte), ones (little-endian 32-bit counts of ones before
every STRIDE-th bit, plane by plane), doc_ids and lengths of the documents in
order.  A part holds whole documents.

Ids are written in ascending order of doc_id: documents go to shards by ranges
of ids and are sorted within them.

Defined cases: a null or empty text is its end id alone; a null id counts as
the largest; documents with equal ids are in order of their token ids; an empty
table writes no record and gives an empty result; other columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bounded_broadcast, id_number, id_part, id_ranges, materialize, partitions, shared_path, table
from millrace.llm.tokens import encoder

STRIDE = 512
#: Bits dealt out at a time, so that what they move stays in a core's cache.
BLOCK = 1 << 16
#: Tokens after which a shard begins another part.
PART = 1 << 21
END_ID = 2


class WaveletMatrix:
    """Rank, select and access on the bit planes of one part."""

    def __init__(self, n: int, zeros: list[int], planes: bytes, ones: bytes):
        self.n, self.zeros, self.levels = n, list(zeros), len(zeros)
        self.width, self.marks = (n + 7) // 8, n // STRIDE + 1
        self.planes = np.frombuffer(planes, np.uint8).reshape(self.levels, self.width)
        self.ones = np.frombuffer(ones, "<u4").reshape(self.levels, self.marks)

    @classmethod
    def build(cls, ids: np.ndarray, levels: int) -> "WaveletMatrix":
        n = len(ids)
        zeros, planes, ones = [], [], []
        for level in range(levels):
            bit = (ids & ids.dtype.type(1 << (levels - 1 - level))) != 0
            plane = np.packbits(bit)
            planes.append(plane.tobytes())
            each = np.bitwise_count(np.pad(plane, (0, -len(plane) % (STRIDE // 8)))).reshape(-1, STRIDE // 8).sum(1, dtype=np.int64)
            counts = np.concatenate(([0], np.cumsum(each)))[:n // STRIDE + 1]
            ones.append(counts.astype("<u4").tobytes())
            zeros.append(n - int(np.count_nonzero(bit)))
            dealt, zero, one = np.empty_like(ids), 0, zeros[-1]
            for at in range(0, n, BLOCK):
                each, set_ = ids[at:at + BLOCK], bit[at:at + BLOCK]
                ones_here = np.compress(set_, each)
                zeros_here = np.compress(~set_, each)
                dealt[zero:zero + len(zeros_here)], dealt[one:one + len(ones_here)] = zeros_here, ones_here
                zero, one = zero + len(zeros_here), one + len(ones_here)
            ids = dealt
        return cls(n, zeros, b"".join(planes), b"".join(ones))

    def decode(self, dtype: str = "<u4") -> np.ndarray:
        """All ids: the planes are undone from the last to the first."""
        kind = np.dtype("<u2" if self.levels <= 16 else "<u4")
        ids = np.zeros(self.n, kind)
        for level in range(self.levels - 1, -1, -1):
            above, zero, one = np.empty(self.n, kind), 0, self.zeros[level]
            ids[one:] |= kind.type(1 << (self.levels - 1 - level))
            for at in range(0, self.n, BLOCK):
                bit = np.unpackbits(self.planes[level, at // 8:(at + BLOCK) // 8], count=min(BLOCK, self.n - at)).view(bool)
                zeros_here, ones_here = np.flatnonzero(~bit), np.flatnonzero(bit)
                each = above[at:at + BLOCK]
                each[zeros_here], each[ones_here] = ids[zero:zero + len(zeros_here)], ids[one:one + len(ones_here)]
                zero, one = zero + len(zeros_here), one + len(ones_here)
            ids = above
        return ids.astype(dtype)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level, i >> 3]) >> (7 - (i & 7)) & 1

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        mark = i // STRIDE
        part = self.planes[level, mark * STRIDE // 8:(i + 7) // 8].copy()
        if i & 7:
            part[-1] &= 0xFF << (8 - (i & 7)) & 0xFF
        return int(self.ones[level, mark]) + int(np.bitwise_count(part).sum())

    def access(self, i: int) -> int:
        """The id at place i."""
        found = 0
        for level in range(self.levels):
            bit, before = self._bit(level, i), self._rank1(level, i)
            found = found << 1 | bit
            i = self.zeros[level] + before if bit else i - before
        return found

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the token's occurrences before place ``end`` stand below the last plane."""
        if token >> self.levels:
            return 0, 0
        start = 0
        for level in range(self.levels):
            a, b = self._rank1(level, start), self._rank1(level, end)
            start, end = (self.zeros[level] + a, self.zeros[level] + b) if token >> (self.levels - 1 - level) & 1 else (start - a, end - b)
        return start, end

    def count(self, token: int, end: int | None = None) -> int:
        """How often a token occurs before place ``end``."""
        a, b = self._range(token, self.n if end is None else end)
        return b - a

    def _select(self, level: int, bit: int, nth: int) -> int:
        """Place of the nth (from 0) such bit of a plane."""
        ones = self.ones[level].astype(np.int64)
        seen = ones if bit else np.arange(self.marks) * STRIDE - ones
        mark = int(np.searchsorted(seen, nth, side="right")) - 1
        begin = mark * STRIDE
        bits = np.unpackbits(self.planes[level, begin // 8:(begin + STRIDE) // 8])[:self.n - begin]
        return begin + int(np.flatnonzero(bits == bit)[nth - int(seen[mark])])

    def occurrence(self, token: int, nth: int) -> int:
        """Place of the nth (from 0) occurrence of a token; -1 if there is none."""
        a, b = self._range(token, self.n)
        if not 0 <= nth < b - a:
            return -1
        i = a + nth
        for level in range(self.levels - 1, -1, -1):
            bit = token >> (self.levels - 1 - level) & 1
            i = self._select(level, bit, i - self.zeros[level] if bit else i)
        return i


FILE = ("shard int, part int, n_tokens long, zeros array<int>, planes binary, ones binary, doc_ids array<long>, lengths array<long>")


def tokenize(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """(doc_id, number, text) -> doc_id, number, ids: little-endian, as wide as the vocabulary needs, with the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary)
        end = np.array([end_id], tokens.dtype).tobytes()
        for batch in batches:
            ids = [x + end for x in tokens.encode([t or "" for t in batch.column(2).to_pylist()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], names=["doc_id", "number", "ids"])

    return docs.mapInArrow(run, "doc_id long, number long, ids binary")


def write_shards(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID) -> None:
    """Write (doc_id, text) to ``path`` in the file format above."""
    spark = docs.sparkSession
    width = encoder(vocabulary).dtype.itemsize
    levels = max(1, (max(encoder(vocabulary).tokenizer.get_vocab_size() - 1, end_id)).bit_length())
    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), id_number().alias("number"), "text")
    parts = partitions(spark)
    bounds = id_ranges(numbered.select("number"), parts)

    def part_row(shard: int, part: int, ids: list[bytes], doc_ids: list[int | None]) -> pa.RecordBatch:
        values = np.frombuffer(b"".join(ids), f"<u{width}")
        matrix = WaveletMatrix.build(values, levels)
        return pa.RecordBatch.from_pylist([{
            "shard": shard, "part": part, "n_tokens": matrix.n, "zeros": matrix.zeros, "planes": matrix.planes.tobytes(),
            "ones": matrix.ones.tobytes(), "doc_ids": doc_ids, "lengths": [len(x) // width for x in ids]}], schema=out)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part, held, ids, doc_ids = None, 0, 0, [], []
        for batch in batches:
            for s, d, x in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if ids and (s != shard or held >= PART * width):
                    yield part_row(shard, part, ids, doc_ids)
                    part, held, ids, doc_ids = part + 1 if s == shard else 0, 0, [], []
                shard = s
                held += len(x)
                ids.append(x)
                doc_ids.append(d)
        if ids:
            yield part_row(shard, part, ids, doc_ids)

    longs = pa.list_(pa.int64())
    out = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("n_tokens", pa.int64()), ("zeros", pa.list_(pa.int32())),
                     ("planes", pa.binary()), ("ones", pa.binary()), ("doc_ids", longs), ("lengths", longs)])
    (tokenize(numbered, vocabulary, end_id).withColumn("shard", id_part(bounds, F.col("number")))
     .repartition(parts, "shard").sortWithinPartitions("shard", "number", "ids")
     .select("shard", "doc_id", "ids").mapInArrow(build, FILE)
     .write.option("compression", "zstd").parquet(path))


def read_shards(spark, path: str) -> DataFrame:
    return spark.read.schema(FILE).parquet(path)


def document_ids(shards: DataFrame) -> DataFrame:
    """doc_id, start (tokens of all documents before), n_tokens and ids_crc32 of every document in the files."""
    sizes = materialize(shards.groupBy("shard", "part").agg(F.sum("n_tokens").alias("n")), "shard-sizes")
    # one row for each shard, then the parts of each
    totals = sizes.groupBy("shard").agg(F.sum("n").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    within = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sizes.withColumn("part_start", F.coalesce(F.sum("n").over(within), F.lit(0))).join(totals, "shard")
              .select("shard", "part", (F.col("shard_start") + F.col("part_start")).alias("begin")))
    starts = bounded_broadcast(materialize(starts, "shard-starts"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = WaveletMatrix(r["n_tokens"], r["zeros"], r["planes"], r["ones"]).decode("<u4")
                lengths = np.array(r["lengths"], np.int64)
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(ids[b - n:b]) for b, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(r["begin"] + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return (shards.join(starts, ["shard", "part"]).select("begin", "n_tokens", "zeros", "planes", "ones", "doc_ids", "lengths")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def op9_wavelet(spark, sf_dir: str) -> DataFrame:
    """Write all documents' ids in the file format, and read each document back from the files."""
    import public_tokenizers

    path = shared_path(spark, "wavelet")
    write_shards(table(spark, sf_dir, "documents", "doc_id", "text"), path, public_tokenizers.path("word_bpe_49k.json"))
    return document_ids(read_shards(spark, path))
