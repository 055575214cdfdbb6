"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer if the smallest hash of its inner
s-mers stands first or last.  Whether it is one depends on its own characters
alone, so an edit elsewhere never moves an anchor.  A fingerprint holds the
number of a text's distinct syncmers and all of them, each with the place where
it first stands.  It grows with the text; none is left out.

The likeness of two fingerprints matches anchors by hash, keeps those whose
places come in the same order in both (the longest rising run), and is their
part of the larger set: 1 for equal texts, about one half if half is replaced.
Hashes have 32 bits, so an anchor meets a foreign one of a text with n anchors
with a chance of n / 2**32.

``neighbours`` gives every document the text of the next one by id.  Documents
go to parts by ranges of ids, and the first document of each part is also sent
to the part before it, so no global sort and no join of texts is needed.

Defined cases: a null text is empty; texts without a syncmer, being shorter
than ``K`` code points, have their whole text as the one anchor, and an empty
text has none; two empty fingerprints have likeness 1, an empty and another one
0; a null id counts as the largest, and documents with equal ids follow by
text; the only document is its own next one; an empty table gives an empty
result; other columns play no part.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import U64, bounded_broadcast, id_number, id_part, id_ranges, materialize, mix64, partitions, table, text_groups
from millrace.llm.omh import rising

K, S = 12, 5
_ODD = U64(0x9E3779B97F4A7C15)


def syncmers(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the closed syncmers in an array of code points."""
    n = len(points) - S + 1
    if len(points) < K:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    code = np.zeros(n, U64)
    for i in range(S):
        code = code * _ODD + points[i:i + n]
    code = mix64(code)
    inner = K - S + 1
    least, reach = code, 1
    while reach * 2 <= inner:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    count = len(points) - K + 1
    if reach < inner:
        least = np.minimum(least[:count], least[inner - reach:][:count])
    at = np.flatnonzero((least[:count] == code[:count]) | (least[:count] == code[inner - 1:][:count]))
    # three s-mers that together cover the k-mer
    return at, mix64(code[at] + code[at + S - 1] * _ODD + code[at + inner - 1] * (_ODD + U64(2)))


def fingerprints(texts: list[str]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For every text: number of anchors, and the anchors' hashes (rising, 32 bits) and places."""
    lengths = np.array([len(t) for t in texts])
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64)
    at, code = syncmers(points)
    begin = np.concatenate(([0], np.cumsum(lengths)))
    low = np.searchsorted(at, begin[:-1])
    # the k-mer must end inside the text
    high = np.maximum(low, np.searchsorted(at, begin[1:] - K, side="right"))
    out = []
    for text, a, b, zero in zip(texts, low.tolist(), high.tolist(), begin.tolist()):
        if a == b:
            whole = int.from_bytes(hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()[:4], "big")
            out.append((1, np.array([whole], U64), np.zeros(1, np.int64)) if text else (0, np.zeros(0, U64), np.zeros(0, np.int64)))
            continue
        hashes, first = np.unique(code[a:b] >> U64(32), return_index=True)
        out.append((len(hashes), hashes, at[a:b][first] - zero))
    return out


def fingerprint_text(fingerprint: tuple[int, np.ndarray, np.ndarray]) -> str:
    """``count:`` and, in order of place, the steps between places and the hashes in base 64.

    A step is a byte, or 255 and the step in four bytes; a hash is four bytes.  Bytes are little-endian.
    """
    count, hashes, places = fingerprint
    order = np.argsort(places)
    steps = np.diff(places[order], prepend=0)
    long = np.flatnonzero(steps >= 255)
    short = np.minimum(steps, 255).astype(np.uint8)
    wide = steps[long].astype("<u4").view(np.uint8)
    raw = np.insert(short, np.repeat(long + 1, 4), wide).tobytes() + hashes[order].astype("<u4").tobytes()
    return f"{count}:{base64.b64encode(raw).decode()}"


def likeness(a: tuple[int, np.ndarray, np.ndarray], b: tuple[int, np.ndarray, np.ndarray]) -> float:
    (count_a, hash_a, place_a), (count_b, hash_b, place_b) = a, b
    if not count_a or not count_b:
        return float(count_a == count_b)
    # both are in order of hash, without equal ones
    at = np.searchsorted(hash_b, hash_a)
    i = np.flatnonzero(hash_b[np.minimum(at, count_b - 1)] == hash_a)
    order = i[np.argsort(place_a[i])]
    matched = place_b[at[order]]
    kept = len(matched) if (matched[1:] > matched[:-1]).all() else rising(matched.tolist())
    return kept / max(count_a, count_b)


def neighbours(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> rows in order of id within each partition: part, guest, number, doc_id, text.

    A part's rows are followed by a guest: the first document after the part.
    """
    parts = 4 * partitions(docs.sparkSession)
    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), id_number().alias("number"))
    ids = numbered.select("number")
    bounds = id_ranges(ids, parts)
    firsts = ids.groupBy(id_part(bounds, F.col("number")).alias("part")).agg(F.min("number").alias("number"))
    # one row for each part
    around, ring = Window.orderBy("part"), Window.partitionBy(F.lit(0))
    guests = firsts.select(F.coalesce(F.lag("part").over(around), F.max("part").over(ring)).alias("host"), F.col("number").alias("first_number"))
    guests = bounded_broadcast(materialize(guests, "guests"))
    own = F.struct(id_part(bounds, F.col("number")).alias("part"), F.lit(0).alias("guest"))
    visit = F.struct(F.col("host").alias("part"), F.lit(1).alias("guest"))
    return (numbered.join(guests, F.col("number") == F.col("first_number"), "left")
            .withColumn("place", F.explode(F.when(F.col("host").isNull(), F.array(own)).otherwise(F.array(own, visit))))
            .select("place.part", "place.guest", "number", "doc_id", "text")
            .repartition(partitions(docs.sparkSession), "part")
            .sortWithinPartitions("part", "guest", "number", "text"))


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to each other and to the next text's.

    The edited text's last half is replaced by as many code points of the next
    document's beginning.
    """

    def compare(rows: list[tuple[int, int, int | None, str]]) -> pa.RecordBatch:
        """``rows`` holds one row more than it gives results for; a guest gives none."""
        out = []
        prints = fingerprints([r[3] for r in rows])
        pairs = [n for n in range(len(rows) - 1) if not rows[n][1] and rows[n][0] == rows[n + 1][0]]
        edited = [rows[n][3][:len(rows[n][3]) - len(rows[n][3]) // 2] + rows[n + 1][3][:len(rows[n][3]) // 2] for n in pairs]
        for n, text, other in zip(pairs, edited, fingerprints(edited)):
            out.append((rows[n][2], len(rows[n][3]), hashlib.sha256(text.encode("utf-8")).hexdigest(), fingerprint_text(prints[n]),
                        fingerprint_text(other), likeness(prints[n], other), likeness(prints[n], prints[n + 1])))
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds[i]) for i in range(len(names))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[int, int, int | None, str]] = []
        for batch in batches:
            rows = waiting + list(zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))))
            for a, b in text_groups([r[3] for r in rows], 1 << 20):
                yield compare(rows[a:b + 1])
            waiting = rows[-1:]
        # the row that is left is a guest

    return neighbours(docs).mapInArrow(run, SCHEMA)


def op7_syncmers(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return compare_with_next(table(spark, sf_dir, "documents", "doc_id", "text"))
