"""Readers, scratch tables and array hashing shared by the operators."""

from __future__ import annotations

import ctypes
import functools
import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import checkpoint_dir

#: A word is a run of characters other than these six white-space characters.
SPACES = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

U64 = np.uint64


def importable_on_workers(query):
    """Let the Python workers of a local session import this package, from whatever folder it was started.

    On a cluster the package is installed there, or shipped with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

    @functools.wraps(query)
    def run(spark, *args):
        paths = spark.sparkContext.environment.get("PYTHONPATH", "")
        if spark.sparkContext.master.startswith("local[") and root not in paths.split(os.pathsep):
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, paths) if p)
        return query(spark, *args)

    return run


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A column-pruned scan of one input table."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


#: glibc's, where the C library has it
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return what Arrow's and the C library's allocators hold unused to the system."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, with freed memory given back after each batch and at the end.

    A Python worker outlives its task and serves later ones, of other stages
    too; its allocators would keep the most that any batch has taken.
    """

    @functools.wraps(run)
    def given_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in run(batches):
                yield batch
                del batch
                give_back()
        finally:
            give_back()

    return given_back


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new folder name below the folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and survives lost executors.  Used for small intermediate
    tables that several later steps read.
    """
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows (counted), else as it is.

    ``df`` should be materialized, so that the count is cheap.  Without the
    hint the join is a shuffle join, which the adaptive planner splits at skew.
    """
    small = df.limit(rows + 1).count() <= rows
    return F.broadcast(df) if small else df


def extended(schema: T.StructType, **columns: str) -> T.StructType:
    """A copy of ``schema`` with further columns, given as name=type."""
    return T.StructType([*schema.fields, *(T.StructField(n, T.DataType.fromDDL(t)) for n, t in columns.items())])


def set_aside(docs: DataFrame, *needed: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all but the needed columns in one struct, and a function that brings a result back to its columns.

    An operator may so add columns of its own without meeting equal names.
    """
    columns = docs.columns
    rest = [c for c in columns if c not in needed]
    kept = F.struct(*rest) if rest else F.lit(None).cast("boolean")

    def restore(result: DataFrame) -> DataFrame:
        return result.select(*(F.col(c) if c in needed else F.col("set_aside")[c].alias(c) for c in columns))

    return docs.select(*needed, kept.alias("set_aside")), restore


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


LAST_ID = (1 << 63) - 1


def id_number(column: str = "doc_id") -> Column:
    """The id as a sort key that is never null: null counts as the largest."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def id_ranges(ids: DataFrame, parts: int) -> list[int]:
    """Upper bounds that cut the ids (a column number) into about equal parts; at most ``parts`` numbers."""
    found = ids.agg(F.percentile_approx("number", [i / parts for i in range(1, parts)], 10 * parts).alias("at")).first()["at"] if parts > 1 else []
    return sorted(set(found or []))


def id_part(bounds: list[int], number: Column) -> Column:
    """The part that a number belongs to, from 0."""
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < number))


# -- hashing of words and word windows, vectorised over a batch of texts ------


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mixer on 64-bit lanes (multiply and xor-shift, wrap-around)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (base is odd)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        m = 1 << max(16, int(n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inverse):
            p = np.ones(m, U64)
            p[1:] = U64(b)
            out.append(np.multiply.accumulate(p))
        have = _POWERS[base] = (out[0], out[1])
    return have[0][:n], have[1][:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[starts[i]:ends[i]] for every i: a polynomial modulo 2**64, then mixed.

    One running sum serves all spans, so overlapping windows cost the same as
    disjoint words.
    """
    n = len(values)
    up, down = _powers(base, n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum((values.astype(U64) + U64(1)) * up[:n], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + U64(base) * (ends - starts).astype(U64))


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in a byte buffer."""
    word = ~_IS_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
    return edge[0::2], edge[1::2]


class WordBatch:
    """The words of a list of texts (str or None): byte spans, and the first word of each text.

    Texts are joined by a line feed, so no word spans two of them.
    """

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").encode("utf-8") for t in texts]
        self.buffer = b"\n".join(raw)
        self.data = np.frombuffer(self.buffer, np.uint8)
        self.starts, self.ends = word_spans(self.data)
        begin = np.cumsum([0] + [len(r) + 1 for r in raw])
        #: words of text i are first[i] .. first[i + 1]
        self.first = np.searchsorted(self.starts, begin)

    def ids(self, base: int) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, base)


def size_groups(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of sizes that add up to at most ``most``; a larger one is a run of its own."""
    begin = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(sizes):
        yield begin, len(sizes)


def text_groups(texts: list[str | None], most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of at most ``most`` characters together; a longer text is a run of its own."""
    return size_groups([len(t or "") for t in texts], most)


def text_parts(batch: pa.RecordBatch, column: int, most: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """A batch in runs of rows whose texts have at most ``most`` characters together, with the texts of each.

    Only the texts of one run are Python strings at a time; a longer text is a run of its own.
    """
    sizes = pc.utf8_length(batch.column(column)).fill_null(0).to_pylist()
    for a, b in size_groups(sizes, most):
        rows = batch.slice(a, b - a)
        yield rows, rows.column(column).to_pylist()


def shingles(batch: WordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words of every text, and the text of each.

    Equal runs within a text are told apart: the hash includes which occurrence
    it is.  A text with fewer words, but at least one, has one shingle.
    """
    n = len(batch.starts)
    doc = np.repeat(np.arange(len(batch.first) - 1), np.diff(batch.first))
    at = np.arange(n)
    end = batch.first[1:][doc]
    chosen = np.flatnonzero((end - at >= width) | (at == batch.first[:-1][doc]))
    ends = np.minimum(chosen + width, end[chosen])
    plain = span_hashes(batch.ids(BASE_A), chosen, ends, BASE_B)
    doc = doc[chosen]
    key = mix64(plain + doc.astype(U64) * U64(BASE_A))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    place = np.arange(len(ranked))
    occurrence = np.empty(len(ranked), np.int64)
    occurrence[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return np.where(occurrence > 0, mix64(plain + occurrence.astype(U64) * U64(BASE_B)), plain), doc


BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
