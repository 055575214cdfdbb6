"""Source divergence audit by one-hot level products.

How likely a source uses a term depends only on how often the term occurs in
the source: its count level.  For every group (a source of a language) and
level there is an indicator column over the language's kept terms, 1 where the
term occurs so often.  The columns times their transpose,

    J[(g, a), (h, b)] = number of terms with level a in g and level b in h,

hold the joint table of every two groups, level 0 included.  A cell needs one
price, whatever the number of its terms: a divergence is the sum over cells of
J times the price of (a, b).

Counts per (group, term) are added up in the tasks that read the texts, before
any shuffle.  The products are blocked on both sides: ``COLUMNS`` groups
against as many, and about ``TERMS`` terms, dealt by a hash.  A task sorts its
terms by count, so that a stretch of them has few distinct columns, and
multiplies stretch by stretch in doubles, where sums of ones are exact; prices
are 64-bit integers computed from exact ones.  Only priced sums leave a task.

Defined cases: null text, lang and source count as empty strings; a document
without terms still makes its (lang, source) a group; a row is a document,
whatever its id, so repeated rows count each; a lang without kept terms has
pairs of value 0 and no terms; ties go to the smaller item; an empty table
gives an empty result; other columns play no part.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialize, table

#: A kept term is in at least so many documents of its language; a group reports so many terms.
LEAST_DOCUMENTS, TOP_TERMS = 3, 200
ONE = 1_000_000_000
#: Groups on one side of a product, terms in a task, distinct columns of a stretch, (group, term) counts held while reading.
COLUMNS, TERMS, STRETCH, HELD = 48, 16_384, 768, 400_000
SLICE = 1 << 22

_TERM = np.full(256, 0x20, np.uint8)
for _low, _high in ((0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _TERM[_low:_high] = np.arange(_low, _high, dtype=np.uint8)
_TERM[0x41:0x5B] += 0x20
#: Bytes of a term with A to Z in lower case; every other byte becomes a space.
_TERM_BYTES = _TERM.tobytes()

COUNTS = "lang string, source string, term binary, n long, docs long"


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in slices of a very long one."""
    plain = text.translate(_TERM_BYTES)
    at = 0
    while len(plain) - at > SLICE:
        end = plain.find(b" ", at + SLICE)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end
    yield plain[at:].split()


def term_counts(docs: DataFrame) -> DataFrame:
    """(text, lang, source) -> lang, source, term, n (occurrences), docs (documents it is in).

    Every group has one more row, whose term is null and whose docs are its
    documents, so that a group without terms is known.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for text, lang, source in zip(*(c.to_pylist() for c in batch.columns)):
                own: Counter = Counter()
                for part in terms_of(text or b""):
                    own.update(part)
                n, in_docs = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(n)
                n.update(own)
                in_docs.update(own.keys())
                in_docs[None] += 1
                size += len(n) - before
                if size > HELD:
                    yield from _count_batches(held)
                    held, size = {}, 0
        yield from _count_batches(held)

    narrow = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"), _named("lang"), _named("source"))
    partial = narrow.mapInArrow(count, COUNTS)
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _named(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("")).alias(column)


def _count_batches(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in held.items():
        terms = list(docs)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()),
             pa.array([n[t] for t in terms], pa.int64()), pa.array(list(docs.values()), pa.int64())],
            names=["lang", "source", "term", "n", "docs"])


def share(count: Column, total: Column, terms: Column) -> Column:
    """p of a count, in billionths; in decimals, as the product may be beyond a long."""
    wide = F.lit(ONE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", wide, (total + terms).cast("decimal(38,0)"))


def price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


# -- the products --------------------------------------------------------------


def _shares(levels: np.ndarray, total: int, terms: int) -> list[int]:
    return [1 + ONE * (int(a) + 1) // (total + terms) for a in levels]


def stretches(counts: np.ndarray) -> Iterator[tuple[np.ndarray, list[np.ndarray], np.ndarray]]:
    """Runs of terms with few distinct columns: the run's indicator matrix, the levels of each group, and the
    first column of each group.  ``counts`` is (terms, groups)."""
    counts = counts[np.argsort(counts.max(1, initial=0), kind="stable")]
    at, step = 0, 4096
    while at < len(counts):
        part = counts[at:at + step]
        found = [np.unique(part[:, g], return_inverse=True) for g in range(part.shape[1])]
        first = np.concatenate(([0], np.cumsum([len(levels) for levels, _ in found])))
        if first[-1] > STRETCH and len(part) > 16:
            step = max(16, len(part) // 2)
            continue
        indicator = np.zeros((len(part), int(first[-1])))
        rows = np.arange(len(part))
        for g, (_, code) in enumerate(found):
            indicator[rows, first[g] + code] = 1.0
        yield indicator, [levels for levels, _ in found], first
        at += len(part)
        step = min(4096, 2 * step)


def priced_products(counts: np.ndarray, totals: list[int], terms: int, split: int) -> np.ndarray:
    """Divergences [g, h] of every two groups, g of all and h of all, summed over the given terms.

    Columns below ``split`` are one side of the product, the others the other
    side; with ``split`` equal to the number of groups, both sides are the same.
    """
    groups = counts.shape[1]
    out = np.zeros((groups, groups), np.int64)
    for indicator, levels, first in stretches(counts):
        p = np.array([x for g in range(groups) for x in _shares(levels[g], totals[g], terms)], np.int64)
        own = int(first[split])
        left = slice(0, own)
        right = left if split == groups else slice(own, int(first[-1]))
        joint = (indicator[:, left].T @ indicator[:, right]).astype(np.int64)
        squares = (p[left][:, None] - p[right][None, :]) ** 2
        a = first[:split]
        b = a if split == groups else first[split:-1] - own
        # the price of a cell divides by the other group's p
        forward = np.add.reduceat(np.add.reduceat(joint * (squares // p[right][None, :]), a, axis=0), b, axis=1)
        if split == groups:
            out += forward
            continue
        back = np.add.reduceat(np.add.reduceat(joint * (squares // p[left][:, None]), a, axis=0), b, axis=1)
        out[:split, split:] += forward
        out[split:, :split] += back.T
    return out


def pair_values(entries: DataFrame, groups: DataFrame, slices: DataFrame) -> DataFrame:
    """lang, g, h, value: the divergence of every two groups of a lang, by blocked products.

    ``entries`` is (lang, slice, term, g, n) with n over 0, ``groups`` is (lang, g, total, terms), and ``slices``
    is (lang, slice, kept), the number of kept terms in each slice; a lang without any has slice 0 with none.
    """
    blocks = groups.groupBy("lang", F.floor(F.col("g") / COLUMNS).cast("int").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("g", "total"))).alias("groups"), F.max("terms").alias("terms"))
    last = blocks.groupBy("lang").agg(F.max("block").alias("last"))
    mine, other = blocks, blocks.select("lang", F.col("block").alias("block_2"), F.col("groups").alias("groups_2"))
    cells = (mine.join(last, "lang").withColumn("block_2", F.explode(F.sequence("block", "last"))).join(other, ["lang", "block_2"])
             .join(slices, "lang")
             .select("lang", "block", "block_2", "slice", "kept", "terms",
                     F.col("groups.g").alias("g"), F.col("groups.total").alias("total"),
                     F.when(F.col("block") != F.col("block_2"), F.col("groups_2.g")).otherwise(F.array().cast("array<int>")).alias("g_2"),
                     F.when(F.col("block") != F.col("block_2"), F.col("groups_2.total")).otherwise(F.array().cast("array<long>")).alias("total_2")))
    block = F.floor(F.col("g") / COLUMNS).cast("int")
    meant = (entries.withColumn("own", block).join(last, "lang")
             .withColumn("with", F.explode(F.sequence(F.lit(0), "last")))
             .select("lang", F.least("own", "with").alias("block"), F.greatest("own", "with").alias("block_2"), "slice", "term", "g", "n"))

    def multiply(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = pa.schema([("lang", pa.string()), ("g", pa.int32()), ("h", pa.int32()), ("value", pa.int64())])
        if not right.num_rows:
            return out.empty_table()
        cell = right.slice(0, 1).to_pylist()[0]
        numbers, totals = cell["g"] + cell["g_2"], cell["total"] + cell["total_2"]
        column = {g: k for k, g in enumerate(numbers)}
        split = len(cell["g"])
        counts = np.zeros((cell["kept"], len(numbers)), np.int64)   # terms without a row here have level 0 everywhere
        if left.num_rows:
            term = left["term"].combine_chunks().dictionary_encode().indices.to_numpy()
            at = np.array([column[g] for g in left["g"].to_pylist()])
            counts[term, at] = left["n"].to_numpy()
        value = priced_products(counts, totals, cell["terms"], split)
        g, h = np.nonzero(~np.eye(len(numbers), dtype=bool))
        kept = np.ones(len(g), bool) if split == len(numbers) else (g < split) != (h < split)
        g, h = g[kept], h[kept]
        names = np.array(numbers, np.int32)
        return pa.Table.from_arrays([pa.array([cell["lang"]] * len(g), pa.string()), pa.array(names[g]), pa.array(names[h]), pa.array(value[g, h])], schema=out)

    on = ["lang", "block", "block_2", "slice"]
    priced = meant.groupBy(*on).cogroup(cells.groupBy(*on)).applyInArrow(multiply, "lang string, g int, h int, value long")
    return priced.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))


# -- the audit -----------------------------------------------------------------


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source is from each other of its lang (part pair, all),
    and the terms it uses more than its lang does (part term, the first ``top_terms``)."""
    counts = materialize(term_counts(docs), "term-counts")
    of_term = Window.partitionBy("lang", "term")
    kept = (counts.where(F.col("term").isNotNull())
            .withColumn("in_docs", F.sum("docs").over(of_term)).where(F.col("in_docs") >= least_documents)
            .select("lang", "source", "term", "n", F.sum("n").over(of_term).alias("lang_n")))
    kept = materialize(kept, "kept-counts")
    # how many terms are kept, in slices of about TERMS of them
    terms = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
    langs = materialize(terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total")), "langs")
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    numbered = (counts.where(F.col("term").isNull()).select("lang", "source")
                .join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
                .select("lang", "source", F.coalesce("total", F.lit(0).cast("long")).alias("total"),
                        F.coalesce("terms", F.lit(0).cast("long")).alias("terms"), F.coalesce("lang_total", F.lit(0).cast("long")).alias("lang_total"),
                        (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("g")))
    groups = materialize(numbered, "groups")

    parts = F.ceil(F.col("terms") / TERMS).cast("int")
    slice_ = F.pmod(F.xxhash64("term"), parts).cast("int").alias("slice")
    # the sides hold a row for each group or term of a lang, not for each document
    entries = kept.join(groups.select("lang", "source", "g", "terms"), ["lang", "source"]).select("lang", slice_, "term", "g", "n")
    filled = terms.join(langs.select("lang", "terms"), "lang").select("lang", slice_).groupBy("lang", "slice").agg(F.count("*").alias("kept"))
    bare = groups.where("terms = 0").select("lang").distinct().select("lang", F.lit(0).alias("slice"), F.lit(0).cast("long").alias("kept"))
    value = pair_values(entries, groups.select("lang", "g", "total", "terms"), filled.unionByName(bare))
    mine, other = groups.select("lang", "g", "source"), groups.select("lang", F.col("g").alias("h"), F.col("source").alias("item"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = (value.join(mine, ["lang", "g"]).join(other, ["lang", "h"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank")))

    p, q = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    best = (kept.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").cast("string").alias("item"), p.alias("p"), q.alias("q"))
            .where("p > q").select("lang", "source", "item", price(F.col("p"), F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms))
    return pairs.unionByName(best.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT row_no, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY ALL HAVING count(DISTINCT row_no) >= 3),
v AS (SELECT g.lang, count(k.term)::HUGEINT AS terms, coalesce(sum(k.n), 0)::HUGEINT AS total
      FROM (SELECT DISTINCT lang FROM g) g LEFT JOIN k ON k.lang = g.lang GROUP BY g.lang),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t GROUP BY ALL),
a AS (SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(c.n, 0)::HUGEINT AS n
      FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM a GROUP BY ALL),
p AS (SELECT a.lang, a.source, a.term, a.n, 1 + 1000000000 * (a.n + 1) // (s.total + v.terms) AS p,
             1 + 1000000000 * (a.lang_n + 1) // (v.total + v.terms) AS q
      FROM a JOIN s ON s.lang = a.lang AND s.source = a.source JOIN v ON v.lang = a.lang),
pairs AS (
  SELECT x.lang, x.source, y.source AS item, coalesce(sum((i.p - j.p) * (i.p - j.p) // j.p), 0)::BIGINT AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN p i ON i.lang = x.lang AND i.source = x.source
  LEFT JOIN p j ON j.lang = y.lang AND j.source = y.source AND j.term = i.term
  WHERE i.term IS NULL OR j.term IS NOT NULL GROUP BY ALL),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER FROM terms)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def op12_divergence(spark, sf_dir: str) -> DataFrame:
    """Divergences of all sources within each language, and each source's most excessive terms."""
    return audit(table(spark, sf_dir, "documents", "text", "lang", "source"))
