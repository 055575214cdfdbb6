"""Secret scan: fixed key patterns, and a battery of randomness tests (native).

Base spans come from three patterns.  The method adds spans of kind ``random``:
every run of 20 or more key characters is a candidate.  Its encoding is
inferred from the characters it uses, and three tests ask whether its symbols
look uniformly drawn from that alphabet: chi-squared of the symbol counts, the
number of runs above and below the middle of the alphabet, and the serial
correlation of neighbours.  Fisher's sum combines the three p-values.

Each candidate also gets a decoy of the same length: the letters and digits of
the text just before it, with everything else removed.  Decoys go through the
same battery.  Within a class of lengths, the false-discovery rate at a score
is the number of decoys that score as random over the number of candidates that
do; a candidate is reported while that rate is at most ``FALSE_DISCOVERIES``.
Candidates without enough text before them, as in lists of one key a line,
count as if their decoys scored like the others of the class: the decoys are
scaled to the number of candidates, and a class without any reports nothing.
Equal candidates count once, so a key that a third of all documents repeat does
not carry the rate.  Short strings give the tests little power, so their class
needs a stricter score or reports nothing at all.

Positions are code points, end exclusive.  A random span that overlaps a base
span is left out.

Defined cases: a null or empty text has no spans; a candidate without enough
text before it has no decoy of its own; equal rows are scanned each on its own; an empty
table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialize, set_aside, table, text_or_empty

# Fixed values of the contract: the kinds in order, and their patterns.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"

#: A candidate of the method: a run of so many key characters.
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
#: Alphabets by the pattern that infers them, the narrowest first.
ENCODINGS = (
    ("[0-9]+", "0123456789"),
    ("[0-9a-f]+", "0123456789abcdef"),
    ("[0-9A-F]+", "0123456789ABCDEF"),
    ("[A-Z2-7]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("[a-z0-9]+", "abcdefghijklmnopqrstuvwxyz0123456789"),
    (".*", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
)
LENGTH_CLASSES = (28, 40, 64)
FALSE_DISCOVERIES = 0.05
#: Scores are -log10 of the combined p-value, in steps of 0.05 up to this many.
STEPS = 200


def _decoy(before: Column, width: Column) -> Column:
    """The last ``width`` letters and digits of a text, or null if it has fewer."""
    def last(text: Column, otherwise: Column) -> Column:
        return _let(F.regexp_replace(text, "[^A-Za-z0-9]", ""),
                    lambda t: F.when(F.length(t) >= width, F.substring(t, F.length(t) - width + 1, width)).otherwise(otherwise))

    # the end of the text mostly holds enough; else the whole is read
    whole = F.when(F.length(before) > 4000, last(before, F.lit(None).cast("string")))
    return last(F.substring(before, -4000, 4000), whole)


def _matches(text: Column, pattern: str, kind: str, group: int = 0, on: Column | None = None) -> Column:
    """All matches of a pattern as an array of structs, with the length of the text before each."""
    on = text.rlike(pattern) if on is None else on & text.rlike(pattern)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    is_random = kind == "random"
    spans = F.transform(
        F.arrays_zip(found.alias("found"), values.alias("value"), F.split(text, pattern, -1).alias("before")),
        lambda x, i: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), i.alias("nth"),
            F.length(x["before"]).alias("gap"), F.length(x["found"]).alias("width"),
            F.length(x["value"]).alias("value_width"),
            (x["found"] if is_random else F.lit(None).cast("string")).alias("token"),
            (_decoy(x["before"], F.length(x["found"])) if is_random else F.lit(None).cast("string")).alias("decoy")))
    # the split has one piece more than there are matches: the text after the last
    spans = F.filter(spans, lambda x: x["width"].isNotNull())
    return F.when(on, spans)


def _normal_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, by a logistic approximation (absolute error below 2e-4)."""
    return 1.0 / (1.0 + F.exp(F.lit(1.5976) * z + F.lit(0.07056) * z * z * z))


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2.0 * _normal_tail(F.abs(z)))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _chi_squared(x: Column) -> Column:
    """Are all symbols equally frequent?  Wilson and Hilferty's normal form of the statistic."""
    squares = F.aggregate(F.split(x["alphabet"], ""), F.lit(0.0),
                          lambda acc, ch: acc + F.pow(x["n"] - F.length(F.replace(x["symbols"], ch, F.lit(""))), F.lit(2.0)))
    free = x["size"] - 1
    ratio = F.pow((squares * x["size"] / x["n"] - x["n"]) / free, F.lit(1.0 / 3))
    return _normal_tail((ratio - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free)))


def _moments(x: Column) -> Column:
    """One pass over the symbols' places: sums, products of neighbours, runs above and below the middle."""
    def state(total, squares, products, high, runs, last, head):
        return F.struct(total.alias("sum"), squares.alias("sq"), products.alias("prod"), high.alias("high"),
                        runs.alias("runs"), last.alias("last"), head.alias("head"))

    none = F.lit(None).cast("double")

    def step(a: Column, ch: Column) -> Column:
        place = F.instr(x["alphabet"], ch).cast("double") - 1
        above = (place * 2 >= x["size"]).cast("double")
        changed = F.coalesce((above != (a["last"] * 2 >= x["size"]).cast("double")).cast("double"), F.lit(1.0))
        return state(a["sum"] + place, a["sq"] + place * place, a["prod"] + F.coalesce(a["last"] * place, F.lit(0.0)),
                     a["high"] + above, a["runs"] + changed, place, F.coalesce(a["head"], place))

    return F.aggregate(F.split(x["symbols"], ""), state(*[F.lit(0.0)] * 5, none, none), step)


def _runs(s: Column, n: Column) -> Column:
    """Wald and Wolfowitz: is the number of runs what independent symbols give?"""
    pairs = 2 * s["high"] * (n - s["high"])
    spread = F.sqrt(pairs * (pairs - n) / (n * n * (n - 1)))
    return F.when(pairs > n, _two_sided((s["runs"] - pairs / n - 1) / spread)).otherwise(F.lit(1e-9))


def _serial(s: Column, n: Column) -> Column:
    """Is the correlation of neighbouring symbols that of independent ones?"""
    mean = s["sum"] / n
    scatter = s["sq"] - n * mean * mean
    covered = s["prod"] - mean * (2 * s["sum"] - s["head"] - s["last"]) + (n - 1) * mean * mean
    return F.when(scatter > 1e-9, _two_sided((covered / scatter + 1 / n) * F.sqrt(n))).otherwise(F.lit(1e-9))


def randomness(token: Column) -> Column:
    """Array (chi-squared, runs, serial) of p-values that the symbols are uniform and independent."""
    def inferred(symbols: Column) -> Column:
        return F.struct(symbols.alias("symbols"), F.coalesce(
            *(F.when(symbols.rlike(f"^{p}$"), F.lit(a)) for p, a in ENCODINGS)).alias("alphabet"))

    def sized(x: Column) -> Column:
        return F.struct(x["symbols"].alias("symbols"), x["alphabet"].alias("alphabet"),
                        F.greatest(F.length(x["symbols"]), F.lit(2)).cast("double").alias("n"),
                        F.length(x["alphabet"]).cast("double").alias("size"))

    def tests(x: Column) -> Column:
        return F.concat(F.array(_chi_squared(x)), _let(_moments(x), lambda s: F.array(_runs(s, x["n"]), _serial(s, x["n"]))))

    symbols = F.replace(F.translate(token, "-_", "+/"), F.lit("="), F.lit(""))
    return _let(symbols, lambda t: _let(inferred(t), lambda x: _let(sized(x), tests)))


def score_step(p_values: Column) -> Column:
    """Fisher's combination of three p-values as a step of -log10: 0 is most random."""
    half = F.aggregate(p_values, F.lit(0.0), lambda acc, p: acc - F.log(F.greatest(p, F.lit(1e-12))))
    return _let(half, lambda h: F.least(F.lit(STEPS), F.floor(
        -F.log10(F.greatest(F.exp(-h) * (1 + h + h * h / 2), F.lit(1e-30))) * 20)).cast("int"))


def length_class(width: Column) -> Column:
    return sum(((width >= edge).cast("int") for edge in LENGTH_CLASSES), F.lit(0))


def thresholds(found: DataFrame) -> DataFrame:
    """(length class, last) : the largest score step at which false discoveries are rare enough.

    ``found`` has token, width, decoy, step.  At most one row for each class.
    """
    distinct = (found.groupBy("token", "width", "step").agg(F.min("decoy").alias("decoy"))
                .select(length_class(F.col("width")).alias("class"), "step", "decoy"))
    counts = (distinct.select("class", F.explode(F.array(
        F.struct(F.col("step").alias("step"), F.lit(1).alias("real"), F.lit(0).alias("fake")),
        F.struct(F.when(F.col("decoy").isNotNull(), score_step(randomness(F.col("decoy")))).otherwise(F.lit(STEPS)).alias("step"),
                 F.lit(0).alias("real"), F.col("decoy").isNotNull().cast("int").alias("fake")))).alias("x"))
        .groupBy("class", "x.step").agg(F.sum("x.real").alias("real"), F.sum("x.fake").alias("fake")))
    upto = Window.partitionBy("class").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # candidates for each decoy; null, and so no rate, in a class without decoys
    whole = Window.partitionBy("class")
    scale = F.sum("real").over(whole) / F.nullif(F.sum("fake").over(whole), F.lit(0))
    return (counts.withColumn("rate", scale * (1 + F.sum("fake").over(upto)) / F.greatest(F.lit(1), F.sum("real").over(upto)))
            .where(F.col("rate") <= FALSE_DISCOVERIES).where(F.col("step") < STEPS)
            .groupBy("class").agg(F.max("step").alias("last")))


def find_spans(docs: DataFrame, keep: list[str]) -> DataFrame:
    """One row for each input row: ``keep`` columns and ``spans``, an array of (start, kind, end).

    ``docs`` needs a text column; spans are in order of start, then kind.  One
    pass over the texts writes the matches to the shared folder; what follows
    reads only those.
    """
    text = text_or_empty()
    has_candidate = F.col("has_candidate")
    scanned = (docs.select(F.monotonically_increasing_id().alias("row_no"), F.struct(*keep).alias("kept"), text.alias("text"))
               .withColumn("has_candidate", F.col("text").rlike(CANDIDATE)))
    t = F.col("text")
    found = F.concat(*(F.coalesce(m, F.array()) for m in (
        _matches(t, ASSIGN, "assign", 2, t.contains("=") | t.contains(":")),
        _matches(t, ACCESS, "access", 0, has_candidate & t.contains("AKIA")),
        _matches(t, HEX, "hex", 0, has_candidate),
        _matches(t, CANDIDATE, "random", 0, has_candidate))))
    nth = Window.partitionBy("row_no", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (scanned.select("row_no", "kept", F.explode_outer(found).alias("m")).select("row_no", "kept", "m.*")
            .repartition("row_no")
            .withColumn("end", F.sum(F.col("gap") + F.col("width")).over(nth))
            .withColumn("start", F.col("end") - F.col("width"))
            .where(F.col("kind").isNull() | (F.col("kind") > 0) | (F.col("value_width") >= ASSIGN_VALUE) | (F.col("nth") == 0))
            .withColumn("kind", F.when((F.col("kind") == 0) & (F.col("value_width") < ASSIGN_VALUE), None).otherwise(F.col("kind")))
            .select("row_no", "kept", "kind", "start", "end", "width", "token", "decoy",
                    F.when(F.col("kind") == 3, score_step(randomness(F.col("token")))).alias("step")))
    rows = materialize(rows, "secret-matches")
    limit = F.broadcast(materialize(thresholds(rows.where("kind = 3")), "secret-limits"))
    by_start = Window.partitionBy("row_no").orderBy("start")
    base = F.col("kind") < 3
    judged = (rows.drop("token", "decoy")
              .join(limit, length_class(F.col("width")) == F.col("class"), "left")
              .withColumn("kind", F.when(base | (F.col("step") <= F.col("last")), F.col("kind")))
              .withColumn("reach", F.max(F.when(base, F.col("end"))).over(by_start.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
              .withColumn("ahead", F.min(F.when(base, F.col("start"))).over(by_start.rangeBetween(Window.currentRow, Window.unboundedFollowing))))
    overlaps = F.coalesce(F.col("reach") > F.col("start"), F.lit(False)) | F.coalesce(F.col("ahead") < F.col("end"), F.lit(False))
    span = F.when(base | (F.col("kind").isNotNull() & ~overlaps), F.struct("start", "kind", "end"))
    return (judged.groupBy("row_no").agg(F.first("kept").alias("kept"), F.sort_array(F.collect_list(span)).alias("spans"))
            .select(*(F.col(f"kept.{c}") for c in keep), "spans"))


def span_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found secret in ``text`` replaced by a mark, and n_chars to match.

    Overlapping spans are replaced together.  Rows without a match are returned
    as they are and take no part in any shuffle; a null text stays null.
    """
    columns = docs.columns
    docs, restore = set_aside(docs, "text", *(["n_chars"] if "n_chars" in columns else []))
    t = text_or_empty()
    hit = t.rlike(CANDIDATE) | ((t.contains("=") | t.contains(":")) & t.rlike(ASSIGN))
    found = find_spans(docs.where(hit), docs.columns)
    # cover each span only beyond what earlier spans have covered
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def cut(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        between = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["parts"], F.array(between, F.lit(mark)))).otherwise(acc["parts"]).alias("parts"))

    def finish(acc: Column) -> Column:
        rest = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.length("text"))
        return F.concat(F.array_join(acc["parts"], ""), rest)

    masked = F.when(F.size("spans") > 0, F.aggregate(F.col("spans"), zero, cut, finish)).otherwise(F.col("text"))
    out = found.withColumn("text", masked)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return restore(docs.where(~hit).unionByName(out.select(*docs.columns)))


def op3_secrets(spark, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    found = find_spans(table(spark, sf_dir, "documents", "doc_id", "text"), ["doc_id"])
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
