import collections
import random
import re

import numpy as np

from millrace.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, item string, rank string, n string"


def brute(rows):
    """rows of (text, lang, source) -> set of result rows."""
    rows = [tuple(x or "" for x in r) for r in rows]
    groups = {(lang, source) for _, lang, source in rows}
    count, in_docs = collections.Counter(), collections.Counter()
    for text, lang, source in rows:
        terms = [re.sub("[A-Z]+", lambda m: m[0].lower(), t) for t in re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        for t in terms:
            count[lang, source, t] += 1
        for t in set(terms):
            in_docs[lang, t] += 1
    out = set()
    for lang in {g[0] for g in groups}:
        sources = sorted(s for lg, s in groups if lg == lang)
        kept = [t for (lg, t), n in in_docs.items() if lg == lang and n >= 3]
        totals = {s: sum(count[lang, s, t] for t in kept) for s in sources}
        p = {(s, t): 1 + 10**9 * (count[lang, s, t] + 1) // (totals[s] + len(kept)) for s in sources for t in kept}
        q = {t: 1 + 10**9 * (sum(count[lang, s, t] for s in sources) + 1) // (sum(totals.values()) + len(kept)) for t in kept}
        for s in sources:
            pairs = [(-sum((p[s, t] - p[o, t]) ** 2 // p[o, t] for t in kept), o) for o in sources if o != s]
            terms = [(-((p[s, t] - q[t]) ** 2 // q[t]), t) for t in kept if count[lang, s, t] and p[s, t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                order = sorted(found, key=lambda f: (f[0], f[1].encode()))
                out |= {(lang, s, part, item, -v, rank) for rank, (v, item) in enumerate(order, 1) if part == "pair" or rank <= 200}
    return out


def run(spark, rows):
    df = spark.createDataFrame([(1, t, lang, source, 0, "g", "i", "r", "n") for t, lang, source in rows], SCHEMA).repartition(4)
    got = [tuple(r) for r in divergence.audit(df).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got))
    return set(got)


def some_rows(rng, sources=9, docs=120):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)] + ["Été", "été", "日本", "B", "b", "ß", "🎉x"]
    rows = []
    for _ in range(docs):
        source = rng.randrange(sources)
        text = " ".join(words[min(len(words) - 1, int(rng.expovariate(0.01 + source / 300)))] + rng.choice(["", ".", "1", "\t"]) for _ in range(rng.randrange(80)))
        rows.append((text, rng.choice(["en", "fr"]), f"s{source}"))
    return rows


def test_matches_brute_force(spark):
    rng = random.Random(1)
    rows = some_rows(rng)
    rows += [(None, None, None), ("", "de", "b"), ("one two", "de", "a"), ("x", "xx", "only")]    # groups without kept terms
    rows += [("Tie tie TIE uneven", None, "n")] * 4 + [("tie", "", None)] * 3 + [("tie [x]`{y}~ z\x7fq", "", "m")] * 3
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == set()


def test_blocks_and_slices(spark, monkeypatch):
    """Many blocks of groups and slices of terms give the same sums, and so do flushes while counting."""
    rows = some_rows(random.Random(2), 13, 150)
    for name, value in (("COLUMNS", 3), ("TERMS", 20), ("STRETCH", 12), ("HELD", 50), ("SLICE", 30)):
        monkeypatch.setattr(divergence, name, value)
    assert run(spark, rows) == brute(rows)


def test_more_terms_than_ranks(spark):
    rows = [(" ".join(f"{a}{b}" for a in "abcdefghijklmnopq" for b in "abcdefghijklmnopqrs") + " rest" * n, "en", f"s{n}") for n in range(4)]
    got = run(spark, rows)
    assert got == brute(rows) and max(r[5] for r in got) == 200


def test_products_are_joint_tables():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 4, (500, 5))
    for indicator, levels, first in divergence.stretches(counts):
        joint = indicator.T @ indicator
        assert joint.sum() == len(indicator) * 25
        for g in range(5):
            assert np.array_equal(np.diag(joint)[first[g]:first[g + 1]], indicator[:, first[g]:first[g + 1]].sum(0))


def test_counts_beyond_a_long():
    """A count of 10 billions times a billion does not fit 64 bits."""
    counts = np.array([[30_000_000_000, 5], [7, 20_000_000_000]])
    totals = counts.sum(0).tolist()
    p = [[1 + 10**9 * (int(n) + 1) // (totals[g] + 2) for n in counts[:, g]] for g in range(2)]
    value = divergence.priced_products(counts, totals, 2, 1)
    assert value[0, 1] == sum((a - b) ** 2 // b for a, b in zip(*p)) and value[1, 0] == sum((a - b) ** 2 // a for a, b in zip(*p))
