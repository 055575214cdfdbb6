import collections
import random
import re

import numpy as np

from millrace.llm import ngram_join
from millrace.llm.queries import QUERIES

from llm_help import SF


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 4]) for i in range(len(words) - 3)} if len(words) > 3 else {tuple(words)} if words else set()


def brute(rows):
    """Multiset of (doc_id, n_shingles, component_id) by comparing all pairs that have a shingle in common."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = collections.defaultdict(list)
    for k, s in enumerate(sets):
        common = collections.Counter(q for x in s for q in where[x])
        for q, n in common.items():
            if 100 * n >= 85 * (len(s) + len(sets[q]) - n):
                parent[root(k)] = root(q)
        for x in s:
            where[x].append(k)
    smallest = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            smallest[root(k)] = min(smallest.get(root(k), i), i)
    return collections.Counter((i, len(s), smallest.get(root(k))) for k, ((i, _), s) in enumerate(zip(rows, sets)))


def run(spark, rows):
    df = spark.createDataFrame([(i, t, "k", "c", 1) for i, t in rows], "doc_id long, text string, set_key string, component string, n long").repartition(3)
    return collections.Counter(map(tuple, ngram_join.join_components(df).collect()))


def edited(rng, base, most):
    copy = list(base)
    for _ in range(rng.randrange(most + 1)):
        at = rng.randrange(len(copy))
        copy[at:at + rng.choice([0, 1, 1])] = [f"z{rng.randrange(12)}"]
    return copy


def test_query_matches_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert collections.Counter(map(tuple, QUERIES["op13_ngram_join"](spark, SF).collect())) == brute(rows)


def families(rng):
    rows = []
    for _ in range(12):
        base = [f"w{rng.randrange(900)}" for _ in range(rng.choice([6, 30, 80, 200]))]
        rows += [" ".join(edited(rng, base, rng.choice([1, 4, 12]))) for _ in range(rng.choice([2, 9, 25]))]
    # a chain whose ends are far apart, and a template that all share
    chain = [f"c{i}" for i in range(60)]
    for k in range(30):
        chain[k] = f"d{k}"
        rows.append(" ".join(chain))
    rows += [" ".join([f"t{i}" for i in range(40)] + [f"own{k}"] * (k % 9)) for k in range(40)]
    return [(k, t) for k, t in enumerate(rows)]


def test_families(spark):
    rows = families(random.Random(4))
    assert run(spark, rows) == brute(rows)


def test_small_blocks(spark, monkeypatch):
    """Groups cut into many blocks, with the largest component apart, lose no link; nor without the first rounds."""
    rows = families(random.Random(5))
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 4)
    assert run(spark, rows) == brute(rows)
    monkeypatch.setattr(ngram_join, "ROUNDS", 0)
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, passage), (2, passage), (2, passage), (3, None), (None, ""), (None, passage + " end"), (4, "x"), (5, "X"), (6, " \t\n"),
            (7, "été ßtraße 日本 🎉 " * 30), (8, "Été ßtraße 日本 🎉 " * 30), (9, passage.upper()), (None, "no id here at all"), (None, "no id here at all"),
            (10, "long text of many words " * 30_000), (11, "a b c"), (12, "a\tB\nc"), (13, "a b c d")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == collections.Counter()
    assert run(spark, [(1, None), (1, None)]) == brute([(1, None), (1, None)])


def test_tree_finds_all_links():
    rng = np.random.default_rng(2)
    for _ in range(20):
        base = np.arange(60)
        shingles = []
        for _ in range(40):
            kept = base[rng.random(60) < rng.choice([0.8, 0.95, 1.0])]
            shingles.append(np.unique(np.concatenate((kept, rng.integers(100, 200, rng.integers(0, 4))))).astype(np.uint64))
        sizes = np.array([len(s) + int(rng.integers(0, 3)) for s in shingles])   # some elements are in no other set
        linked = [(i, j) for i in range(40) for j in range(i) if ngram_join.enough(len(np.intersect1d(shingles[i], shingles[j])), sizes[i], sizes[j])]
        every = np.ones(40, bool)
        found = ngram_join.cell_links(shingles, sizes, np.arange(40), every, every)
        assert {tuple(sorted(p)) for p in found} <= {tuple(sorted(p)) for p in linked}

        def parts(pairs):
            label = list(range(40))
            for a, b in pairs:
                label = [label[a] if x == label[b] else x for x in label]
            return [label.index(x) for x in label]

        assert parts(found) == parts(linked)


def test_what_is_dealt_grows_with_the_shingles_not_with_the_buckets():
    sets = ngram_join.Sets([" ".join(f"w{i * k}" for i in range(30)) for k in range(1, 41)] + ["", None])
    sent = []
    for parts in (8, 4096):
        rows = [ngram_join._bucket(v, c, sets.keys[:, 0]) for v, c in ngram_join._dealt(sets.values, sets.sizes, parts)]
        assert sum(len(r[0]) for r in rows) == 4 * len(sets.values)
        assert all(len(r[2]) // 4 == len(r[3]) // 8 == np.unpackbits(np.frombuffer(r[1], np.uint8)).sum() for r in rows)
        sent.append(sum(len(r[2]) + len(r[3]) for r in rows))
    assert sent[1] <= 12 * len(sets.values)
