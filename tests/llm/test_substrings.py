import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from millrace.llm import substrings
from millrace.llm.queries import QUERIES

from llm_help import SF, sha, words


def brute(rows):
    """(id, n_words, kept text) of each row by comparing all windows."""
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            window = tuple(w[s:s + 20])
            if window in seen:
                gone[s:s + 20] = [True] * 20
            seen.add(window)
        out.append((str(i), len(w), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out)


def _got(df):
    return sorted((str(r["doc_id"]), r["n_words"], r["kept_text"]) for r in substrings.remove_repeats(df).collect())


def test_query_matches_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = sorted((int(i), n, n - len(k.split(" ") if k else []), sha(k)) for i, n, k in brute(rows))
    assert sorted(map(tuple, QUERIES["op5_substrings"](spark, SF).collect())) == expected


def test_odd_rows(spark, odd_docs):
    narrow = odd_docs.select("doc_id", "text")
    assert _got(odd_docs) == brute([tuple(r) for r in narrow.collect()])
    assert _got(odd_docs.limit(0)) == []


def test_periodic_and_overlapping_repeats(spark, monkeypatch):
    rows = [(1, "a b c " * 40), (2, "x " + "a b c " * 9), (3, "q " * 25), (4, " ".join(f"n{i}" for i in range(19))),
            (5, " ".join(f"n{i}" for i in range(21)) + " " + " ".join(f"n{i}" for i in range(1, 21)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(df) == brute(rows)


def test_split_prefixes_change_nothing(spark, monkeypatch):
    common = " ".join(f"p{i}" for i in range(25))
    rows = [(i, f"only{i} words{i} " + common + f" tail{i}") for i in range(30)]
    whole = _got(spark.createDataFrame(rows, "doc_id long, text string"))
    monkeypatch.setattr(substrings, "MEMORY", 2)
    assert _got(spark.createDataFrame(rows, "doc_id long, text string")) == whole == brute(rows)


class _Task:
    """Stands for a data frame, and gives back the function that its tasks run."""

    def select(self, *columns):
        return self

    def mapInArrow(self, task, schema):
        return task


def _groups(task, batches, schema):
    out = pa.Table.from_batches([b for batch in batches for b in task(iter([batch]))], substrings._arrow(schema))
    return [out.filter(pc.equal(out["group"], g)) for g in sorted(set(out["group"].to_pylist()))]


def test_windows_of_a_crowded_prefix_meet_from_any_batch():
    """Batches of one task each, with the windows of a prefix in their first document or in a later one."""
    passage = " ".join(f"p{i}" for i in range(30))
    batches = [[(1, "a " + passage + " one"), (2, "b " + passage + " two and a longer end")], [(3, passage + " two and a longer end")],
               [(4, "c " + passage + " x"), (5, passage + " y"), (6, passage + " two and a longer end")]]
    found, crowded = {}, []
    arrow = [pa.record_batch({"number": pa.array([n for n, _ in b], pa.int64()), "place": pa.array([0] * len(b), pa.uint32()),
                              "text": [t for _, t in b]}) for b in batches]
    for group in _groups(substrings.prefix_runs(_Task(), 64), arrow, substrings._RUNS):
        for r in substrings.repeated_prefixes(group).to_pylist():
            found.setdefault(r["number"], []).append(r["marks"])
        crowded += substrings.crowded_prefixes(1)(group)["prefixes"].to_pylist()
    assert any(crowded)
    arrow = [b.append_column("marks", pa.array([found.get(n, []) for n in b["number"].to_pylist()], pa.list_(pa.binary())))
             .append_column("crowded", pa.array([crowded] * len(b), pa.list_(pa.binary()))) for b in arrow]
    gone = {n: np.zeros(len(words(t)), bool) for b in batches for n, t in b}
    for group in _groups(substrings.suffixes(_Task(), 64), arrow, substrings._SUFFIXES):
        for r in substrings.later_leaves(group).to_pylist():
            for m in np.frombuffer(r["marks"], substrings._MARK):
                gone[r["number"]][m["start"]:m["start"] + m["length"] + substrings.WINDOW - 1] = True
    rows = [r for b in batches for r in b]
    assert [(str(n), len(words(t)), " ".join(np.array(words(t))[~gone[n]])) for n, t in rows] == brute(rows)


def test_memory_is_an_argument_that_changes_nothing(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, (f"a{i} b{i} " if i % 3 else "") + passage + (f" two and a longer end {i % 5}" if i % 2 else f" {i}")) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for memory in (1, 5, 1000):
        assert sorted((str(r["doc_id"]), r["n_words"], r["kept_text"]) for r in substrings.remove_repeats(df, memory).collect()) == brute(rows)


def test_long_periodic_texts(spark):
    """Runs of windows longer than 65,535 words keep their length."""
    rows = [(1, "q " * 100_000), (2, "a b c " * 30_000), (3, "q " * 70_000 + "end"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(df) == brute(rows)
    assert {r["doc_id"]: sum(s["end"] - s["start"] for s in r["removed"]) for r in substrings.remove_repeats(df).collect()}[1] == 99_999
