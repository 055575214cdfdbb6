import pytest

from millrace.llm import mixing
from millrace.llm.queries import QUERIES

from llm_help import SF, words


def targets(sizes, weights=(5, 2, 1), epochs=3):
    """Clamp and reshare until no target is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, clamped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in clamped]
        left = total - sum(epochs * sizes[s] for s in clamped)
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > epochs * sizes[s]}
        if not over:
            return {s: epochs * sizes[s] if s in clamped else share[s] for s in names}
        clamped |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 500, "d": 7, None: 90}, {"a": 0, "b": 5}, {"a": 3}])
def test_targets_are_the_fixed_point(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.target_table(df).collect()}
    assert got == pytest.approx(targets(sizes))


def test_mix_meets_targets(spark):
    got = QUERIES["op2_mix"](spark, SF).collect()
    again = QUERIES["op2_mix"](spark, SF).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sizes, taken, target = {}, {}, {}
    for r in got:
        source = docs[r["doc_id"]]["source"]
        assert r["size"] == len(words(docs[r["doc_id"]]["text"])) and r["taken"] <= 3 * r["size"]
        sizes[source] = sizes.get(source, 0) + r["size"]
        taken[source] = taken.get(source, 0) + r["taken"]
        target[source] = r["target"]
    assert target == pytest.approx(targets(sizes))
    assert all(0 <= target[s] - taken[s] < 1 for s in sizes)


def test_odd_rows(spark, odd_docs):
    mixed = mixing.mixed_documents(odd_docs)
    assert mixed.columns == odd_docs.columns
    kept = {str(r) for r in odd_docs.collect()}
    assert {str(r) for r in mixed.collect()} <= kept
    assert mixing.mixed_documents(odd_docs.limit(0)).count() == 0
    # equal rows share what is left at the cut
    rows = spark.createDataFrame([(1, "a", 10)] * 4 + [(2, "b", 1000)], "doc_id long, source string, size long")
    got = mixing.mix(rows, size="size").collect()
    assert sum(r["mix_whole"] * r["size"] + r["mix_words"] for r in got if r["source"] == "a") == 3 * 40
