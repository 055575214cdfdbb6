import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from millrace.llm import binpack, common, tokens, toxicity
from millrace.llm.common import materialize

from llm_help import SF, near_classes


def test_stages(spark, docs):
    """Each stage against what it must keep of the rows it is given."""
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = materialize(stage(spark, before, SF), "test-stage")
        assert after.columns == docs.columns and after.count() > 0
        old = {r["doc_id"]: r for r in before.collect()}
        new = after.collect()
        if name in ("toxicity", "mixing"):
            assert all(old[r["doc_id"]] == r for r in new)
        if name == "toxicity":
            toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()} & set(old)
            assert len(toxic & {r["doc_id"] for r in new}) >= 0.9 * len(toxic)
        if name == "near duplicates":
            classes = near_classes([(i, r["text"]) for i, r in old.items()])
            assert sorted(r["doc_id"] for r in new) == sorted(set(classes.values()))
        if name == "secrets":
            assert sorted(r["doc_id"] for r in new) == sorted(old)
            assert all(r["n_chars"] == len(r["text"]) for r in new if r["text"] != old[r["doc_id"]]["text"])
        before = after
    name, stage = corpus_pipeline.STAGES[-1]
    packed = stage(spark, before, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in before.collect()}
    fill = {}
    for r in packed:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= binpack.CAPACITY


def test_odd_rows(spark, odd_docs):
    for start in (odd_docs, odd_docs.limit(0)):
        rows = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = materialize(stage(spark, rows, SF), "test-odd")
            assert rows.columns == odd_docs.columns
        corpus_pipeline.STAGES[-1][1](spark, rows, SF).count()


def _held_mb():
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"\nAnonymous:\s+(\d+)", f.read())[1]) >> 10


@pytest.mark.skipif(not common._TRIM, reason="needs glibc")
def test_a_worker_keeps_no_freed_memory():
    """A pass that frees 200 MB below a block that stays leaves them to the system, not to the next stage's worker."""
    stays = []

    def run(batches):
        for batch in batches:
            many = [np.ones(6_000) for _ in range(4_300)]
            stays.append(np.ones(6_000))
            many.clear()
            yield batch

    before, batch = _held_mb(), pa.record_batch({"x": [1]})
    assert sum(b.num_rows for b in common.lean(run)(iter([batch]))) == 1
    assert _held_mb() - before < 60


def test_passes_over_texts_hold_few_at_a_time(spark, monkeypatch):
    """Scoring and cutting take a batch in runs of rows, give memory back after each, and return what the whole batch does."""
    texts = ["the quick idiot", None, "", "x y " * 200, *(f"word{i} again" for i in range(40)), "é日本 " * 30]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    docs = spark.createDataFrame([], "doc_id long, text string")
    passes, freed = [], []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: passes.append(run) or self)
    monkeypatch.setattr(common, "give_back", lambda: freed.append(1))
    weights = np.random.default_rng(1).standard_normal(toxicity.BUCKETS).astype(np.float32)
    toxicity.score(docs, weights, 0.1)
    binpack.cut_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    for run, module, name in zip(passes, (toxicity, binpack), ("READ", "AT_ONCE")):
        whole = list(run(iter([batch])))
        monkeypatch.setattr(module, name, 100)
        freed.clear()
        parts = list(run(iter([batch])))
        assert len(whole) == 1 and len(parts) > 5 and len(freed) == len(parts) + 1
        assert pa.Table.from_batches(parts).combine_chunks().equals(pa.Table.from_batches(whole).combine_chunks())


def test_the_library_gets_few_texts_at_once(monkeypatch):
    texts = [" ".join(f"w{i}q{k}, Word{k}x{i}" for i in range(30)) for k in range(40)] + ["", "a\nb  c"]
    path = public_tokenizers.path("byte_bpe_50k.json")
    want = tokens.UnitEncoder(path).encode(texts)
    assert want == [np.array(e.ids, "<u2").tobytes() for e in tokens.UnitEncoder(path).tokenizer.encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(tokens, "CALL", 16)
    monkeypatch.setattr(tokens, "RUN", 4)
    encoder, calls = tokens.UnitEncoder(path), []

    class Spy:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def __getattr__(self, name):
            return getattr(self.tokenizer, name)

        def encode_batch_fast(self, some, **options):
            calls.append(len(some))
            return self.tokenizer.encode_batch_fast(some, **options)

    encoder.tokenizer, encoder.plain = Spy(encoder.tokenizer), Spy(encoder.plain)
    assert encoder.encode(texts) == want and max(calls) <= 16
