import itertools
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from millrace.llm import binpack
from millrace.llm.common import materialize
from millrace.llm.queries import QUERIES

from llm_help import SF

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def check_places(rows):
    """No sequence above the capacity, no gap and no overlap; returns the number of sequences."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= binpack.CAPACITY
    return len(by)


def test_fullest_is_fullest():
    rng = np.random.default_rng(6)
    for _ in range(50):
        pieces = rng.integers(1, 30, 9).tolist()
        left = np.bincount(pieces, minlength=61).tolist()
        room = int(rng.integers(1, 60))
        best = max(sum(c) for k in range(10) for c in itertools.combinations(pieces, k) if sum(c) <= room)
        chosen = binpack.fullest(sorted(set(pieces), reverse=True), left, room)
        assert sum(chosen) == best and all(chosen.count(n) <= left[n] for n in chosen)


def test_query(spark):
    got = QUERIES["op10_pack"](spark, SF).collect()
    plain = Tokenizer.from_file(BYTE)
    pieces = {(r["doc_id"], r["piece"]): r for r in got}
    assert len(pieces) == len(got)
    total = 0
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = np.array([*plain.encode(d["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        own = [pieces[d["doc_id"], k] for k in range(-(-len(ids) // binpack.CAPACITY))]
        assert sum(p["length"] for p in own) == len(ids) and all(p["length"] == binpack.CAPACITY for p in own[1:])
        for p in own:
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"]:p["start"] + p["length"]].tobytes())
    assert check_places(got) <= -(-total // binpack.CAPACITY) * 1.02 + 1


def test_odd_rows(spark, odd_docs):
    pieces = materialize(binpack.cut_pieces(odd_docs, BYTE), "pieces")
    got = binpack.pack(pieces, shard=4).collect()
    assert len(got) == pieces.count()
    check_places(got)
    assert binpack.pack(pieces.limit(0)).count() == 0
