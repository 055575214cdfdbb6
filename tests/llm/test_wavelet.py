import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import wavelet
from millrace.llm.queries import QUERIES
from millrace.llm.tokens import UnitEncoder

from llm_help import SF

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 4000])
def test_rank_select_access(n):
    ids = np.random.default_rng(n).integers(0, 200, n).astype("<u2")
    built = wavelet.WaveletMatrix.build(ids, 8)
    m = wavelet.WaveletMatrix(built.n, built.zeros, built.planes.tobytes(), built.ones.tobytes())
    assert (m.decode() == ids).all()
    assert [m.access(i) for i in range(0, n, 97)] == ids[::97].tolist()
    for token in (0, 7, 199, 1000):
        places = np.flatnonzero(ids == token)
        assert m.count(token) == len(places) and m.count(token, n // 3) == (places < n // 3).sum()
        assert [m.occurrence(token, k) for k in range(len(places))] == places.tolist()
        assert m.occurrence(token, len(places)) == -1


def test_ids_dealt_in_blocks(monkeypatch):
    monkeypatch.setattr(wavelet, "BLOCK", 64)
    for n in (0, 1, 63, 64, 65, 1000):
        ids = np.random.default_rng(n).integers(0, 200, n).astype("<u2")
        built = wavelet.WaveletMatrix.build(ids, 8)
        assert (built.decode() == ids).all() and [built.access(i) for i in range(0, n, 7)] == ids[::7].tolist()


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_units_give_the_ids_of_the_whole_text(path, monkeypatch):
    from millrace.llm import tokens
    texts = ["", " ", "a  b", "  lead", "trail  ", "a \n b", "x <|endoftext|> y", "a　b c", "don't we'll it's 12 345", "\x1c a \x1c b", "é à Σ ΑΣ", "word " * 50]
    plain = Tokenizer.from_file(path)
    expected = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    encoder = UnitEncoder(path)
    for limit in (1 << 21, 16):
        monkeypatch.setattr(tokens, "AT_ONCE", limit)
        assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == expected


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_units_of_all_letters_and_a_small_memory(path, monkeypatch):
    from millrace.llm import tokens
    letters = [chr(c) for c in range(0x41, 0x370)]
    rows = [f"x {c}ab a{c}. {c}\n{c}B {c}!? a{c}b{c.upper()}" for c in letters] + ["", "\n", "a\n\nb c\n d", "a\r\nb", "e\u0301 E\u0301. \u0130\u0301", "x. .x ." + "y" * 60 + " ."]
    plain = Tokenizer.from_file(path)
    expected = [plain.encode(t, add_special_tokens=False).ids for t in rows]
    monkeypatch.setattr(tokens, "MOST_UNITS", 50)
    monkeypatch.setattr(tokens, "AT_ONCE", 200)
    encoder = UnitEncoder(path)
    for _ in range(2):
        assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(rows)] == expected


def test_a_word_goes_to_the_library_once(monkeypatch):
    """Case, marks and line ends make no new words of a vocabulary whose normalization drops them."""
    encoder, asked = UnitEncoder(WORD), []
    ask = encoder._word_ids
    monkeypatch.setattr(encoder, "_word_ids", lambda words: asked.extend(words) or ask(words))
    text = "one Two two, TWO.\nThree three\nthree! two\nTwo"
    assert np.frombuffer(encoder.encode([text, text])[0], encoder.dtype).tolist() == Tokenizer.from_file(WORD).encode(text).ids
    assert sorted(asked) == ["one", "three", "two"]


def test_round_trip(spark):
    rows = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op9_wavelet"](spark, SF).collect()}
    plain, start = Tokenizer.from_file(WORD), 0
    for i, text in rows:
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert got[i] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) == len(rows)


def test_odd_rows(spark, odd_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(wavelet, "PART", 100)
    wavelet.write_shards(odd_docs, str(tmp_path / "a"), WORD)
    got = wavelet.document_ids(wavelet.read_shards(spark, str(tmp_path / "a"))).orderBy("start").collect()
    assert len(got) == odd_docs.count() and [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
    ids = [r["doc_id"] if r["doc_id"] is not None else 1 << 62 for r in got]
    assert ids == sorted(ids)
    wavelet.write_shards(odd_docs.limit(0), str(tmp_path / "b"), WORD)
    assert wavelet.document_ids(wavelet.read_shards(spark, str(tmp_path / "b"))).count() == 0
