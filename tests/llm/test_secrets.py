import random

from pyspark.sql import functions as F

from millrace.llm import secrets
from millrace.llm.queries import QUERIES

from llm_help import SF, base_spans, sha


def test_base_spans_match_brute_force(spark, odd_docs):
    tricky = spark.createDataFrame([(1, "secret=token:abcdefgh"), (2, "API_KEY: 'a.b-c_d+e/f=' passwd=12345"), (3, "xAKIA" + "A1" * 12),
                                    (4, "é🎉 Password = hunter2hunter " + "ab" * 20), (5, "apikey=" + "f" * 30)], "doc_id long, text string")
    for docs in (spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), tricky, odd_docs.select("doc_id", "text")):
        got = secrets.find_spans(docs, ["doc_id", "text"]).collect()
        assert len(got) == docs.count()
        for r in got:
            base = [(s["start"], secrets.KINDS[s["kind"]], s["end"]) for s in r["spans"] if s["kind"] < 3]
            assert base == base_spans(r["text"])
    assert secrets.find_spans(tricky.limit(0), ["doc_id"]).count() == 0


def test_digest_columns(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op3_secrets"](spark, SF).collect():
        base = base_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == sha(",".join(f"{k}:{a}:{b}" for a, k, b in base))
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[1] == k for s in base) for k in ("assign", "access", "hex"))


def test_randomness_orders_tokens(spark):
    rng = random.Random(1)
    alphabet = secrets.ENCODINGS[-1][1]
    random_tokens = ["".join(rng.choices(alphabet, k=40)) for _ in range(30)]
    wordy = ["thattheandthisoftheretotheinthenthereandthat"[i % 5:][:39] for i in range(30)] + ["a" * 40, "ab" * 20]
    rows = spark.createDataFrame([(t, True) for t in random_tokens] + [(t, False) for t in wordy], "t string, random boolean")
    steps = rows.select("random", secrets.score_step(secrets.randomness(F.col("t"))).alias("s")).collect()
    assert max(sorted(r["s"] for r in steps if r["random"])[:27]) < min(r["s"] for r in steps if not r["random"])


def test_method_finds_keys_without_a_name(spark):
    rng = random.Random(2)
    alphabet = secrets.ENCODINGS[-1][1]
    prose = "the words of an ordinary text that goes on for a while and says nothing much about anything at all "
    rows = [(i, prose + "".join(rng.choices(alphabet, k=44)) + " " + prose) for i in range(80)]
    rows += [(1000 + i, prose + "thisisonelongwordwithoutanyblanksinit" + " " + prose) for i in range(20)]
    got = {r["doc_id"]: r["spans"] for r in secrets.find_spans(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()}
    assert sum(len(s) == 1 for i, s in got.items() if i < 1000) > 70
    assert all(not s for i, s in got.items() if i >= 1000)


def test_redaction(spark, odd_docs):
    rows = spark.createDataFrame([(1, 'a token = "abcdef123456" b', 5), (2, None, None), (3, "clean", 5), (4, "secret=AKIA" + "B" * 20 + " z", 1)],
                                 "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in secrets.redact(rows).collect()}
    assert got == {1: ('a [SECRET]" b', 13), 2: (None, None), 3: ("clean", 5), 4: ("[SECRET] z", 10)}
    masked = secrets.redact(odd_docs)
    assert masked.columns == odd_docs.columns and masked.count() == odd_docs.count()
    assert masked.where("text like '%24be6443%'").count() == 0


def test_lists_without_text_between_do_not_lower_the_rate(spark):
    """Paths one a line have no decoys; they must not count as discoveries that nothing speaks against."""
    rng = random.Random(4)
    parts = ["data", "build", "output", "reports", "images", "archive", "module", "backup", "section", "library"]
    prose = "the words of an ordinary text that goes on for a while and says nothing much about anything at all "
    listed = ["/".join(rng.choices(parts, k=5)) + f"/{i}" for i in range(600)]
    rows = [(i, "\n".join(listed[20 * i:20 * i + 20])) for i in range(30)]
    rows += [(100 + i, prose + "thisisonelongwordwithoutanyblanksinit" + "abcdefgh"[i] + " " + prose) for i in range(8)]
    spans = secrets.find_spans(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()
    assert sum(len(r["spans"]) for r in spans if r["doc_id"] < 100) <= 30


def test_decoys_of_long_candidates(spark):
    rng = random.Random(5)
    token = "".join(rng.choices(secrets.ENCODINGS[-1][1], k=2500))
    for text, has in (("some words " * 400, True), ("some words " * 400 + ". " * 3000, True), ("a few words ", False)):
        df = spark.createDataFrame([(text,)], "t string")
        got = df.select(secrets._decoy(F.col("t"), F.lit(len(token))).alias("d")).first()["d"]
        assert got == ("".join(c for c in text if c.isalnum())[-2500:] if has else None)
