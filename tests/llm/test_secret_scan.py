"""The battery's own cases: whole runs, letters, text left alone, long texts."""

from __future__ import annotations

import random
import string
import time

import pytest
from pyspark.sql import functions as F

from helpers import docs_frame
from martflow.llm import secret_scan as m

ALPHABETS = {"lower": string.ascii_lowercase, "upper": string.ascii_uppercase, "letters": string.ascii_letters,
             "base62": string.ascii_letters + string.digits, "base36": string.ascii_lowercase + string.digits}


def keys(rng, alphabet, n, length):
    return ["".join(rng.choice(alphabet) for _ in range(length)) for _ in range(n)]


def random_spans(spark, texts):
    rows = m.scan(docs_frame(spark, list(enumerate(texts)), extra=True)).collect()
    return {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == 3] for r in rows}


def test_a_random_key_of_letters_is_found(spark):
    rng = random.Random(1)
    kinds = [("letters", 40), ("upper", 64), ("lower", 64)]
    texts = [(n, f"key {k} end") for name, n in kinds for k in keys(rng, ALPHABETS[name], 40, n)]
    got = random_spans(spark, [t for _, t in texts])
    for i in range(3):
        assert sum(got[40 * i + j] == [(4, 4 + kinds[i][1])] for j in range(40)) >= 34, kinds[i]


def test_a_run_around_a_base_span_is_found_whole(spark):
    rng = random.Random(2)
    texts = []
    rest = keys(rng, ALPHABETS["base62"], 40, 12)
    for a, b in zip(rest[:20], rest[20:]):
        texts.append(f"see {a}Z{''.join(rng.choice('0123456789abcdef') for _ in range(26))}X{b} end")
    rows = m.scan(docs_frame(spark, list(enumerate(texts)))).collect()
    whole = 0
    for r in rows:
        kinds = {(s["kind"]): (s["start"], s["end"]) for s in r["spans"]}
        assert kinds[2][0] >= 4 and kinds[2][1] - kinds[2][0] >= 26      # the base span stays
        whole += kinds.get(3) == (4, len(texts[r["doc_id"]]) - 4)
    assert whole >= 18
    masked = {r["doc_id"]: r["text"] for r in m.mask(docs_frame(spark, list(enumerate(texts)))).collect()}
    assert sum(t == "see [SECRET] end" for t in masked.values()) == whole


WORDS = ("Donaudampfschifffahrtsgesellschaft anticonstitutionnellement electroencephalographically "
         "incomprehensibilities Rechtsschutzversicherungsgesellschaften counterrevolutionaries "
         "desoxyribonucleic/ribonucleic getUserAccountSettingsByName HttpServletRequestWrapper "
         "wp-content/uploads/themes/twenty DEFAULT_MAXIMUM_CONNECTIONS ---------------- ================ "
         "internationalization characteristically").split()


def test_words_are_left_alone_and_keys_among_them_found(spark):
    rng = random.Random(3)
    words = [f"{rng.choice(WORDS)} {i} and {rng.choice(WORDS)} {rng.choice(WORDS)}" for i in range(300)]
    planted = keys(rng, ALPHABETS["base62"], 100, 32)
    texts = [f"{w} {k}" for w, k in zip(words, planted)] + words[100:]
    got = random_spans(spark, texts)
    hits = sum((len(words[i]) + 1, len(words[i]) + 33) in got[i] for i in range(100))
    reported = sum(map(len, got.values()))
    assert hits >= 90 and reported - hits <= 0.1 * reported


@pytest.mark.parametrize("name,length,least", [("base62", 16, 70), ("letters", 24, 80)])
def test_share_of_planted_keys_found(spark, name, length, least):
    rng = random.Random(length)
    texts = [f"a line with {k} in it" for k in keys(rng, ALPHABETS[name], 100, length)]
    assert sum(got == [(12, 12 + length)] for got in random_spans(spark, texts).values()) >= least


def test_text_only_gives_no_span(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(WORDS) for _ in range(20)) for _ in range(100)]
    assert sum(map(len, random_spans(spark, texts).values())) <= 5


def test_running_totals_equal_python(spark):
    rng = random.Random(5)
    rows = [(i, [rng.randrange(100) for _ in range(n)]) for i, n in enumerate([0, 1, 2, 255, 256, 257, 1000, 70_000])]
    df = spark.createDataFrame(rows, "i int, v array<int>")
    got = df.select("i", m.running(F.col("v"), lambda a, b: a + b).alias("s"),
                    m.running(F.col("v"), lambda a, b: F.greatest(a, b)).alias("m")).collect()
    for r in got:
        v, total, top, s, t = rows[r["i"]][1], 0, 0, [], []
        for x in v:
            total, top = total + x, max(top, x)
            s.append(total)
            t.append(top)
        assert r["s"] == s and r["m"] == t


def test_masking_equals_python(spark):
    rng = random.Random(6)
    rows = []
    for i in range(60):
        n = rng.choice([0, 5, 100, m.STRETCH - 1, m.STRETCH, m.STRETCH + 1, 3 * m.STRETCH])
        text = "".join(rng.choice("abé\U0001F600 ") for _ in range(n))
        spans = []
        for _ in range(rng.choice([0, 1, 30]) if n else 0):
            a = rng.randrange(n)
            spans.append((a, min(n, a + rng.choice([1, 7, 50, m.STRETCH]))))
        rows.append((i, text, sorted(spans)))
    df = spark.createDataFrame(rows, "i int, text string, spans array<struct<start:int,end:int>>")
    got = {r["i"]: r["t"] for r in df.select("i", m.replaced(F.col("text"), F.col("spans"), mark="[SECRET]").alias("t")).collect()}
    for i, text, spans in rows:
        out, at = [], 0
        for a, b in spans:
            if a >= at:
                out += [text[at:a], "[SECRET]"]
            at = max(at, b)
        assert got[i] == "".join(out) + text[at:], i


def test_a_long_text_full_of_secrets_takes_seconds(spark):
    """340,000 characters with 20,000 secrets, and one run of 100,000 characters."""
    rng = random.Random(7)
    text = " ".join(f"token={rng.randrange(10 ** 7, 10 ** 8)}zz" for _ in range(20_000))
    run = "".join(rng.choice(ALPHABETS["base62"]) for _ in range(100_000))
    frame = docs_frame(spark, [(1, text), (2, run), (3, None)])
    began = time.time()
    got = {r["doc_id"]: r["text"] for r in m.mask(frame).collect()}
    assert got[1] == " ".join(["[SECRET]"] * 20_000) and got[2] == "[SECRET]" and got[3] is None
    assert time.time() - began < 120


def test_mask_of_an_empty_table_and_clashing_names(spark):
    assert m.mask(docs_frame(spark, [])).count() == 0
    frame = docs_frame(spark, [(1, "password=abcdefgh x")], extra=True).withColumn("row", F.lit(7)).withColumn("base", F.lit(8))
    out = m.mask(frame)
    assert out.columns == frame.columns and [(r["text"], r["row"], r["base"], r["spans"]) for r in out.collect()] == [
        ("[SECRET] x", 7, 8, "clash")]
