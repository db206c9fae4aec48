import hashlib
import random

import duckdb
import pytest

from helpers import ODD_TEXTS, WORD, docs_frame, words
from martflow.llm.bpe import WordBpe, encode, word_bpe_path
from martflow.llm.mixing import OP1_SQL, mix, repeat_documents


def corpus(seed=4):
    rng = random.Random(seed)
    rows = [(i, words(rng, rng.randrange(0, 60)), rng.choice(["a", "a", "a", "b", "c", "d", "é", None]))
            for i in range(400)]
    return rows + [(1000 + i, t, s) for i, t, s in ODD_TEXTS]


def test_mix_equals_sql_and_meets_targets(spark):
    rows = corpus()
    frame = docs_frame(spark, rows, extra=True)
    got = mix(frame).toPandas()
    con = duckdb.connect()
    documents = docs_frame(spark, rows).toPandas()  # noqa: F841  read by the SQL
    con.register("documents", documents)
    want = con.execute(OP1_SQL).df()
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    a, b = (x[cols].sort_values(cols).reset_index(drop=True) for x in (got, want))
    assert (a == b).all().all()
    largest = max(len(WORD.findall(t or "")) for _, t, _ in rows)
    by_source = got.fillna({"source": "~"}).groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((by_source.taken - by_source.target).abs() <= largest).all()
    assert (got.taken <= 2 * got["size"]).all()
    assert abs(got.groupby(got.source.fillna("~")).target.first().sum() - 1.5 * got["size"].sum()) < 1e-6


def test_mix_reruns_agree_and_buckets_do_not_matter(spark, monkeypatch):
    import martflow.llm.mixing as m
    frame = docs_frame(spark, corpus())
    first = sorted(map(tuple, mix(frame).select("doc_id", "copies").collect()))
    monkeypatch.setattr(m, "ROWS_PER_BUCKET", 7)
    assert sorted(map(tuple, mix(frame.repartition(3)).select("doc_id", "copies").collect())) == first


def test_mix_repeats_documents_and_handles_empty(spark):
    frame = docs_frame(spark, [(i, "a b c", "s" if i % 2 else None) for i in range(20)])
    mixed = mix(frame)
    assert repeat_documents(frame, mixed).count() == mixed.agg({"copies": "sum"}).first()[0]
    assert mix(docs_frame(spark, [])).count() == 0
    nothing = mix(docs_frame(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert [(r["taken"], r["target"]) for r in nothing] == [(0, 0.0), (0, 0.0)]


TEXTS = ["Hello's it'S \x1c\x85 ǆ Σίσυφος ΣΑΣ İstanbul 123 <|endoftext|> don't áb É!! ***%%% ﬁ", "", "   ",
         "<|startoftext|><|endoftext|>x", "日本語 テスト a" + "b" * 500, "́a ́", "İİ ŉ ǰ", "a<|b",
         "aªb ½²³ _x_ 'S 'LL 'tis don'T", "antidisestablishmentarianism " * 50, None]


def test_bpe_equals_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    lib = tokenizers.Tokenizer.from_file(word_bpe_path())
    rng = random.Random(1)
    texts = TEXTS + [t for _, t, _ in ODD_TEXTS] + [
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöß'!?* \n") for _ in range(rng.randrange(1, 300))) for _ in range(150)]
    rows = list(enumerate(texts))
    got = encode(docs_frame(spark, rows, extra=True), word_bpe_path()).collect()
    assert len(got) == len(rows)
    for r in got:
        e = lib.encode(texts[r["doc_id"]] or "", add_special_tokens=False)
        decoded = lib.decode(e.ids, skip_special_tokens=False)
        assert (list(r["ids"]), r["n_tokens"], r["decoded"]) == (e.ids, len(e.ids), decoded)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, e.ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_forgetting_words_changes_nothing(monkeypatch):
    import martflow.llm.bpe as m
    spec = open(word_bpe_path(), encoding="utf-8").read()
    texts = [words(random.Random(i), 50) for i in range(20)]
    want = list(WordBpe(spec).encode(texts))
    monkeypatch.setattr(m, "MAX_WORDS", 10)
    small = WordBpe(spec)
    assert [x for t in texts for x in small.encode([t])] == want


def test_bpe_words_in_use_are_not_learned_again(monkeypatch):
    import martflow.llm.bpe as m
    bpe = WordBpe(open(word_bpe_path(), encoding="utf-8").read())
    monkeypatch.setattr(m, "MAX_WORDS", 60)
    learned, learn = [], bpe.learn
    monkeypatch.setattr(bpe, "learn", lambda words: (learned.extend(words), learn(words)))
    rng = random.Random(3)
    for _ in range(20):
        fresh = ["".join(rng.choices("abcdefghij", k=12)) for _ in range(20)]
        list(bpe.encode(["common, words: " + " ".join(fresh)]))
    assert len(learned) > 400 and len(bpe.known) <= 110
    assert [learned.count(w) for w in ("common", "words", ",", ":")] == [1, 1, 1, 1]


def test_bpe_of_every_letter_below_u0600():
    tokenizers = pytest.importorskip("tokenizers")
    lib = tokenizers.Tokenizer.from_file(word_bpe_path())
    texts = [f"a{c}b {c}." for c in map(chr, range(0x600))]
    texts += ["<|STARTOFTEXT|> <|startoftext|>a <|endoftext|", "ab" * 3000 + "x " + "ab" * 3000 + "y"]
    got = list(WordBpe(open(word_bpe_path(), encoding="utf-8").read()).encode(texts))
    assert got == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_bpe_pairs_agree_with_plain_merging():
    bpe, rng = WordBpe(open(word_bpe_path(), encoding="utf-8").read()), random.Random(2)
    tokens = [t for t in bpe.vocab if not t.endswith("</w>")]
    for _ in range(3000):
        a, b = rng.choice(tokens), rng.choice(list(bpe.vocab)[:3000])
        plain = bpe.merged([s for t in (a, b) for s in bpe._symbols(t)]) == [a, b]
        assert bpe.fits(bpe.vocab[a], bpe.vocab[b]) == plain
