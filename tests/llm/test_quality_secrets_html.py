import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from helpers import ODD_TEXTS, docs_frame, words
from martflow.llm import secret_scan
from martflow.llm.html_extract import main_text, parse
from martflow.llm.quality_crf import Chains, keep_good, score


# ---------------------------------------------------------------- quality
def prose(rng):
    return "\n".join(" ".join(rng.choice("the and of linden river stone walks under quiet morning light".split())
                              for _ in range(rng.randrange(6, 30))).capitalize() + "." for _ in range(rng.randrange(1, 6)))


def junk(rng):
    return "\n".join(" ".join(rng.choice(["*** buy", "$$$", "A | B", "!!", "x x x x"]) for _ in range(rng.randrange(5, 30)))
                     for _ in range(rng.randrange(1, 6)))


def labelled(n=400):
    rng = random.Random(11)
    rows = [(i, prose(rng) if i % 4 else junk(rng)) for i in range(n)]
    return rows, [(i, 1 if i % 4 else 0) for i in range(n)]


def test_quality_on_held_out_rows(spark):
    rows, labels = labelled()
    rows += [(1000 + i, t) for i, t, _ in ODD_TEXTS] + [(None, "A plain line.")]
    label_frame = spark.createDataFrame(labels + [(3, None), (5, 0)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in score(docs_frame(spark, rows, extra=True), label_frame).collect()}
    assert len(got) == len(rows)
    for i, q in labels:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
    held = [(i, q) for i, q in labels if got[i]["held_out"]]
    assert sum(got[i]["predicted"] == q for i, q in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    assert got[1001]["score"] == got[1002]["score"] == got[1003]["score"] == 0.0
    assert got[1007]["score"] == got[1008]["score"] and got[None]["held_out"] is False


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows, labels = labelled(200)
    frame = docs_frame(spark, rows)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q in labels]
    scores = [sorted((r["doc_id"], r["score"]) for r in score(frame, spark.createDataFrame(x, "doc_id long, quality int")).collect())
              for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_quality_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in score(docs_frame(spark, [(1, "a line")]), none).collect()] == [0.5]
    assert score(docs_frame(spark, []), none).count() == 0
    rows, labels = labelled(100)
    frame = docs_frame(spark, rows)
    kept = keep_good(frame, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert kept.schema == frame.schema and 60 <= kept.count() <= 80


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(4)
    unary, trans = rng.standard_normal(7), rng.standard_normal((2, 2))
    owner = np.array([0, 0, 0, 0, 1, 2, 2])
    good, pairs = Chains(owner).marginals(unary, trans)
    want, want_pairs = np.zeros(7), np.zeros((2, 2))
    for doc in range(3):
        at = np.nonzero(owner == doc)[0]
        total, part, pp = 0.0, np.zeros(len(at)), np.zeros((2, 2))
        for code in range(2 ** len(at)):
            y = [(code >> k) & 1 for k in range(len(at))]
            p = np.exp(sum(unary[a] * v for a, v in zip(at, y)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
            total += p
            part += p * np.array(y)
            for a, b in zip(y, y[1:]):
                pp[a, b] += p
        want[at] = part / total
        want_pairs += pp / total
    assert np.allclose(good, want) and np.allclose(pairs, want_pairs)


# ---------------------------------------------------------------- secrets
PATTERNS = [re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A),
            re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")]


def base_spans(text):
    out = []
    for kind, (rx, least) in enumerate(zip(PATTERNS, (6, 20, 24))):
        out += [(m.start(), kind, m.end()) for m in rx.finditer(text or "")
                if len(m.group(2) if kind == 0 else m.group()) >= least]
    return sorted(out)


def secret_rows():
    rng = random.Random(6)
    hexes = "".join(rng.choice("0123456789abcdef") for _ in range(40))
    b64 = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(60)) + "7"
    texts = [f'password="{hexes}" end', "token=abc password: token: abcdefgh", "API_KEY = 'abcdef' apikey:abcde",
             "AKIA" + "A" * 16 + " AKIASHORT AKIAAKIA" + "Z9" * 10, hexes + hexes[:20], "é😀é " + hexes + " x",
             f"\U0001F600 {b64} tail", "ſecret=abcdefgh toKen=abcdefgh", "secret : \n abcdefgh", "a" * 30 + "1" * 30 + " 0123456789012345678901234567",
             "token=token=abcdefgh secret='x' passwd=\"\" passwd= abcdefgh.=", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1"]
    return [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t, _ in ODD_TEXTS], b64


def test_secret_spans_equal_brute_force(spark):
    rows, b64 = secret_rows()
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]]
             for r in secret_scan.scan(docs_frame(spark, rows, extra=True)).collect()}
    for i, text in rows:
        assert [s for s in found[i] if s[1] < 3] == base_spans(text), text
    at = rows[6][1].index(b64)
    assert (at, 3, at + len(b64)) in found[6]                       # the battery finds the random string
    assert all(s[1] < 3 for s in found[9] + found[11])              # digits alone, one letter over and over: not random


def test_secret_query_and_mask(spark, tmp_path):
    rows, b64 = secret_rows()
    frame = docs_frame(spark, rows)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in secret_scan.op3_secret_scan(spark, str(tmp_path)).collect()}
    for i, text in rows:
        base = base_spans(text)
        digest = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert got[i]["base_sha256"] == hashlib.sha256(digest.encode()).hexdigest()
        assert [got[i][c] for c in ("n_assign", "n_access", "n_hex")] == [sum(s[1] == k for s in base) for k in range(3)]
    masked = {r["doc_id"]: r["text"] for r in secret_scan.mask(docs_frame(spark, rows, extra=True)).collect()}
    assert len(masked) == len(rows) and b64 not in masked[6] and masked[6] == "\U0001F600 [SECRET] tail"
    assert masked[100 + 1] is None
    assert secret_scan.scan(docs_frame(spark, [])).count() == 0


# ---------------------------------------------------------------- html
def page(article, side="<nav>menu</nav>", tail="<footer>foot</footer>"):
    return f"<!DOCTYPE html><html><head><title>t</title><script>var a='</p>';</script></head><body>{side}{article}{tail}</body></html>"


def text_of(html):
    return "\n".join(t for t, _ in parse(html)[0])


@pytest.mark.parametrize("html,want", [
    (None, ""), ("", ""), ("<", "<"), ("plain &amp; text", "plain & text"), ("<p>a<p>b", "a\nb"), ("<script>x", ""),
    (page("<article><h1>T &eacute;</h1><p><b>one<br><p>two\n  three</p></article>"), "T é\none\ntwo three"),
    (page("<article><p>a</p><div class='ad'>buy</div><p>b <span hidden>x</span>c</p><form>f</form></article>"), "a\nb c"),
    (page("<article><p>a</p><section id=comments><p>me too</p></section></article>"), "a"),
    (page("<main><header><h1>H</h1></header><ul><li>x<li>y</ul><aside>s</aside></main>", "<div class='cookie-notice'>c</div>"), "H\nx\ny"),
    (page("<p>body only</p><!-- c --><table><tr><td>1<td>2<tr><td>3</table>"), "body only\n1 2\n3"),
    (page("<article><p>cut in the midd"), "cut in the midd"),
])
def test_main_text_of_single_pages(html, want):
    assert text_of(html).removesuffix("foot").rstrip("\n") == want


def test_templates_are_found_per_host(spark):
    rows = []
    for host in ("a.example", "b.example"):
        for i in range(12):
            box = f"<div class='box'><p>Read our terms at {host}</p></div>"
            rows.append((len(rows), f"http://{host}/{i}", page(
                f"<article><p>The same opening line.</p><p>story {host} {i} with words of its own</p>{box}</article>")))
    rows.append((100, "http://c.example/1", page("<article><p>story alone here</p><div class='box'><p>Terms</p></div></article>")))
    rows += [(101, None, None), (102, "no url", ""), (101, None, None), (103, "http://a.example/x", "x" * 100_000)]
    frame = spark.createDataFrame([(i, u, h, "clash", "clash") for i, u, h in rows],
                                  "page_id long, url string, html string, host string, row string")
    got = {r["page_id"]: r for r in main_text(frame).collect()}
    for i, u, _ in rows[:24]:
        host = u.split("/")[2]
        assert got[i]["text"] == f"The same opening line.\nstory {host} {u.split('/')[3]} with words of its own"
    assert got[100]["text"] == "story alone here\nTerms"
    assert got[101]["text"] == got[102]["text"] == "" and got[101]["n_chars"] == 0 and got[103]["n_chars"] == 100_000
    assert main_text(frame).count() == len(rows)
    assert main_text(frame.limit(0)).count() == 0
