"""Small fixtures and brute-force versions for the training-data operators."""

from __future__ import annotations

import hashlib
import random
import re

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(rng: random.Random, n: int, size: int = 400) -> str:
    return " ".join(f"w{rng.randrange(size)}{'abcde'[rng.randrange(5)]}" for _ in range(n))


def docs_frame(spark, rows, extra: bool = False):
    """``documents`` from (doc_id, text[, source]); ``extra`` adds columns whose
    names clash with those the operators use inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOC)
    if extra:
        from pyspark.sql import functions as F
        for name in ("key", "rank", "size", "score", "doc", "n", "sig", "pair", "_id", "rep", "spans", "weight"):
            df = df.withColumn(name, F.lit("clash"))
    return df


ODD_TEXTS = [(1, None, None), (2, "", "a"), (3, "   \n\t ", "a"), (4, "one", None), (5, "x" * 30_000, "b"),
             (6, "a b c d e f g " * 2000, "b"), (7, "tie tie tie", "c"), (8, "tie tie tie", "c"),
             (9, "Ünïcode ÄÖÜ ſecret  \U0001F600", "c")]


def shingles(text, k=5):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def groups(items, linked):
    """Component (smallest id) of each item under ``linked(a, b)``."""
    parent = {i: i for i in items}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(items)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if linked(items[a], items[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def jaccard_links(a, b):
    return bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)


def without_repeats(docs, match):
    """doc_id -> (bytes, removed, spans, digest) by looking at every window."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - match + 1):
            w = raw[i:i + match]
            if w in seen:
                gone[i:i + match] = [True] * match
            seen.add(w)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[doc_id] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out
