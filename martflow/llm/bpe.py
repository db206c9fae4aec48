"""BPE encoding and decoding by a prefix-sharing traversal of the words' trie.

A sequence of tokens is the BPE encoding of its string exactly when each
adjacent pair is the encoding of that pair's string.  So the encoding of a
prefix is known from its last token alone: the token before it is the last
token of the shorter prefix.  The distinct words of a piece of text are
visited in sorted order, which is the depth-first traversal of their trie; the
last-token states of the current path stay on a stack, so a shared prefix is
encoded once.  A word's tokens are read backwards along its path.

Texts are split as the tokenizer file says: special strings first, then
normalising, then words, whose last symbol carries the word-end mark.  Null
texts count as empty and have no token; very long texts are encoded whole;
repeated rows give equal rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Iterator
from os.path import commonprefix
from types import ModuleType

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import give_back, read, sliced

#: Characters of text whose distinct words are encoded together, and parts of
#: texts and words a worker remembers before it forgets some; both bound its
#: memory, neither changes a result.
CHUNK_CHARS = 4_000_000
MAX_WORDS = 150_000
#: Pairs of tokens a worker remembers.
MAX_PAIRS = 150_000
#: Without such characters, normalising is lower-casing: no character composes
#: with another, and all libraries agree on letters and white space.
OTHER = re.compile("[^\x00-\x1b\x20-ɏ]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE:
    itself for visible Latin-1, the next free one from U+0100 for the rest."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(spare)) for b in range(256)]


class WordBpe:
    """Encoder for the word-end BPE files of the public tokenizers."""

    def __init__(self, spec: str):
        self.spec = spec
        data = json.loads(spec)
        model = data["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.text = {i: t for t, i in (self.vocab | self.special).items()}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.symbols = byte_symbols()
        self.bytes = {s: b for b, s in enumerate(self.symbols)}
        ids = [(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in merges]
        self.join_rank = {a << 16 | b: i for i, (a, b, _) in enumerate(ids)}
        self.made = {t: (i, a, b) for i, (a, b, t) in enumerate(ids)}
        self.endings = self._endings()
        self.as_symbols = {i: c for i, c in enumerate(self.symbols)}
        pattern = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern).findall
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.pairs: dict[int, bool] = {}
        self.digits = {i: str(i) for i in self.text}
        #: parts of texts to the bytes of their ids; special strings with a space before
        #: them, as their characters may also be a part of a text
        self.known: dict[str, bytes] = {}
        #: those met again since something was forgotten
        self.again: set[str] = set()
        self._forget(set())
        self._library = None

    def _forget(self, parts: set[str]) -> None:
        """Remember only these parts, those met again if they are not many, and
        the special strings."""
        kept = parts & self.known.keys()
        if len(self.again) <= MAX_WORDS // 2:
            kept |= self.again
        self.known = {p: self.known[p] for p in kept}
        self.known |= {f" {s}": array("i", [i]).tobytes() for s, i in self.special.items()}
        self.again = set()

    def _endings(self) -> dict[str, tuple[tuple[int, int], ...]]:
        """Every ending of a token, with the tokens that end it and the length
        of each without the mark, the longest first."""
        out: dict[str, tuple[tuple[int, int], ...]] = {}
        ends = {t[i:] for t in self.vocab for i in range(len(t.removesuffix(self.end)))}
        for e in sorted(ends, key=len):
            shorter = out.get(e[1:], ())
            out[e] = ((self.vocab[e], len(e.removesuffix(self.end))), *shorter) if e in self.vocab else shorter
        return out

    def split(self, text: str) -> list[str]:
        """The parts of a text between white space, as no word crosses it;
        special strings follow a space."""
        if "<|" not in text:
            return self._plain_parts(text)
        out = []
        for part in self.specials.split(text):
            out += [f" {part}"] if part in self.special else self._plain_parts(part)
        return out

    def _plain_parts(self, text: str) -> list[str]:
        lower = text.lower()
        if not OTHER.search(text) and not OTHER.search(lower):
            return lower.split()
        if self._library is None:   # other scripts: the library's own Unicode tables
            from tokenizers import Tokenizer
            self._library = Tokenizer.from_str(self.spec)
        normal = self._library.normalizer.normalize_str(text)
        return [bytes(self.bytes[c] for c in word).decode("utf-8")
                for word, _ in self._library.pre_tokenizer.pre_tokenize_str(normal)]

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain BPE: merge the pair of lowest rank until none is left."""
        symbols, none = list(symbols), len(self.join_rank)
        while len(symbols) > 1:
            ids = [self.vocab[s] for s in symbols]
            ranks = [self.join_rank.get(a << 16 | b, none) for a, b in zip(ids, ids[1:])]
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            symbols[i:i + 2] = ["".join(symbols[i:i + 2])]
        return symbols

    def _symbols(self, token: str) -> list[str]:
        body = token.removesuffix(self.end)
        return [*body[:-1], body[-1] + token[len(body):]]

    def fits(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left`` (-1: may stand first)."""
        if left < 0:
            return len(self.merged(self._symbols(self.text[right]))) == 1
        return self._stays_apart(left, right)

    def _stays_apart(self, left: int, right: int) -> bool:
        """Undo the merges next to the boundary, the latest first.  The tokens
        join if at some moment the pair at the boundary could merge before the
        merge that used up one of its parts; of equal ranks the left one is
        first."""
        before = len(self.join_rank)
        while True:
            if self.join_rank.get(left << 16 | right, before) < before:
                return False
            made_left, made_right = self.made.get(left), self.made.get(right)
            if made_left and (not made_right or made_left[0] > made_right[0]):
                before, _, left = made_left
            elif made_right:
                before, right = made_right[0] + 1, made_right[1]
            else:
                return True

    def learn(self, words: set[str]) -> None:
        """Encode the words that are not known yet, in trie order.  The state of
        a prefix is its last token and where that token starts; the empty
        prefix has the token -1."""
        as_symbols, last, known = self.as_symbols, self._last, self.known
        if len(self.pairs) > MAX_PAIRS:
            self.pairs.clear()
        coded = {w if w.isascii() and w.isprintable()       # these stand for themselves
                 else w.encode("utf-8").decode("latin-1").translate(as_symbols): w for w in words}
        tokens, starts, before = [-1], [0], ""
        for word in sorted(coded):
            before = before[:64] if before[:64] != word[:64] else commonprefix([before, word])
            while not word.startswith(before):
                before = before[:-1]
            n, shared = len(word), len(before)
            del tokens[shared + 1:], starts[shared + 1:]
            for i in range(shared + 1, n):
                last(word, i, "", tokens, starts)
            last(word, n, self.end, tokens, starts)
            # the next word may go on from here; its state without the mark is not known yet
            token, start, before = tokens.pop(), starts.pop(), word[:n - 1]
            out = [token]
            while start:
                out.append(tokens[start])
                start = starts[start]
            out.reverse()
            known[coded[word]] = array("i", out).tobytes()

    def _last(self, word: str, end: int, mark: str, tokens: list[int], starts: list[int]) -> None:
        """Add the last token of ``word[:end]`` with ``mark`` behind it, and where
        that token starts: the longest that fits what stands before it.  An
        ending's endings are endings too, so the longest one is looked for from
        where the token before starts."""
        endings, pairs = self.endings, self.pairs
        start = starts[-1]
        found = endings.get(word[start:end] + mark)
        if found is None:
            while found is None and start < end:
                start += 1
                found = endings.get(word[start:end] + mark)
        else:
            while start:
                longer = endings.get(word[start - 1:end] + mark)
                if longer is None:
                    break
                found = longer
                start -= 1
        for token, size in found or ():
            left = tokens[end - size]
            pair = left << 16 | token
            fit = pairs.get(pair)
            if fit is None:
                fit = pairs[pair] = self.fits(left, token)
            if fit:
                tokens.append(token)
                starts.append(end - size)
                return
        raise ValueError(f"no encoding for {word[:end]!r}")

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text."""
        split = [self.split(t) for t in texts]
        parts = set().union(*split)
        new = parts - self.known.keys()
        if len(self.known) + len(new) > MAX_WORDS:
            self._forget(parts)
        else:
            self.again |= parts.difference(new)
        # what the library has split is a word; so is a run of letters
        several = {p: self.words(p) for p in new if not p.isalpha() and not OTHER.search(p)}
        self.learn(new.difference(several).union(*several.values()) - self.known.keys())
        ids = self.known.__getitem__
        self.known |= [(p, b"".join(map(ids, words))) for p, words in several.items()]
        for found in split:
            yield array("i", b"".join(map(ids, found))).tolist()

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.text.__getitem__, ids))

    def numerals(self, ids: list[int]) -> str:
        return " ".join(map(self.digits.__getitem__, ids))


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= CHUNK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


# What can be returned of a document's encoding.
OUTPUTS = {
    "ids": ("array<int>", pa.list_(pa.int32()), lambda bpe, ids: np.array(ids, np.int32)),
    "decoded": ("string", pa.string(), lambda bpe, ids: bpe.decode(ids)),
    "ids_sha256": ("string", pa.string(), lambda bpe, ids: _sha(bpe.numerals(ids))),
    "decoded_sha256": ("string", pa.string(), lambda bpe, ids: _sha(bpe.decode(ids))),
}


def _worker_bpe(spec: str) -> WordBpe:
    """One encoder for the life of a Python worker: a later task knows the words
    of the earlier ones.  It is kept beside the modules, as this function
    itself travels with each task."""
    held = sys.modules.setdefault("_martflow_word_bpe", ModuleType("_martflow_word_bpe"))
    if getattr(held, "spec", None) != spec:
        held.spec, held.bpe = spec, WordBpe(spec)
        give_back()     # what reading the file took
    return held.bpe


#: Rows whose texts are taken out of a batch at a time.
ROWS = 256


def _encoder(spec, wanted: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()     # what earlier stages left in this worker
        bpe = _worker_bpe(spec.value)
        for batch in sliced(batches, ROWS):
            start = 0
            for chunk in _chunks([t or "" for t in batch.column(1).to_pylist()]):
                counts, out = [], {w: [] for w in wanted}
                for ids in bpe.encode(chunk):
                    counts.append(len(ids))
                    for w in wanted:
                        out[w].append(OUTPUTS[w][2](bpe, ids))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(chunk)).cast(pa.int64()), pa.array(counts, pa.int64())]
                    + [pa.array(out[w], OUTPUTS[w][1]) for w in wanted], names=["doc_id", "n_tokens", *wanted])
                start += len(chunk)
    return run


def encode(docs: DataFrame, path: str, *wanted: str) -> DataFrame:
    """``doc_id, n_tokens`` and the ``wanted`` columns (any of ``OUTPUTS``; all
    if none is named) for ``docs (doc_id, text)``.  ``path`` names the
    tokenizer's file on the driver."""
    wanted = wanted or tuple(OUTPUTS)
    with open(path, encoding="utf-8") as fh:     # a vocabulary file, of fixed size
        spec = docs.sparkSession.sparkContext.broadcast(fh.read())
    columns = ", ".join(f"{w} {OUTPUTS[w][0]}" for w in wanted)
    return docs.select("doc_id", "text").mapInArrow(
        _encoder(spec, wanted), f"doc_id long, n_tokens long, {columns}")


def word_bpe_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read(spark, sf_dir, "documents"), word_bpe_path(), "ids_sha256", "decoded_sha256")
