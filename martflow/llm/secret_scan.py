"""Secret scan: fixed patterns, and a battery of randomness tests.

The base spans are the fixed patterns' matches.  The battery looks at every
run of at least 16 characters of ``A-Za-z0-9+/_=-``; one that base spans cover in
part is judged by what they leave of it (16 characters at least), and reported whole.  Its encoding is
inferred from the characters it uses, and three tests ask whether it may be a
uniform random string of that encoding: chi-squared uniformity over the alphabet,
the runs test around the middle of the alphabet, and the serial correlation of
neighbours.  Fisher's method combines them; what they reject is no secret.

What they leave may still be a long word, so what is reported is controlled for
false discoveries: the chi-squared statistic of text is non-central (letters of
natural languages coincide at least ``COINCIDENCE`` times as often as random
ones), which gives each run the probability that text would look as uniform.
In each class of lengths (powers of two) Benjamini-Hochberg over these
probabilities bounds the share of text among the reported runs by ``FDR``.  Runs of
less than ``LEAST_BITS`` bits, and of digits alone (numbers of cards, phones,
accounts), are no secrets here.

Null texts count as empty: no span, the digest of the empty string.  Whole
texts are scanned; repeated rows give equal rows; an empty table gives an empty
result; other columns are ignored.  Only SQL functions run on the rows.  Positions
are summed up in blocks, so the work grows little faster than a text.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, read

# The patterns of the contract, with the least length of the
# group given (0: the whole match).
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = "[A-Za-z0-9+/_=\ue000-]{16,}"
LEAST_LENGTH = 16
#: A random string needs this many bits to count as a secret.
LEAST_BITS = 80.0
FDR = 0.05
#: A run that random strings look like more seldom than this is not random.
NOT_RANDOM = 1e-3
#: Resolution of the ranking of p-values, in powers of ten.
BIN = 0.01
#: How much more often than at random two letters of a text are equal, at least.
COINCIDENCE = 1.7

# The encodings, the most specific first, with their alphabets and
# the share of the alphabet that text in them uses.
ENCODINGS = (
    ("decimal", r"^[0-9]+$", "0123456789", 1.0),
    ("hex", r"^[0-9a-f]+$", "0123456789abcdef", 10 / 16 * COINCIDENCE),
    ("HEX", r"^[0-9A-F]+$", "0123456789ABCDEF", 10 / 16 * COINCIDENCE),
    ("lower", r"^[a-z]+$", "abcdefghijklmnopqrstuvwxyz", 1.0),
    ("UPPER", r"^[A-Z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1.0),
    ("base32", r"^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 26 / 32),
    ("BASE36", r"^[A-Z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", 26 / 36),
    ("base36", r"^[a-z0-9]+$", "0123456789abcdefghijklmnopqrstuvwxyz", 26 / 36),
    ("letters", r"^[A-Za-z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 26 / 52),
    ("base62", r"^[A-Za-z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 26 / 62),
    ("base64", r"^.*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 26 / 64),
)
#: Elements of a block of `running`.
STEP = 256


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an int array under ``join`` (a sum, a maximum), in blocks:
    an array grows one element at a time only within a block and over the blocks."""
    def grow(items: Column) -> Column:
        return F.aggregate(items, F.array().cast("array<int>"), lambda acc, v: F.concat(acc, F.array(
            F.when(F.size(acc) > 0, join(F.element_at(acc, -1), v)).otherwise(v))))

    def whole(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / STEP).cast("int")),
                             lambda b: grow(F.slice(v, b * STEP + 1, F.lit(STEP))))

        def joined(inner: Column) -> Column:
            ends = grow(F.transform(inner, lambda x: F.element_at(x, -1)))
            return F.flatten(F.transform(inner, lambda x, i: F.when(i == 0, x).otherwise(
                F.transform(x, lambda y: join(F.get(ends, i - 1), y)))))
        return _let(blocks, joined)

    return F.when(F.size(values) == 0, F.array().cast("array<int>")).otherwise(_let(values, whole))


def _spans(text: Column, pattern: str, kind: int, group: int, least: int, needed: str) -> Column:
    """Array of ``(start, kind, end, value)``: leftmost matches that do not
    overlap, those dropped whose group is shorter than ``least``.  The pieces
    between matches give the positions."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(found: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(found)), F.length)
        reach = running(F.zip_with(gaps, found, lambda g, m: g + F.length(m)), lambda a, b: a + b)
        value = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        rows = F.arrays_zip(found.alias("match"), reach.alias("end"), value.alias("value"))
        spans = F.transform(rows, lambda r: F.struct((r["end"] - F.length(r["match"])).alias("start"), F.lit(kind).alias("kind"),
                                                     r["end"].alias("end"), r["value"].alias("value")))
        return F.filter(spans, lambda s: F.length(s["value"]) >= least)

    return F.when(text.rlike(needed), _let(whole, placed)).otherwise(F.array().cast(SPANS))


SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def base_spans(text: Column) -> list[Column]:
    """The fixed patterns' spans, a list for each kind."""
    return [_spans(text, ASSIGN, 0, 2, 6, r"(?i:password|passwd|secret|token|api_?key)"),
            _spans(text, r"AKIA[A-Z0-9]{16,}", 1, 0, 20, r"AKIA[A-Z0-9]{16}"),
            # a run is maximal, so asking for 24 characters finds the same runs
            _spans(text, r"[0-9a-f]{24,}", 2, 0, 24, r"[0-9a-f]{24}")]


#: Characters of a text that are replaced in one go.
STRETCH = 16_384


def replaced(text: Column, spans: Column, mark: str = "", fill: str = "") -> Column:
    """The text with its sorted spans replaced: by a ``mark``, overlapping ones by
    one, or character by character by a ``fill``.  It is cut into stretches, each
    put together from the pieces between its spans."""
    def pieces(told: Column) -> Column:
        def stretch(i: Column) -> Column:
            low, high = i * STRETCH, (i + 1) * STRETCH
            own = F.filter(told, lambda s: (s["start"] < high) & (s["reach"] > low))

            def put(mine: Column) -> Column:
                part = F.substring(text, low + 1, F.lit(STRETCH))
                begins = F.concat(F.array(low), F.transform(mine, lambda s: F.greatest(s["reach"], low)))
                ends = F.concat(F.transform(mine, lambda s: s["start"]), F.array(high))
                if fill:
                    marks = F.zip_with(mine, F.slice(begins, 1, F.size(mine)), lambda s, b: F.repeat(F.lit(fill), F.greatest(
                        F.least(s["reach"], high) - F.greatest(s["start"], b), F.lit(0))))
                else:
                    marks = F.transform(mine, lambda s: F.when((s["start"] >= low) & s["opens"], F.lit(mark))
                                        .otherwise(F.lit("")))
                kept = _let(part, lambda p: F.zip_with(begins, ends, lambda b, e: F.substring(
                    p, b - low + 1, F.greatest(e - b, F.lit(0)))))
                return F.array_join(F.flatten(F.zip_with(kept, F.concat(marks, F.array(F.lit(""))),
                                                         lambda k, m: F.array(k, m))), "")
            return _let(own, put)
        count = F.floor((F.length(text) - 1) / STRETCH).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), count), stretch), "")

    def reaching(found: Column) -> Column:
        reach = running(F.transform(found, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
        told = _let(reach, lambda r: F.transform(found, lambda s, i: F.struct(
            s["start"].alias("start"), F.get(r, i).alias("reach"),
            ((i == 0) | (s["start"] >= F.get(r, i - 1))).alias("opens"))))
        return _let(told, pieces)

    return F.when(F.size(spans) > 0, _let(spans, reaching)).otherwise(text)


def two_sided(z: Column) -> Column:
    """Two-sided normal p-value (rational approximation of erfc, 1e-7)."""
    x = F.least(F.abs(z), F.lit(36.0)) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    # fixed values: the approximation's coefficients
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.greatest(F.least(poly * F.exp(-x * x), F.lit(1.0)), F.lit(1e-30))


def normal(z: Column) -> Column:
    """Lower tail of the normal distribution."""
    return F.when(z > 0, 1 - two_sided(z) / 2).otherwise(two_sided(z) / 2)


def _inferred(span: Column) -> Column:
    """A candidate with its characters in the inferred encoding's alphabet."""
    body = F.translate(F.regexp_replace(span["value"], "=+$", ""), "-_=", "+/+")
    first = len(ENCODINGS) - 1
    code, alphabet, share = F.lit(first), F.lit(ENCODINGS[first][2]), F.lit(ENCODINGS[first][3])
    for i in range(first - 1, -1, -1):
        fits = body.rlike(ENCODINGS[i][1])
        code = F.when(fits, i).otherwise(code)
        alphabet = F.when(fits, ENCODINGS[i][2]).otherwise(alphabet)
        share = F.when(fits, ENCODINGS[i][3]).otherwise(share)
    return F.struct(span["start"].alias("start"), span["end"].alias("end"), body.alias("body"), code.alias("code"),
                    alphabet.alias("alphabet"), F.length(alphabet).cast("double").alias("k"),
                    (COINCIDENCE / share - 1).alias("excess"), F.length(body).cast("double").alias("n"))


def _tests(c: Column) -> Column:
    """The combined p-value of a candidate under randomness, and the probability
    that text looks as uniform."""
    body, k, n = c["body"], c["k"], c["n"]
    letters = F.split(c["alphabet"], "(?!^)")

    def without(part: Column) -> Column:
        return n - F.length(F.replace(body, part, F.lit("")))

    chi = F.aggregate(letters, F.lit(0.0), lambda a, ch: a + without(ch) * without(ch)) * k / n - n
    free = k - 1
    # Wilson-Hilferty: the cube root of chi-squared is close to normal
    z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
    half = F.floor((k + 1) / 2).cast("int")
    sides = F.call_function("translate", body, c["alphabet"], F.concat(
        F.repeat(F.lit("L"), half), F.repeat(F.lit("H"), (k - half).cast("int"))))

    def battery(side: Column) -> Column:
        n1 = n - F.length(F.replace(side, F.lit("H"), F.lit("")))
        n2 = n - n1
        turns = sum((n - F.length(F.replace(side, F.lit(t), F.lit("")))) / 2 for t in ("HL", "LH"))
        mean = 2 * n1 * n2 / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        z_runs = F.when(var > 0, (turns + 1 - mean) / F.sqrt(var)).otherwise(F.lit(6.0))
        centre = F.transform(F.split(body, "(?!^)"), lambda ch: F.instr(c["alphabet"], ch) - 1 - (k - 1) / 2)

        def correlation(x: Column) -> Column:
            power = F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v)
            lag = F.aggregate(F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1),
                                         lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
            return F.when(power > 0, lag / power * F.sqrt(n)).otherwise(F.lit(6.0))

        def decided(t: Column) -> Column:
            tail = -(F.log(two_sided(t["chi"])) + F.log(two_sided(t["runs"])) + F.log(two_sided(t["lag"])))
            # Fisher: chi-squared with 6 degrees has a closed form
            p = F.exp(-tail) * (1 + tail + tail * tail / 2)
            # of text the statistic is non-central
            text = normal((t["x2"] - free - n * c["excess"]) / F.sqrt(2 * (free + 2 * n * c["excess"])))
            return F.struct(c["start"].alias("start"), c["end"].alias("end"), F.floor(F.log2(n)).cast("int").alias("class"),
                            (p >= NOT_RANDOM).alias("random"),
                            F.floor(-F.log10(F.greatest(text, F.lit(1e-60))) / BIN).cast("int").alias("bin"))
        return _let(F.struct(z_chi.alias("chi"), z_runs.alias("runs"), _let(centre, correlation).alias("lag"),
                             chi.alias("x2")), decided)
    return _let(sides, battery)


#: Stands for a character of a base span while runs are looked for.
COVERED = "\ue000"


def candidates(text: Column, base: Column) -> Column:
    """The tests of every run; base spans count as part of a run, not of its value."""
    def tested(covered: Column) -> Column:
        runs = _spans(covered, CANDIDATE, 3, 0, LEAST_LENGTH, CANDIDATE)
        left = F.transform(runs, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), F.replace(
            r["value"], F.lit(COVERED), F.lit("")).alias("value")))
        told = F.filter(F.transform(F.filter(left, lambda r: F.length(r["value"]) >= LEAST_LENGTH), _inferred),
                        lambda c: (c["code"] > 0) & (c["n"] >= LEAST_LENGTH) & (c["n"] * F.log2(c["k"]) >= LEAST_BITS))
        return F.transform(told, _tests)
    return _let(replaced(text, base, fill=COVERED), tested)


def thresholds(found: DataFrame) -> dict[int, int]:
    """Benjamini-Hochberg per class of lengths: the least bin of probabilities
    that is reported.  Bins are counted in Spark; a class has at most 6,000 bins."""
    bins = (found.select(F.explode("tests").alias("t")).groupBy("t.class", "t.bin").count().collect())
    by_class: dict[int, dict[int, int]] = {}
    for r in bins:
        by_class.setdefault(r["class"], {})[r["bin"]] = r["count"]
    out = {}
    for cls, counts in by_class.items():
        total, upto, limit = sum(counts.values()), 0, None
        for b in sorted(counts, reverse=True):          # from the smallest probability
            upto += counts[b]
            if 10 ** (-b * BIN) <= FDR * upto / total:
                limit = b
        if limit is not None:
            out[cls] = limit
    return out


def _random(t: Column, limits: dict[int, int]) -> Column:
    """Whether a candidate is reported."""
    reported = F.lit(False)
    for cls, b in limits.items():
        reported = reported | ((t["class"] == cls) & (t["bin"] >= b))
    return reported & t["random"]


def _bare(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))


def _all_spans(base: Column, tests: Column, limits: dict[int, int]) -> Column:
    added = F.transform(F.filter(tests, lambda t: _random(t, limits)), lambda t: F.struct(
        t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")))
    return F.array_sort(F.concat(_bare(base), added))


def _scanned(docs: DataFrame) -> DataFrame:
    """``doc_id, text, base, tests`` of each row, from its text alone."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (docs.select("doc_id", text.alias("text")).withColumn("base", F.array_sort(F.concat(*base_spans(F.col("text")))))
            .withColumn("tests", candidates(F.col("text"), F.col("base"))))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, spans array<struct<start, kind, end>>`` with kinds as numbers
    into ``KINDS``, by start and kind."""
    found = keep(_scanned(docs).select("doc_id", _bare(F.col("base")).alias("base"), "tests"), "scanned")
    return found.select("doc_id", _all_spans(F.col("base"), F.col("tests"), thresholds(found)).alias("spans"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by ``[SECRET]``, overlapping ones by
    one mark.  Each text is scanned once: the rows are kept with their spans and
    tests until the limits of the battery are known."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row")).withColumn("base", F.array_sort(F.concat(*base_spans(text))))
    rows = rows.select("row", _bare(F.col("base")).alias("base"), candidates(text, F.col("base")).alias("tests"))
    found = keep(rows, "secrets")
    spans = _all_spans(F.col("base"), F.col("tests"), thresholds(found.select("tests").where("size(tests) > 0")))
    new = replaced(F.col("row.text"), F.col("spans"), mark="[SECRET]")
    return found.select("row", spans.alias("spans")).select(
        *[new.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
