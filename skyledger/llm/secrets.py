"""Secret scans: fixed patterns, and a battery of randomness tests on other tokens. Built-in functions only.

Patterns (leftmost, not overlapping, per kind): assignments of a value of 12 or more characters to a word like
``password``, access keys of 18 or more characters, hexadecimal runs of 16 or more. They are always reported.

Battery: a candidate is a maximal run of 24 or more base64 characters (with up to two ``=``) that holds a digit and
touches no pattern match. Its encoding is inferred from the characters it has: hex, base32 or base64. Under the
hypothesis that all values of that encoding are equally likely and independent, three tests give p-values:

* chi-squared of the value counts against the uniform alphabet, as a z-score by its exact mean and variance at the
  candidate's length, since short tokens leave most values unseen;
* runs above and below the middle of the alphabet (Wald-Wolfowitz, given the number of each);
* serial correlation of neighbouring values.

Fisher's method combines them. A token of words fails, a random one passes. Which ones fail is decided per encoding
and length class by Benjamini-Hochberg at ``alpha`` over all candidates of the input, from counts in bins of
log p-values: the classes keep the many short tokens, of weak tests, from setting the level for long ones. What
does not fail is reported as ``random``.

Spans are (kind, start, end) in code points, end exclusive. Null texts are empty; an empty text has no spans. Rows
stand for themselves: repeated ids or texts give repeated results, columns other than text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the base scan, the kinds in their order, and the least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A run too short can't hold a longer match that starts later in it, so the least length is part of these two.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
LEAST_VALUE = 12
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{24,}={0,2}"
# What any match must hold; cheap to look for, so that most texts are read once and not matched at all.
GATES = {
    ASSIGN: r"""[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}""",
    ACCESS: "AKIA",
    HEX: HEX,
    CANDIDATE: r"[0-9](?:[A-Za-z0-9+/_-]{11}|(?<=[A-Za-z0-9+/_-]{13}))",
}
KINDS = ("assign", "access", "hex", "random")
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
SPAN = "array<struct<start:int,end:int,kind:int,text:string>>"
# Bins of -ln p per unit, and the last bin.
BINS, LAST_BIN = 8, 800


@dataclass(frozen=True)
class Battery:
    alpha: float = 0.05
    # Length classes: 24 to 39, 40 to 79, 80 to 159, 160 and more characters.
    lengths: tuple[int, ...] = (40, 80, 160)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value worked out once; inside of lambdas Spark shares no common parts by itself."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spans(text: Column, pattern: str, kind: int) -> Column:
    """All matches of a pattern as (start, end, kind, text): the gaps between them give their places."""
    none = F.expr(f"cast(array() as {SPAN})")

    def placed(found: Column) -> Column:
        gaps = F.slice(F.transform(F.split(text, pattern, -1), F.length), 1, F.size(found))
        both = F.zip_with(gaps, found, lambda gap, m: F.struct(gap.alias("gap"), m.alias("m")))

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["gap"]
            end = start + F.length(x["m"])
            span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x["m"].alias("text"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

        return F.aggregate(both, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    matched = let(found, lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(none))
    return F.when(F.regexp_like(text, F.lit(GATES[pattern])), matched).otherwise(none)


def base_spans(text: Column) -> Column:
    value = lambda s: F.regexp_extract(s["text"], ASSIGN, 2)
    assign = F.filter(spans(text, ASSIGN, 0), lambda s: F.length(value(s)) >= LEAST_VALUE)
    return F.concat(assign, spans(text, ACCESS, 1), spans(text, HEX, 2))


def _log_tail(z: Column) -> Column:
    """-ln P(Z > z) of the standard normal, by an approximation with an error below 1e-7; 92 at most."""

    def tail(x: Column) -> Column:
        def poly(t: Column) -> Column:
            # Coefficients of the approximation.
            return t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))

        return F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * let(1 / (1 + 0.2316419 * x), poly)

    return let(
        z,
        lambda v: -F.ln(F.greatest(F.when(v >= 0, tail(v)).otherwise(1 - tail(-v)), F.lit(1e-40))),
    )


def _encoding(token: Column) -> Column:
    has = lambda p: F.regexp_like(token, F.lit(p))
    return (
        F.when(has("^([0-9a-f]+|[0-9A-F]+)$") & has("[a-fA-F]"), "hex")
        .when(has("^[A-Z2-7]+=*$") & has("[A-Z]"), "base32")
        .when(has("[A-Z]") & has("[a-z]") & has("[0-9]"), "base64")
    )


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda acc, v: acc + v)


def _neighbours(xs: Column, f: Callable[[Column, Column], Column]) -> Column:
    return _total(F.zip_with(F.slice(xs, 1, F.size(xs) - 1), F.slice(xs, 2, F.size(xs) - 1), f))


def _chi_squared(plain: Column, letters: Column, n: Column, size: int) -> Column:
    """z-score of sum over values of (count - n / size)^2 / (n / size)."""
    count = lambda c: F.length(F.replace(plain, c, F.lit("")))
    squares = _total(F.transform(F.array_distinct(letters), lambda c: F.pow(n - count(c), 2)))
    return (squares * size / n - n - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)


def _runs(values: Column, n: Column, size: int) -> Column:
    """z-score of the number of runs of values in the upper and the lower half; 8 if one half is empty."""

    def score(high: Column) -> Column:
        def by_mean(mean: Column) -> Column:
            spread = F.sqrt((mean - 1) * (mean - 2) / (n - 1))
            return F.when(spread > 0, (1 + _neighbours(high, lambda a, b: F.abs(a - b)) - mean) / spread).otherwise(8.0)

        return let(let(_total(high), lambda ones: 1 + 2 * ones * (n - ones) / n), by_mean)

    return let(F.transform(values, lambda v: (v >= size / 2).cast("double")), score)


def _serial(values: Column, n: Column, size: int) -> Column:
    """z-score of the products of neighbouring values around the alphabet's middle."""
    middle, variance = (size - 1) / 2, (size * size - 1) / 12
    return _neighbours(values, lambda a, b: (a - middle) * (b - middle)) / (variance * F.sqrt(n - 1))


def _battery(plain: Column, alphabet: str) -> Column:
    """-ln of the combined p-value that the values are uniform and independent."""
    size = len(alphabet)

    def tests(letters: Column) -> Column:
        n = F.size(letters).cast("double")
        values = F.transform(letters, lambda c: F.instr(F.lit(alphabet), c).cast("double") - 1)
        two_sided = lambda z: _log_tail(F.abs(z)) - math.log(2)
        half = let(
            values, lambda v: two_sided(_runs(v, n, size)) + two_sided(_serial(v, n, size))
        ) + _log_tail(_chi_squared(plain, letters, n, size))
        # Fisher: twice the sum is chi-squared with six degrees of freedom, whose tail has a closed form.
        return let(F.greatest(half, F.lit(0.0)), lambda h: h - F.ln(1 + h + h * h / 2))

    return let(F.filter(F.split(plain, ""), lambda c: c != ""), tests)


def _log_p(token: Column, encoding: Column) -> Column:
    bare = F.translate(F.regexp_replace(token, "=+$", ""), "-_", "+/")
    return (
        F.when(encoding == "hex", let(F.lower(bare), lambda t: _battery(t, ALPHABETS["hex"])))
        .when(encoding == "base32", let(bare, lambda t: _battery(t, ALPHABETS["base32"])))
        .when(encoding == "base64", let(bare, lambda t: _battery(t, ALPHABETS["base64"])))
    )


def candidates(text: Column, base: Column, battery: Battery) -> Column:
    """Tokens for the battery that touch no base span: (start, end, encoding, length_class, log_p)."""
    tokens = F.filter(
        spans(text, CANDIDATE, 3),
        lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])),
    )
    length_class = lambda c: sum(
        (F.when(c["end"] - c["start"] >= edge, 1).otherwise(0) for edge in battery.lengths), F.lit(0)
    )
    judge = lambda c, encoding: F.struct(
        c["start"].alias("start"),
        c["end"].alias("end"),
        encoding.alias("encoding"),
        length_class(c).alias("length_class"),
        _log_p(c["text"], encoding).alias("log_p"),
    )
    judged = F.transform(tokens, lambda c: let(_encoding(c["text"]), lambda encoding: judge(c, encoding)))
    return F.filter(judged, lambda c: c["log_p"].isNotNull())


def failing_levels(docs: DataFrame, battery: Battery) -> dict[tuple[str, int], float]:
    """-ln p from which a candidate of an encoding and length class is not random, by Benjamini-Hochberg.

    There are at most 3 encodings x 4 classes x 801 bins to look at, whatever the input.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.where(F.regexp_like("text", F.lit(GATES[CANDIDATE]))).select(
        F.explode(let(base_spans(text), lambda base: candidates(text, base, battery))).alias("c")
    )
    bin_of = F.least(F.floor(F.col("c.log_p") * BINS), F.lit(LAST_BIN)).cast("int")
    counts = found.groupBy("c.encoding", "c.length_class", bin_of.alias("bin")).agg(F.count("*").alias("n")).collect()
    levels = {}
    for group in {(r.encoding, r.length_class) for r in counts}:
        bins = sorted(((r.bin, r.n) for r in counts if (r.encoding, r.length_class) == group), reverse=True)
        total, seen, level = sum(n for _, n in bins), 0, math.inf
        for bin_, n in bins:
            seen += n
            # The whole bin fails if its largest p-value is within alpha * rank / total.
            if bin_ / BINS >= -math.log(battery.alpha * seen / total):
                level = bin_ / BINS
        levels[group] = level
    return levels


def scanned(docs: DataFrame, battery: Battery = Battery()) -> DataFrame:
    """The documents, with all columns, and ``secret_spans``: (start, kind as index of KINDS, end), in order."""
    levels = failing_levels(docs, battery)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def passes(c: Column) -> Column:
        level = F.lit(math.inf)
        for (encoding, length_class), value in levels.items():
            level = F.when((c["encoding"] == encoding) & (c["length_class"] == length_class), value).otherwise(level)
        return c["log_p"] < level

    def ordered(base: Column) -> Column:
        place = lambda s, kind: F.struct(
            s["start"].alias("start"), kind.alias("kind"), s["end"].alias("end")
        )
        more = F.filter(candidates(text, base, battery), passes)
        return F.array_sort(
            F.concat(
                F.transform(base, lambda s: place(s, s["kind"])), F.transform(more, lambda s: place(s, F.lit(3)))
            )
        )

    return docs.withColumn("secret_spans", let(base_spans(text), ordered))


def as_text(spans_: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans_, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def masked(docs: DataFrame, battery: Battery = Battery(), mark: str = "[secret]") -> DataFrame:
    """The documents, with all columns, with each span replaced by a mark; overlapping spans by one.

    n_chars, if there, is counted anew for changed texts. Texts without a span are kept as they are, null too. A column
    named secret_spans is kept like any other.
    """
    own = "_llm_secret_spans"
    found = scanned(docs.withColumnRenamed("secret_spans", own), battery)
    pieces = F.aggregate(
        F.col("secret_spans"),
        F.expr("named_struct('at', 0, 'out', '')"),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["out"])
            .otherwise(F.concat(acc["out"], F.col("text").substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
            .alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.col("text").substr(acc["at"] + 1, F.length("text"))),
    )
    changed = F.size("secret_spans") > 0
    out = found.withColumn("text", F.when(changed, pieces).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return out.drop("secret_spans").withColumnRenamed(own, "secret_spans").select(*[F.col(f"`{c}`") for c in docs.columns])
