"""Secret scans: fixed forms, and sliding-window entropy over candidate strings.

Fixed forms are regular expressions with a least length.  Beyond them, runs of a character class are candidates, and
Shannon entropy is taken in every window of a candidate: counts of the class's characters are kept as the window moves
by one, and with them the sum of count * log2(count), so that a step costs two changes.  Windows at or over the class's
threshold are joined to spans.  A candidate that an allow-list pattern matches as a whole is left alone: words, paths
and dates of words, counters, and strings that say they are examples.

Everything is a column expression: a match's place is the length of all that stands before it, from the pieces between
matches.  Nothing is shuffled.

Edge cases: a null text is empty and has no spans; positions count code points, ends are exclusive; spans of one kind do
not overlap, spans of different kinds may; repeated rows give repeated results; ids are carried along as they are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: kind, pattern, group whose length counts, least length: fixed values.
FORMS = [
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
]


@dataclass(frozen=True)
class EntropyClass:
    kind: str
    pattern: str
    alphabet: str
    window: int
    bits: float


_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
CLASSES = [
    EntropyClass("entropy_hex", r"[0-9a-fA-F]{20,}", _DIGITS + "abcdefABCDEF", 20, 3.0),
    EntropyClass("entropy_base64", r"[A-Za-z0-9+/_=-]{24,}", _DIGITS + _LOWER + _LOWER.upper() + "+/_=-", 24, 4.0),
]
#: Candidates that are left alone.
ALLOWED = [
    r"[A-Za-z]+",
    r"[0-9_=+/-]+",
    r"(?:[A-Za-z]+[_/=+-]+)+[A-Za-z]*",
    r"(?:[A-Za-z]+[_/-]+)+[0-9]{1,8}",
    r".*(?i:example|sample|placeholder|xxxx|1234567890|abcdefghij).*",
]


def _found(text: Column, pattern: str, group: int, keep) -> Column:
    """(lo, hi, m) of the matches of ``pattern`` for whose ``group`` ``keep`` holds; empty without any.

    Arrays are put together outside of lambdas, so that each expression is run over a text once.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    pieces = F.split(text, pattern, -1)
    none = F.expr("cast(array() as array<struct<lo:int,hi:int,m:string>>)")

    def step(s: Column, x: Column) -> Column:
        lo = s["at"] + F.length(x["piece"])
        hi = lo + F.coalesce(F.length(x["m"]), F.lit(0))
        span = F.struct(lo.alias("lo"), hi.alias("hi"), x["m"].alias("m"))
        kept = F.when(x["m"].isNotNull() & keep(x["v"]), F.array_append(s["out"], span)).otherwise(s["out"])
        return F.struct(hi.alias("at"), kept.alias("out"))

    zipped = F.arrays_zip(pieces.alias("piece"), whole.alias("m"), value.alias("v"))
    found = F.aggregate(zipped, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda s: s["out"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def _spans(found: Column, kind: str, order: int) -> Column:
    return F.transform(
        found,
        lambda x: F.struct(x["lo"].alias("lo"), F.lit(order).alias("order"), x["hi"].alias("hi"), F.lit(kind).alias("kind")),
    )


def form_spans(text: Column, kind: str, pattern: str, group: int, least: int, order: int) -> Column:
    """Spans of a fixed form: leftmost matches that do not overlap, less those that are too short."""
    return _spans(_found(text, pattern, group, lambda v: F.length(v) >= least), kind, order)


def _weight(n: Column) -> Column:
    return F.when(n > 0, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def entropy_runs(word: Column, c: EntropyClass) -> Column:
    """(lo, hi) in ``word`` of joined windows whose entropy reaches the class's threshold."""
    w, size = c.window, len(c.alphabet)
    # Entropy is log2(w) - sum / w, so the threshold is a bound on the sum.
    most = w * (math.log2(w) - c.bits) + 1e-9
    chars = F.filter(F.split(word, ""), lambda x: x != "")
    moves = F.arrays_zip(
        F.transform(chars, lambda x: F.instr(F.lit(c.alphabet), x)).alias("new"),
        F.concat(F.array_repeat(F.lit(0), w), F.transform(chars, lambda x: F.instr(F.lit(c.alphabet), x))).alias("old"),
    )

    def step(s: Column, x: Column) -> Column:
        """Take in a character and let the one before the window go."""
        new, old, k = x["new"], x["old"], s["k"] + 1
        n_in = F.get(s["counts"], new - 1)
        n_out = F.get(s["counts"], old - 1) + F.when(old == new, 1).otherwise(0)
        total = s["total"] + _weight(n_in + 1) - _weight(n_in)
        total = total + F.when(old > 0, _weight(n_out - 1) - _weight(n_out)).otherwise(F.lit(0.0))
        counts = F.transform(
            s["counts"],
            lambda v, j: v + F.when(j == new - 1, 1).otherwise(0) - F.when(j == old - 1, 1).otherwise(0),
        )
        return F.struct(k.alias("k"), counts.alias("counts"), total.alias("total"), s["high"].alias("high"))

    def mark(s: Column) -> Column:
        return (s["k"] >= w) & (s["total"] <= most)

    def walk(s: Column, x: Column) -> Column:
        # The state before a step tells whether its window was high; the last state is looked at in the end.
        done = F.when(mark(s), F.array_append(s["high"], s["k"])).otherwise(s["high"])
        after = step(s, x)
        return F.struct(
            after["k"].alias("k"), after["counts"].alias("counts"), after["total"].alias("total"), done.alias("high")
        )

    begin = F.struct(
        F.lit(0).alias("k"),
        F.array_repeat(F.lit(0), size).alias("counts"),
        F.lit(0.0).alias("total"),
        F.expr("cast(array() as array<int>)").alias("high"),
    )
    highs = F.aggregate(
        F.filter(moves, lambda x: x["new"].isNotNull()),
        begin,
        walk,
        lambda s: F.when(mark(s), F.array_append(s["high"], s["k"])).otherwise(s["high"]),
    )

    def join(out: Column, k: Column) -> Column:
        last = F.element_at(out, -1)
        joins = (F.size(out) > 0) & (k - w <= last["hi"])
        longer = F.struct(last["lo"].alias("lo"), k.alias("hi"))
        return F.when(joins, F.array_append(F.slice(out, 1, F.size(out) - 1), longer)).otherwise(
            F.array_append(out, F.struct((k - w).alias("lo"), k.alias("hi")))
        )

    return F.aggregate(highs, F.expr("cast(array() as array<struct<lo:int,hi:int>>)"), join)


def entropy_spans(text: Column, c: EntropyClass, allowed: list[str], order: int) -> Column:
    pattern = r"\A(?:" + "|".join(f"(?:{a})" for a in allowed) + r")\z" if allowed else r"\A\b\B"
    placed = _found(text, c.pattern, 0, lambda v: ~v.rlike(pattern))
    runs = F.transform(
        placed,
        lambda x: F.transform(
            entropy_runs(x["m"], c),
            lambda r: F.struct((x["lo"] + r["lo"]).alias("lo"), (x["lo"] + r["hi"]).alias("hi")),
        ),
    )
    return _spans(F.flatten(runs), c.kind, order)


def written(spans: Column) -> Column:
    """kind:start:end, joined by commas, in the order of the array."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["lo"], x["hi"])), ",")


def scan(
    docs: DataFrame,
    text_col: str = "text",
    out_col: str = "secrets",
    classes: list[EntropyClass] | None = None,
    allowed: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``out_col``: array of (lo, order, hi, kind) by start, then kind; kinds below len(FORMS) are forms."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    parts = [form_spans(text, *form, order) for order, form in enumerate(FORMS)]
    for order, c in enumerate(CLASSES if classes is None else classes, len(FORMS)):
        parts.append(entropy_spans(text, c, ALLOWED if allowed is None else allowed, order))
    return docs.withColumn(out_col, F.array_sort(F.concat(*parts)))
