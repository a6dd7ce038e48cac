"""Secrets in texts: three base patterns, and runs of high Shannon entropy.

Everything is a Spark expression. Matches and the gaps between them, both from
the same pattern, give the positions. A candidate run of key characters is
judged by its class (hexadecimal, letters and digits, base 64): a window of
``WINDOW`` characters slides over it, one count goes up and one down at each
step, and the sum of c * log2(c) follows from these two counts alone. A run is
reported whole where a window without any allowed text reaches the threshold of
its class (``held``); ``_random`` is the narrower rule that dismisses runs with
allowed text anywhere, and runs without a digit or without a letter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, in the order that equal starts are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
RUN = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "0123456789abcdefABCDEFghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/_-="
#: Class, what its runs consist of, bits per character that a window must reach.
CLASSES = (("hexadecimal", r"^[0-9A-Fa-f]+$", 3.0), ("alphanumeric", r"^[0-9A-Za-z]+$", 3.6), ("base64", "", 3.7))
#: The same for ``held``, narrowest first: words make runs of one case, paths and names runs without digits.
PART_CLASSES = (
    ("digits", r"^[0-9]+$", 3.2), ("hexadecimal", r"^[0-9A-Fa-f]+$", 3.0),
    ("one case", r"^([a-z+/_=-]+|[A-Z+/_=-]+)$", 3.9), ("alphanumeric", r"^[0-9A-Za-z]+$", 3.6), ("base64", "", 3.7),
)
#: Runs that look random and are none: identifiers, placeholders, counting sequences.
ALLOWED = (
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"(?i)example|sample|dummy|placeholder|changeme|redacted|xxxx",
    r"(?i)abcdefgh|01234567|12345678",
)
SPAN = "array<struct<start: bigint, rank: int, end: bigint>>"


def _running(lengths: Column, start: Column) -> Column:
    """Sum of the earlier elements, for each element."""
    begin = F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(
        lengths, begin,
        lambda s, x: F.struct((s["at"] + x).alias("at"), F.array_append(s["out"], s["at"]).alias("out")),
        lambda s: s["out"],
    )


def _offsets(lengths: Column) -> Column:
    """``_running`` from 0, by blocks of about the square root of the number, which bounds the copying."""
    number = F.size(lengths)
    block = F.greatest(F.lit(1), F.ceil(F.sqrt(number))).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((number - 1) / block).cast("int")),
        lambda i: F.slice(lengths, i * block + 1, block),
    )
    starts = _running(
        F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("bigint"), lambda s, x: s + x)), F.lit(0).cast("bigint")
    )
    return F.flatten(F.zip_with(blocks, starts, _running))


def _located(text: Column, pattern: str) -> tuple[Column, Column]:
    """The matches of a pattern, leftmost and not overlapping, and where each starts."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("bigint"))
    before = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: g + F.length(m))
    # The n-th match ends where n gaps and n matches end.
    starts = F.zip_with(_offsets(before), gaps, lambda at, g: at + g)
    return matches, F.slice(starts, 1, F.size(matches))


def _spans(text: Column, pattern: str, rank: int, keep=None) -> Column:
    matches, starts = _located(text, pattern)
    found = F.zip_with(matches, starts, lambda m, at: F.struct(m.alias("match"), at.alias("at")))
    if keep is not None:
        found = F.filter(found, lambda x: keep(x["match"]))
    spans = F.transform(found, lambda x: F.struct(
        x["at"].alias("start"), F.lit(rank).alias("rank"), (x["at"] + F.length(x["match"])).alias("end")
    ))
    return F.when(text.rlike(pattern), spans.cast(SPAN)).otherwise(F.array().cast(SPAN))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


#: Counts of the characters of a window, packed: so many bits each, so many to a number.
COUNT_BITS, PACKED = 6, 10


def window_entropy(run: Column, window: int = WINDOW) -> Column:
    """The highest entropy, in bits per character, of any window of the run; null for a shorter run.

    A step changes two counts, which lie packed in a few numbers, so the time
    grows with the length of the run. ``window`` is at most 62.
    """
    terms = [c * math.log2(c) if c else 0.0 for c in range(window + 2)]
    rises = F.array(*[F.lit(b - a) for a, b in zip(terms, terms[1:])])
    kinds = len(ALPHABET) + 1
    numbers = range(-(-kinds // PACKED))
    group = F.array(*[F.lit(k // PACKED) for k in range(kinds)])
    shift = F.array(*[F.lit(COUNT_BITS * (k % PACKED)) for k in range(kinds)])
    unit = F.array(*[F.lit(1 << COUNT_BITS * (k % PACKED)).cast("bigint") for k in range(kinds)])
    begin = F.struct(F.array(*[F.lit(0).cast("bigint") for _ in numbers]).alias("n"), F.lit(0.0).alias("s"), F.lit(float("inf")).alias("least"))

    def count(held: Column, kind: Column) -> Column:
        number = F.call_function("shiftright", F.get(held, F.get(group, kind)), F.get(shift, kind))
        return number.bitwiseAND((1 << COUNT_BITS) - 1).cast("int")

    def step(state: Column, x: Column) -> Column:
        new, old = x["new"], x["old"]
        rise = F.get(rises, count(state["n"], new))
        fall = F.when(old >= 0, F.get(rises, count(state["n"], old) - 1)).otherwise(0.0)
        total = state["s"] + F.when(new == old, 0.0).otherwise(rise - fall)
        moved = F.when(new == old, state["n"]).otherwise(F.transform(state["n"], lambda v, k: v
            + F.when(k == F.get(group, new), F.get(unit, new)).otherwise(F.lit(0).cast("bigint"))
            - F.when((old >= 0) & (k == F.get(group, old)), F.get(unit, old)).otherwise(F.lit(0).cast("bigint"))))
        return _bound(F.struct(moved.alias("n"), total.alias("s")), lambda t: F.struct(
            t["n"].alias("n"), t["s"].alias("s"), F.when(x["full"], F.least(state["least"], t["s"])).otherwise(state["least"]).alias("least")
        ))

    def best(codes: Column) -> Column:
        left = F.concat(F.array_repeat(F.lit(-1), window), F.slice(codes, 1, F.size(codes) - window))
        moves = F.transform(F.arrays_zip(codes.alias("new"), left.alias("old")), lambda m, i: F.struct(
            m["new"].alias("new"), m["old"].alias("old"), (i >= window - 1).alias("full")
        ))
        return F.aggregate(moves, begin, step, lambda s: math.log2(window) - s["least"] / window)

    codes = F.transform(F.regexp_extract_all(run, F.lit("(?s)."), F.lit(0)), lambda c: F.instr(F.lit(ALPHABET), c))
    return F.when(F.length(run) >= window, _bound(codes, best))


def _threshold(run: Column, classes) -> Column:
    threshold = F.lit(classes[-1][2])
    for _, pattern, bits in reversed(classes[:-1]):
        threshold = F.when(run.rlike(pattern), bits).otherwise(threshold)
    return threshold


def held(run: Column) -> Column:
    """Whether a candidate run holds a secret: some part between its allowed texts looks random."""
    parts = F.split(run, "|".join(f"(?:{p})" for p in ALLOWED), -1)
    return F.exists(parts, lambda part: F.when(
        F.length(part) >= WINDOW, window_entropy(part) >= _threshold(part, PART_CLASSES)
    ).otherwise(False))


def _random(run: Column) -> Column:
    """Whether a candidate run is taken for a secret, by the narrower rule."""
    threshold = _threshold(run, CLASSES)
    known = F.lit(False)
    for pattern in ALLOWED:
        known = known | run.rlike(pattern)
    mixed = run.rlike("[0-9]") & run.rlike("[A-Za-z]")
    return F.when(mixed & ~known, window_entropy(run) >= threshold).otherwise(False)


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ","
    )


def find(docs: DataFrame, text: str = "text", judge=_random) -> DataFrame:
    """Add arrays of spans ``_assign``, ``_access``, ``_hex`` and ``_entropy`` to the rows.

    Positions count code points, ends are exclusive. A null text is empty and
    an empty text has no span. ``judge`` says which candidate runs are secrets.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        "*",
        _spans(body, ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6).alias("_assign"),
        _spans(body, ACCESS, 1).alias("_access"),
        _spans(body, HEX, 2).alias("_hex"),
        _spans(body, RUN, 3, judge).alias("_entropy"),
    )


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", judge=_random) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy for each row.

    Spans of different kinds may overlap. Repeated rows and null ids are kept,
    other columns are not read, an empty table gives no rows.
    """
    found = find(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), judge=judge)
    base = F.concat("_assign", "_access", "_hex")
    return found.select(
        "doc_id",
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.concat(base, F.col("_entropy"))).alias("spans"),
        F.size("_entropy").cast("long").alias("n_entropy"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", text: str = "text") -> DataFrame:
    """The rows with every match of a base pattern replaced by ``mark``; a short assigned value stays."""
    kept = ASSIGN.replace("=-]+)", "=-]{6,})")
    body = F.regexp_replace(F.col(text), kept, mark)
    return docs.withColumn(text, F.regexp_replace(F.regexp_replace(body, ACCESS, mark), HEX, mark))
