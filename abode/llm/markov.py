"""Secret scan: fixed rules, and two character Markov models compared by likelihood.

Rules find assignments (``token = "..."``), access keys and hexadecimal runs.
What the rules capture is a labelled sample of random strings, and runs of
letters outside those spans are a labelled sample of ordinary identifiers. A
first-order character model is counted for each class over the whole table, and
every long unbroken run, or what the rules' spans leave of it, is added as a span
of kind ``markov`` if its mean log-likelihood ratio per step speaks for the random one.

All of it is DataFrame expressions. The two models together are a table of
``CODES`` x ``CODES`` numbers whatever the input's size, and reach the tasks as
one literal array.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules' patterns and least lengths.
ASSIGN = r"""(?i)(?=[psta])(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_MIN = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"  # AKIA and one run: 18 characters or more, the same matches as with a later length test
HEX = r"[0-9a-f]{16,}"  # whole runs of 16 or more
KINDS = ("assign", "access", "hex", "markov")

LEAST = 20
RUN = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
IDENTIFIER = r"(?<![A-Za-z0-9+/_=-])[A-Za-z][A-Za-z_]{9,}(?![A-Za-z0-9+/_=-])"
FIRST, CODES = 43, 80  # '+' to 'z'
THRESHOLD = 0.35  # mean log-likelihood ratio per step, in nats
SPAN = "array<struct<s:int,e:int,k:int,v:string>>"


def _matches(text: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract_all({text}, r'{_quoted(pattern)}', {group})"


def _quoted(pattern: str) -> str:
    return pattern.replace("'", r"\x27").replace('"', r"\x22")


def spans(text: str, pattern: str, kind: int, group: int = 0, least: int = 0) -> str:
    """SQL for the spans of all leftmost non-overlapping matches, in code points.

    ``split`` gives what lies between the matches, so lengths of gaps and
    matches add up to positions. Matches whose ``group`` is shorter than
    ``least`` are dropped after matching. ``v`` holds the group's text.
    """
    value = _matches(text, pattern, group)
    empty = f"cast(array() as {SPAN})"
    parts = f"struct(split({text}, r'{_quoted(pattern)}', -1) as g, m, {value if group else 'm'} as v)"
    fold = (
        f"aggregate(transform(array({parts}), y -> arrays_zip(y.g, y.m, y.v))[0], "
        f"struct(0 as p, {empty} as o), "
        f"(a, x) -> struct(a.p + length(x.g) + coalesce(length(x.m), 0) as p, "
        f"if(x.m is not null and length(x.v) >= {least}, concat(a.o, array(struct("
        f"a.p + length(x.g) as s, a.p + length(x.g) + length(x.m) as e, {kind} as k, x.v as v))), a.o) as o), "
        f"a -> a.o)"
    )
    return f"transform(array({_matches(text, pattern)}), m -> if(size(m) = 0, {empty}, {fold}))[0]"


def base_spans(text: str = "_text") -> Column:
    """Spans of the three rules, by start and then kind."""
    assign = spans(text, ASSIGN, 0, 2, ASSIGN_MIN)
    access = f"if(contains({text}, 'AKIA'), {spans(text, ACCESS, 1)}, cast(array() as {SPAN}))"
    return F.expr(f"array_sort(concat({assign}, {access}, {spans(text, HEX, 2)}), (a, b) -> case when a.s <> b.s then a.s - b.s else a.k - b.k end)")


def _digest_text(column: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({column}, x -> concat_ws(':', element_at(array({names}), x.k + 1), x.s, x.e)), ',')")


def _steps(word: str) -> str:
    """SQL: the codes ``a * CODES + b`` of neighbouring characters of ``word``."""
    code = f"(ascii(substring({word}, i, 1)) - {FIRST})"
    after = f"(ascii(substring({word}, i + 1, 1)) - {FIRST})"
    return f"transform(sequence(1, length({word}) - 1), i -> {code} * {CODES} + {after})"


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.col(id_col).alias("_id"), text.alias("_text")).withColumn("_base", base_spans())


def log_ratio(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[float]:
    """Train both models on the whole table; ``log P(b|a)`` random minus ordinary, by step code.

    Each distinct sample counts once, so copies don't weigh more. Every model
    starts from one count for each step. Without samples all ratios are 0.
    """
    found = _texts(df, id_col, text_col)
    random = F.expr("transform(filter(_base, x -> x.v rlike '[A-Za-z]' and x.v rlike '[0-9]'), x -> struct(x.v as w, true as random))")
    plain = F.expr(f"transform(array_distinct({_matches('_text', IDENTIFIER)}), x -> struct(x as w, false as random))")
    samples = found.select(F.explode(F.concat(random, plain)).alias("x")).select("x.w", "x.random").distinct()
    clean = samples.filter(F.length("w") > 1).select("random", F.explode(F.expr(_steps("translate(w, '.', '_')"))).alias("step"))
    counts = {(r["random"], r["step"]): r["n"] for r in clean.groupBy("random", "step").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = []
    for a in range(CODES):
        total = {c: CODES + sum(counts.get((c, a * CODES + b), 0) for b in range(CODES)) for c in (True, False)}
        for b in range(CODES):
            p = {c: (1 + counts.get((c, a * CODES + b), 0)) / total[c] for c in (True, False)}
            out.append(round(math.log(p[True] / p[False]), 6))
    return out


def find_secrets(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: list[float] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per input row: the identifier, ``base`` and ``found`` (arrays of spans).

    A span is ``(s, e, k, v)``: code points, end exclusive, index into ``KINDS``
    and the value. ``found`` holds ``base`` and the runs added by the models, or
    their parts outside the rules' spans; those never overlap a rule's span. ``ratio`` is a trained table, by default
    :func:`log_ratio` of the same rows. A null text counts as empty and has no
    spans; repeated rows each get their own; an empty table gives no rows.
    """
    ratio = log_ratio(df, id_col, text_col) if ratio is None else ratio
    table = f"from_json('{json.dumps(ratio)}', 'array<double>')"
    steps = _steps("c.v")
    mean = f"aggregate({steps}, 0.0D, (t, x) -> t + _ratio[x]) / (length(c.v) - 1)"
    piece = "struct({0} as s, {1} as e, c.k as k, substring(c.v, {0} - c.s + 1, {1} - {0}) as v)"
    cut = (
        f"aggregate(filter(_base, b -> b.s < c.e and c.s < b.e), struct(c.s as p, cast(array() as {SPAN}) as o), "
        f"(a, b) -> struct(greatest(a.p, b.e) as p, if(b.s - a.p >= {LEAST}, concat(a.o, array({piece.format('a.p', 'b.s')})), a.o) as o), "
        f"a -> if(c.e - a.p >= {LEAST}, concat(a.o, array({piece.format('a.p', 'c.e')})), a.o))"
    )
    rows = _texts(df, id_col, text_col).withColumn("_runs", F.expr(spans("_text", RUN, 3)))
    rows = rows.withColumn("_ratio", F.expr(table))
    rows = rows.withColumn("_runs", F.expr(f"flatten(transform(_runs, c -> {cut}))"))
    added = F.expr(f"filter(_runs, c -> {mean} > {threshold}D)")
    order = "(a, b) -> case when a.s <> b.s then a.s - b.s else a.k - b.k end"
    return rows.select(
        F.col("_id").alias(id_col), F.col("_base").alias("base"), F.concat("_base", added).alias("_all")
    ).select(id_col, "base", F.expr(f"array_sort(_all, {order})").alias("found"))


def secret_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by rule, the digest of the rules' spans, and all spans as text."""
    found = find_secrets(df, id_col, text_col)
    count = lambda k: F.size(F.expr(f"filter(base, x -> x.k = {k})")).cast("bigint")
    return found.select(
        id_col,
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_digest_text("base"), 256).alias("base_sha256"),
        _digest_text("found").alias("spans"),
    )
