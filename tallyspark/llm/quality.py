"""Quality rules as a short-circuit cascade, in native column expressions."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from statistics import median

from pyspark.sql import Column, DataFrame, functions as F

from .common import park

SPACE = " \t\n\x0b\f\r"
SPACES = r"[ \t-\r]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where lambdas refer to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    return bound(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long")


def windows(tokens: Column, n: int) -> Column:
    """Hashes of all runs of ``n`` words (a power of two), by doubling."""

    def doubled(hashes: Column, k: int) -> Column:
        def join(a: Column) -> Column:
            left = F.greatest(F.size(a) - k, F.lit(0))
            return F.zip_with(F.slice(a, 1, left), F.slice(a, k + 1, left), lambda x, y: F.xxhash64(x, y))

        return bound(hashes, join)

    hashes, width = F.transform(tokens, lambda w: F.xxhash64(w)), 1
    while width < n:
        hashes, width = doubled(hashes, width), 2 * width
    return hashes


def repeat_words(tokens: Column, n: int = WINDOW) -> Column:
    """Words inside windows of ``n`` words that occur at least twice in the text."""

    def positions(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twins = bound(
            pairs,
            lambda a: F.zip_with(
                F.slice(a, 1, F.size(a) - 1),
                F.slice(a, 2, F.size(a)),
                lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])).otherwise(
                    F.array().cast("array<int>")
                ),
            ),
        )
        return F.sort_array(F.array_distinct(F.flatten(twins)))

    def covered(starts: Column) -> Column:
        steps = F.zip_with(
            starts, F.slice(starts, 2, F.size(starts)), lambda a, b: F.least(F.lit(n), F.coalesce(b - a, F.lit(n)))
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    return bound(
        windows(tokens, n),
        lambda a: F.when(F.size(F.array_distinct(a)) == F.size(a), F.lit(0)).otherwise(bound(positions(a), covered)),
    ).cast("long")


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts the rules share, in columns ``q_*``.

    A null text counts as empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = docs.withColumn("q_words", words(text))
    return docs.withColumns(
        {
            "q_n_words": F.size("q_words").cast("long"),
            "q_word_chars": F.length(F.regexp_replace(text, SPACES, "")).cast("long"),
            "q_n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
            "q_n_dup_lines": n_dup_lines(text),
            "q_n_repeat_words": repeat_words(F.col("q_words")),
        }
    ).drop("q_words")


def base_failed(least_words: int = 20, repeat_percent: int = 30) -> Column:
    """Too short, or too many words in repeated windows."""
    n = F.col("q_n_words")
    return (n < least_words) | (100 * F.col("q_n_repeat_words") > repeat_percent * n)


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps the text column to a condition that is never null."""

    name: str
    rejects: Callable[[Column], Column]


def _per_word(text: Column, pattern: str, share: float) -> Column:
    """More matches of ``pattern`` than ``share`` times the number of words."""
    return F.regexp_count(text, F.lit(pattern)) > share * F.regexp_count(text, F.lit(r"[^ \t-\r]+"))


def _line_share(text: Column, share: float) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    return bound(lines, lambda a: F.size(a) - F.size(F.array_distinct(a)) > share * F.size(a))


#: Limits are far from what ordinary prose reaches, so clean text passes.
RULES = (
    Rule("symbols", lambda t: _per_word(t, SYMBOLS, 0.3)),
    Rule("shouting", lambda t: _per_word(t, r"!!", 0.3)),
    Rule("no_letters", lambda t: F.regexp_count(t, F.lit(r"\p{L}")) < 0.5 * F.length(F.regexp_replace(t, SPACES, ""))),
    Rule("long_words", lambda t: F.length(t) > 40 * F.regexp_count(t, F.lit(r"[^ \t-\r]+"))),
    Rule("repeated_lines", lambda t: _line_share(t, 0.5)),
)


def sampled(docs: DataFrame, text_col: str, rows: int, seed: int = 7) -> tuple[DataFrame, int]:
    """At most ``rows`` random texts, parked: the sample for the estimates, and their number.

    The fraction drawn follows the number of rows (for Parquet a matter of footers), so about
    twice ``rows`` texts leave the scan at any size.
    """
    total = docs.count()
    fraction = min(1.0, 2.0 * rows / max(total, 1))
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    sample = park(texts.sample(fraction, seed).limit(rows))
    return sample, sample.count()


def order_rules(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    text_col: str = "text",
    sample_rows: int = 2000,
    copies: int = 4,
    rounds: int = 3,
) -> list[tuple[Rule, float, float]]:
    """(rule, share rejected, seconds) by rejection per cost, best first.

    Each rule runs alone over a parked sample of at most ``sample_rows`` texts, ``copies`` times
    each so that evaluation outweighs the job around it. Rules take turns for ``rounds`` rounds;
    a cost is the median above that of reading the sample, and at least a twentieth of it. Shares
    count half a rejection more, so rules that rejected nothing go by their cost. The sample
    decides the order only: a cascade rejects the same documents in any order.
    """
    sample, n = sampled(docs, text_col, sample_rows)
    if not n:
        return [(rule, 0.0, 0.0) for rule in rules]
    sample = sample.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    conditions = [F.length("t") < 0, *[rule.rejects(F.col("t")) for rule in rules]]
    jobs = [sample.agg(F.count_if(c)) for c in conditions]
    hits = [job.collect()[0][0] // copies for job in jobs]  # compiled code is kept for the timed rounds
    times: list[list[float]] = [[] for _ in jobs]
    for _ in range(rounds):
        for job, taken in zip(jobs, times, strict=True):
            start = time.perf_counter()
            job.collect()
            taken.append(time.perf_counter() - start)
    least, *seconds = map(median, times)
    found = [
        (rule, (hit + 0.5) / (n + 1), max(cost - least, least / 20) / copies)
        for rule, hit, cost in zip(rules, hits[1:], seconds, strict=True)
    ]
    return sorted(found, key=lambda x: -x[1] / x[2])


def first_rejection(rules: list[Rule] | tuple[Rule, ...], text_col: str = "text") -> Column:
    """Name of the first rule of the cascade that rejects the text, or null; later rules are
    not evaluated."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = None
    for rule in rules:
        hit, name = rule.rejects(text), F.lit(rule.name)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit(None).cast("string") if out is None else out


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def judge(
    docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000
) -> DataFrame:
    """``docs`` with ``q_n_words``, ``q_word_chars``, ``q_n_symbols``, ``q_n_dup_lines``,
    ``q_n_repeat_words``, ``q_base_failed``, ``q_rejected_by`` and ``q_kept``.

    The base rules, whose counts every row needs, come first; rows they fail skip the cascade.
    Null and empty texts have no words and fail; repeated rows are judged alike; an empty
    table gives no rows; other columns pass through untouched, but for those that have one of
    the eight names, in any case of letters: the verdict takes their place.
    """
    row = F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row")
    texts = docs.select(row, F.col(quoted(text_col)).alias("text"))
    cascade = [rule for rule, _, _ in order_rules(texts, rules, "text", sample_rows)]
    out = measured(texts).withColumn("q_base_failed", base_failed())
    out = out.withColumn(
        "q_rejected_by", F.when(F.col("q_base_failed"), F.lit("base")).otherwise(first_rejection(cascade))
    ).withColumn("q_kept", F.col("q_rejected_by").isNull())
    verdict = [c for c in out.columns if c not in ("row", "text")]
    own = [c for c in docs.columns if c.lower() not in verdict]
    return out.select(*[F.col(f"row.{quoted(c)}").alias(c) for c in own], *verdict)


def clean(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that all rules keep, with their own columns."""
    row = F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row")
    return judge(docs.select(row, F.col(quoted(text_col)).alias("text"))).where("q_kept").select("row.*")
