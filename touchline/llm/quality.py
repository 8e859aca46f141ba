"""Quality rules as a short-circuit cascade: the rule that rejects most per unit of cost goes first.

Everything is built of Spark's own expressions. A value that several expressions of a lambda need is bound by
``let``, as Spark would compute it anew for every element otherwise.
"""

from __future__ import annotations

import re
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import stage

WORDS = r"filter(split(body, '[\\x20\\x09-\\x0D]+'), w -> w != '')"


def let(name: str, value: str, body: str) -> str:
    """SQL of ``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


#: Words in a window of three that occurs twice or more: windows are hashed and sorted with their places, those equal
#: to a neighbour repeat, and each adds the words that the one before it has not covered yet.
REPEATED = "if(size(words) < 4, 0, " + let(
    "hashes", "transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2]))",
    "if(size(array_distinct(hashes)) = size(hashes), 0, " + let(
        "ordered", "sort_array(transform(hashes, (h, i) -> struct(h AS h, i AS i)))", let(
            "places", "sort_array(transform(filter(ordered, (e, k) -> (k > 0 AND ordered[greatest(k - 1, 0)].h = e.h) OR "
                      "(k < size(ordered) - 1 AND ordered[least(k + 1, size(ordered) - 1)].h = e.h)), e -> e.i))",
            "aggregate(transform(places, (p, k) -> if(k = 0, 3, least(3, p - places[greatest(k - 1, 0)]))), 0, (a, n) -> a + n)"),
    ) + ")") + ")"

#: Metrics of a text ``body`` (never NULL) with its ``words``; all whole numbers.
METRICS = {
    "n_words": "size(words)",
    "word_chars": r"char_length(translate(body, ' \t\n\u000b\u000c\r', ''))",
    "n_symbols": "char_length(body) - char_length(translate(body, '#*$%&|<>', ''))",
    "n_lines": r"size(filter(split(body, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]'))",
    "n_dup_lines": let("lines", r"filter(split(body, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')", "size(lines) - size(array_distinct(lines))"),
    "n_repeat_words": REPEATED,
    "n_capitals": "char_length(body) - char_length(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))",
}


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the metrics listed in ``needs``."""

    name: str
    needs: tuple[str, ...]
    fails: str


BASE = (
    Rule("short", ("n_words",), "n_words < 50"),
    Rule("repeats", ("n_words", "n_repeat_words"), "100 * n_repeat_words > 50 * n_words"),
)
#: Three symbols to two words, two lines in three a copy, words of no usual length, or shouting throughout.
RULES = (
    *BASE,
    Rule("symbols", ("n_words", "n_symbols"), "2 * n_symbols > 3 * n_words"),
    Rule("copied lines", ("n_lines", "n_dup_lines"), "3 * n_dup_lines > 2 * n_lines"),
    Rule("word length", ("n_words", "word_chars"), "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("capitals", ("word_chars", "n_capitals"), "10 * n_capitals > 6 * word_chars"),
)


def of_text(expression: str) -> str:
    """SQL of ``expression`` over ``body``, the row's text with NULL as empty, and its ``words`` if it names them."""
    cut = let("words", WORDS, expression) if re.search(r"\bwords\b", expression) else expression
    return let("body", "coalesce(CAST(text AS STRING), '')", cut)


def struct_of(metrics: list[str]) -> str:
    return "struct(" + ", ".join(f"{METRICS[m]} AS {m}" for m in metrics) + ")"


def measured(docs: DataFrame, metrics: list[str]) -> DataFrame:
    """``docs`` with one struct column ``metrics`` (replaced if there is one); the words are cut once for all of them."""
    return docs.withColumn("metrics", F.expr(of_text(struct_of(metrics))))


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    rejects: float
    seconds: float

    @property
    def worth(self) -> float:
        return self.rejects / max(self.seconds, 1e-9)


def fails(rule: Rule, wanted: list[str], owner: str) -> str:
    """SQL of the rule over ``body`` and ``words``: metrics in ``wanted`` are taken from the struct ``owner``, the others
    are measured here, and so only where this expression is evaluated."""
    have, missing = [m for m in rule.needs if m in wanted], [m for m in rule.needs if m not in wanted]
    said = qualified(rule.fails, have, owner)
    return let("own", struct_of(missing), qualified(said, missing, "own")) if missing else said


def qualified(expression: str, names: list[str], owner: str) -> str:
    return re.sub(r"(?<!\.)\b(" + "|".join(names) + r")\b", rf"{owner}.\1", expression) if names else expression


def estimate(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 1000, seed: int = 7,
             wanted: tuple[str, ...] = (), repeats: int = 5) -> list[Estimate]:
    """Cost and share of rejected rows of each rule on a random sample of about ``sample_rows``, best worth first.

    Metrics in ``wanted`` are measured whatever the rules say, so they cost a rule nothing. Each rule is evaluated
    ``repeats`` times on every row of one staged sample, in one task; what the same job takes without a rule is taken off.
    The order is a matter of speed only: what a cascade keeps does not depend on it. NULL text counts as empty; of an
    empty table nothing is rejected, and the rules stay in their order.
    """
    total = docs.count()
    sample = docs.select("text").sample(min(1.0, sample_rows / max(total, 1)), seed)
    sample = stage(measured(sample, list(wanted)) if wanted else sample).coalesce(1)
    # The copy's number is part of the text, or the rule would be evaluated before the rows are copied.
    copies = sample.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(repeats)))).withColumn(
        "text", F.expr("concat(coalesce(CAST(text AS STRING), ''), if(copy < 0, ' ', ''))"))

    def timed(condition: str) -> tuple[float, float]:
        start = time.perf_counter()
        row = copies.select(F.expr(condition).alias("fails"), F.length("text").alias("n")).agg(
            F.count_if("fails"), F.count("n"), F.sum("n")).first()
        return time.perf_counter() - start, row[0] / max(row[1], 1)

    timed("copy < 0")  # the first job also reads the sample's files into memory and compiles
    start_up = min(timed("copy < 0")[0] for _ in range(2))
    found = []
    for rule in rules:
        seconds, rejects = timed(of_text(fails(rule, list(wanted), "metrics")))
        own = max(seconds - start_up, 0.0) if set(rule.needs) - set(wanted) else 0.0
        found.append(Estimate(rule, rejects, own / repeats))
    return sorted(found, key=lambda e: (-e.worth, e.seconds))


def verdict(order: list[Estimate], wanted: list[str], owner: str) -> str:
    """SQL of the cascade: a branch is evaluated only if all before it have let the row pass."""
    return "CASE " + " ".join(f"WHEN {fails(e.rule, wanted, owner)} THEN '{e.rule.name}'" for e in order) + " END"


def cascade(docs: DataFrame, order: list[Estimate]) -> DataFrame:
    """``docs`` with ``failed``, the first rule of the order that rejects the row, or NULL if it is kept.

    A rule's metrics are measured only on the rows that the rules before it have let pass. The text is read from ``text``,
    NULL as empty; other columns stay as they are (one named ``failed`` is replaced), rows are neither dropped nor joined.
    """
    return docs.withColumn("failed", F.expr(of_text(verdict(order, [], ""))))


def judged(docs: DataFrame, order: list[Estimate], wanted: tuple[str, ...] = tuple(METRICS)) -> DataFrame:
    """The same cascade beside metrics that are ``wanted`` of every row: adds the struct ``metrics`` of these and ``failed``.

    Rules take the wanted metrics as they are; any other is measured only on the rows that get as far as its rule. NULL
    text is empty, which the rule on the number of words rejects; columns of the two names are replaced.
    """
    both = let("m", struct_of(list(wanted)), f"struct(m AS metrics, {verdict(order, list(wanted), 'm')} AS failed)")
    whole = docs.withColumn("metrics", F.expr(of_text(both)))
    return whole.withColumns({"metrics": F.col("metrics.metrics"), "failed": F.col("metrics.failed")})
