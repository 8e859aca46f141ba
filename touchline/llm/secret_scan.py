"""Secrets in texts, and how widely each candidate is owned across the corpus.

Candidates are found by patterns, hashed, and counted by distinct repositories and owners. A value that many owners
or many repositories have is an example that was copied around; one that few of both have looks live. The patterns of
``BASE`` are reported whatever their owners; those of ``LOOSE`` match much that is no secret and are reported only if
they look live.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.quality import let
from touchline.session import stage


@dataclass(frozen=True)
class Kind:
    """``group`` of ``pattern`` is the secret, and ``keep`` is SQL that tells from it (``v``) which matches stay."""

    name: str
    pattern: str
    group: int
    keep: str


BASE = (
    Kind("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, "char_length(v) >= 8"),
    Kind("access", r"AKIA[A-Z0-9]+", 0, "char_length(v) >= 16"),
    Kind("hex", r"[0-9a-f]+", 0, "char_length(v) >= 32"),
)
LOOSE = (
    Kind("opaque", r"[A-Za-z0-9+/_-]{20,}", 0, "v rlike '[a-z]' AND v rlike '[A-Z]' AND v rlike '[0-9]'"),
    Kind("login", r"://[^\s/:@]+:([^\s/:@]+)@", 1, "char_length(v) >= 8"),
)
KINDS = (*BASE, *LOOSE)
BLOCK = 64


def running(fold) -> str:
    """SQL of ``fold`` (SQL of two whole numbers, 0 its neutral) over each beginning of the array ``steps``: within blocks,
    and of whole blocks, so that a text of very many matches costs no square of their number."""
    return let(
        "blocks", f"transform(sequence(0, (size(steps) - 1) div {BLOCK}), b -> slice(steps, b * {BLOCK} + 1, {BLOCK}))", let(
            "bases", f"aggregate(blocks, array(0), (a, b) -> concat(a, array({fold('a[size(a) - 1]', 'aggregate(b, 0, (s, x) -> ' + fold('s', 'x') + ')')})))",
            f"flatten(transform(blocks, (b, i) -> slice(aggregate(b, array(bases[i]), (a, x) -> concat(a, array({fold('a[size(a) - 1]', 'x')}))), 2, size(b))))"))


RUNNING = running(lambda a, b: f"{a} + {b}")
#: Spans of ``found`` (by start, then kind) but for loose ones inside a base one: those end where a base span that does not
#: begin later reaches.
APART = "if(size(found) = 0, found, " + let(
    "steps", f"transform(found, s -> if(s.place < {len(BASE)}, s.end, 0))", let(
        "reach", running(lambda a, b: f"greatest({a}, {b})"), f"filter(found, (s, i) -> s.place < {len(BASE)} OR s.end > reach[i])")) + ")"


def matches(kind: Kind, place: int) -> str:
    """SQL array of (start, place, kind, end, value) of the matches in ``body``; starts and ends in code points.

    The gaps are what splitting at the pattern leaves, so each match ends where gaps and matches up to it do.
    """
    pattern = "'" + kind.pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"
    value = f"regexp_extract(m, {pattern}, {kind.group})" if kind.group else "m"
    lengths = "transform(found, (m, i) -> char_length(gaps[i]) + char_length(m))"
    spans = f"""filter(transform(found, (m, i) -> struct(ends[i] - char_length(m) AS start, {place} AS place, '{kind.name}' AS kind,
                ends[i] AS end, {value} AS value)), s -> {kind.keep.replace('v ', 's.value ').replace('(v)', '(s.value)')})"""
    inner = let("gaps", f"split(body, {pattern}, -1)", let("steps", lengths, let("ends", RUNNING, spans)))
    none = "CAST(array() AS array<struct<start:int,place:int,kind:string,end:int,value:string>>)"
    return let("found", f"regexp_extract_all(body, {pattern}, 0)", f"if(size(found) = 0, {none}, {inner})")


def listed(spans: str) -> str:
    return f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id", max_owners: int = 2, keep: tuple[str, ...] = (),
         max_repositories: int = 10) -> DataFrame:
    """Spans of secrets per row of ``docs`` (doc_id, text and the two named columns; others are not read).

    Columns: doc_id, ``base`` and ``spans`` (arrays of start, place, kind, end, value, by start and then kind; ``spans``
    adds the loose ones that at most ``max_owners`` owners and ``max_repositories`` repositories have and that lie in no base span), n_live and n_copied
    (candidates of the row by that test), and with ``keep`` a struct ``kept`` of these columns. NULL text is empty; a NULL owner or
    repository counts as one owner or repository of its own; repeated rows are rows of their own but add no owner. An
    empty table gives no rows.

    The text is read once: what is found is staged without it, unless it is to be kept. Owners and repositories are counted by Spark's
    distinct count, which combines (hash, owner) and (hash, repository) before their values meet, so a value that
    stands in a third of all rows is no large group. Verdicts come back by a join of two plain tables on the hash,
    whose large partitions adaptive execution splits.
    """
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\0"))
    every = F.expr(let("body", "coalesce(CAST(text AS STRING), '')", "concat(" + ", ".join(matches(k, i) for i, k in enumerate(KINDS)) + ")"))
    found = stage(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), named(owner).alias("owner"),
        named(repository).alias("repository"), F.array_sort(every).alias("found"), *([F.struct(*keep).alias("kept")] if keep else [])))
    base = F.expr(f"filter(found, s -> s.place < {len(BASE)})")
    found = found.withColumns({"base": base, "found": F.expr(APART)})
    candidates = found.select("row", "owner", "repository", F.explode("found").alias("s")).withColumn("hash", F.unhex(F.sha1("s.value")))
    owned = stage(candidates.groupBy("hash").agg(F.count_distinct("owner").alias("owners"), F.count_distinct("repository").alias("repositories")))
    live = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    judged = candidates.select("row", "hash", "s").join(owned, "hash").groupBy("row").agg(
        F.collect_list(F.when(live & (F.col("s.place") >= len(BASE)), F.col("s"))).alias("added"),
        F.count_if(live).alias("n_live"), F.count_if(~live).alias("n_copied"))
    return found.drop("found").join(judged, "row", "left").select(
        "doc_id", "base", F.array_sort(F.concat("base", F.coalesce("added", F.expr("filter(base, s -> false)")))).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_copied", F.lit(0)).alias("n_copied"), *(["kept"] if keep else []))


def redacted(text: str = "kept.text", spans: str = "spans", mark: str = "[SECRET]") -> str:
    """SQL of the text with each span, or run of overlapping spans, replaced by ``mark``; spans are in order of their starts.

    Spans are taken in as many blocks as a block has spans, and each block has its own stretch of the text, so neither the
    text nor what is done of it is walked once a span.
    """
    # ``at`` is where the text goes on after the spans so far; a span that starts before it only moves it.
    step = f"""named_struct('done', if(s.start >= a.at, concat(a.done, substring(part, a.at - at + 1, s.start - a.at), '{mark}'), a.done),
                            'at', greatest(a.at, s.end))"""
    block = let("at", "starts[i]", let("part", f"substring({text}, at + 1, greatest(ends[i] - at, 0))",
                                       f"aggregate(block, named_struct('done', '', 'at', at), (a, s) -> {step}, a -> a.done)"))
    whole = let("per", f"CAST(ceil(sqrt(size({spans}))) AS INT)", let(
        "blocks", f"transform(sequence(0, CAST((size({spans}) - 1) div per AS INT)), b -> slice({spans}, b * per + 1, per))", let(
            "ends", "transform(blocks, b -> array_max(transform(b, s -> s.end)))", let(
                "starts", "transform(ends, (e, i) -> if(i = 0, 0, array_max(slice(ends, 1, i))))",
                f"concat(array_join(transform(blocks, (block, i) -> {block}), ''), substring({text}, array_max(ends) + 1))"))))
    return f"if(size({spans}) = 0, {text}, {whole})"
