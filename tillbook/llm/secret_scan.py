"""Secret scan through a trigram inverted index; DataFrame functions only.

Each rule's regex is turned into a Boolean query over trigrams: alternatives, each a
set of trigrams that any match must hold. The index has postings (trigram, text) for
the trigrams the rules mention; a rule's candidates are the texts found in all
postings of one alternative. Only candidates are verified with the regex. A rule
without mandatory trigrams (hex runs) scans all texts.

Texts are indexed by a 64-bit hash. Equal texts share postings, so copies cost one
entry; two texts with one hash would only widen each other's candidates, and
verification decides. Nothing is dropped or capped.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.llm.columns import id_and_text, running_sum


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group`` must have ``least`` characters, else the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
#: In the order in which spans with the same start are listed.
BASE_RULES = (
    Rule("assign", ASSIGN, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("stripe", r"sk_live_[0-9A-Za-z]{24,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

#: A literal set larger than this is cut; the query stays necessary, only less sharp.
MOST_LITERALS = 64

Query = frozenset[frozenset[str]]  # any of these sets of trigrams; {{}} holds always
ALWAYS: Query = frozenset([frozenset()])


def _tidy(query: Query) -> Query:
    """Without alternatives implied by a weaker one."""
    return frozenset(a for a in query if not any(b < a for b in query))


def _both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > MOST_LITERALS:
        return a if len(a) <= len(b) else b
    return _tidy(frozenset(x | y for x in a for y in b))


def _of_literals(literals: set[str]) -> Query:
    # Every third trigram and the last: they cover the literal, the ones between add little.
    cover = lambda s: {*range(0, len(s) - 2, 3), *([len(s) - 3] if len(s) > 2 else [])}
    return _tidy(frozenset(frozenset(s[i : i + 3] for i in cover(s)) for s in literals))


def _walk(nodes) -> tuple[set[str] | None, Query]:
    """The strings a sequence can match, if few, and what any match must hold."""
    exact, open_, query = True, {""}, ALWAYS
    for op, arg in nodes:
        found: set[str] | None = None
        inner = ALWAYS
        if op is sre.LITERAL:
            found = {chr(arg).lower()}
        elif op is sre.IN:
            chars: set[str] = set()
            for kind, value in arg:
                if kind is sre.LITERAL:
                    chars.add(chr(value).lower())
                elif kind is sre.RANGE and value[1] - value[0] < 8:
                    chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
                else:
                    chars |= {chr(c) for c in range(99)}
            found = chars if len(chars) <= 8 else None
        elif op is sre.SUBPATTERN:
            found, inner = _walk(arg[3])
        elif op is sre.BRANCH:
            parts = [_walk(x) for x in arg[1]]
            if all(p[0] is not None for p in parts):
                found = set().union(*(p[0] for p in parts))
            else:
                inner = _tidy(frozenset().union(*(p[1] if p[0] is None else _of_literals(p[0]) for p in parts)))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, body = arg
            found, inner = _walk(body)
            if (least, most) == (0, 1) and found is not None:
                found = found | {""}
            elif (least, most) != (1, 1):
                inner = ALWAYS if least == 0 else inner if found is None else _of_literals(found)
                found = None
        elif op is sre.AT:
            found = {""}
        if found is not None and len(open_) * len(found) <= MOST_LITERALS:
            open_ = {a + b for a in open_ for b in found}
            continue
        query = _both(_both(query, _of_literals(open_)), inner)
        exact = exact and found is not None
        open_ = found if found is not None else {""}
        exact = False
    if exact:
        return open_, _of_literals(open_)
    return None, _both(query, _of_literals(open_))


def trigram_query(pattern: str) -> Query | None:
    """Alternatives of trigrams (of lower-cased text) that a match needs; None: scan fully."""
    query = _walk(sre_parser.parse(pattern))[1]
    return None if frozenset() in query else query


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The index: one row (trigram, text_hash) for each of ``trigrams`` that a text holds.

    ``lower`` keeps every lower-cased ASCII run, so no match is missed.
    """
    # The outer transform binds the lower-cased text: without it, each trigram would
    # have the whole text lower-cased anew.
    held = F.flatten(
        F.transform(
            F.array(F.lower("text")),
            lambda low: F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in trigrams]),
        )
    )
    rows = docs.select(F.xxhash64("text").alias("text_hash"), F.explode(F.array_compact(held)).alias("trigram"))
    return rows.distinct()


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(text_hash, kinds): the rules whose Boolean trigram query the text meets."""
    wanted = [
        (rule.kind, i, t, len(alternative))
        for rule in rules
        if (query := trigram_query(rule.pattern)) is not None
        for i, alternative in enumerate(sorted(query, key=sorted))
        for t in sorted(alternative)
    ]
    spark = docs.sparkSession
    terms = spark.createDataFrame(wanted, "kind string, alternative int, trigram string, needed bigint")
    found = postings(docs, sorted({t for _, _, t, _ in wanted}))
    # Broadcast bound: the terms of the rules, a few hundred rows whatever the corpus.
    met = (
        found.join(F.broadcast(terms), "trigram")
        .groupBy("text_hash", "kind", "alternative", "needed")
        .agg(F.count("*").alias("held"))
        .filter("held = needed")
    )
    return met.groupBy("text_hash").agg(F.collect_set("kind").alias("kinds"))


def _spans(rule: Rule, at: int, text: Column) -> Column:
    """Array of (start, kind order, end, kind), leftmost and non-overlapping; code points."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    sized = whole if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    step = F.zip_with(
        F.slice(between, F.lit(1), F.size(whole)), whole, lambda a, b: (F.length(a) + F.length(b)).cast("bigint")
    )
    placed = F.zip_with(
        F.arrays_zip(whole.alias("w"), sized.alias("g")),
        running_sum(step),
        lambda m, end: F.struct(
            (end - F.length(m["w"])).alias("start"),
            F.lit(at).alias("rank"),
            end.alias("end"),
            F.lit(rule.kind).alias("kind"),
            F.length(m["g"]).alias("size"),
        ),
    )
    kept = F.filter(placed, lambda s: s["size"] >= rule.least)
    return F.transform(kept, lambda s: s.dropFields("size"))


NO_SPANS = "CAST(array() AS array<struct<start:bigint,rank:int,end:bigint,kind:string>>)"


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id and ``spans``, an array of (start, rank, end, kind).

    Sorted by start, then by the rules' order. Offsets are code points, the end is
    exclusive. A null text is an empty one; rows with null or repeated ids each get
    their own result; an empty table gives no rows; other columns are not read.
    """
    texts = id_and_text(docs, id_col, text_col)
    found = candidates(texts, rules).withColumnRenamed("text_hash", "found_hash")
    joined = texts.join(found.hint("shuffle_hash"), F.xxhash64("text") == F.col("found_hash"), "left")
    none = F.expr(NO_SPANS)
    parts = {}
    for at, rule in enumerate(rules):
        if trigram_query(rule.pattern) is None:
            # A full scan; texts without a long enough run are not cut into pieces.
            chosen = F.regexp_like("text", F.lit(f"{rule.pattern}(?<={rule.pattern[:-1]}{{{rule.least}}})"))
        else:
            chosen = F.array_contains("kinds", rule.kind)
        parts[f"__{rule.kind}"] = F.when(chosen, _spans(rule, at, F.col("text"))).otherwise(none)
    return joined.select("doc_id", *[c.alias(n) for n, c in parts.items()]).select(
        "doc_id", F.array_sort(F.flatten(F.array(*parts))).alias("spans")
    )


def joined_spans(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def digest(docs: DataFrame) -> DataFrame:
    """The registered query's columns."""
    base = F.filter("spans", lambda s: s["rank"] < len(BASE_RULES))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return scan(docs).select(
        "doc_id",
        *[count(r.kind) for r in BASE_RULES],
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"),
    )
