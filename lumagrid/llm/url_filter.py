"""URL filter: site rules, then weighted terms found by an Aho-Corasick automaton."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumagrid.llm.common import LOWER, UPPER, kept_in_worker

# A strict term rejects a url by itself.
STRICT_TERMS = [
    "porn", "porno", "pornography", "xxx", "xvideos", "hentai", "nsfw", "milf",
    "camgirl", "camgirls", "sexcam", "sexcams", "escorts", "warez", "keygen",
]
# Soft terms reject a url when the weights of the distinct ones reach SOFT_LIMIT.
SOFT_TERMS = {
    "sex": 1.0, "sexy": 1.0, "nude": 1.0, "naked": 1.0, "adult": 1.0, "erotic": 1.0,
    "fetish": 1.0, "dating": 0.5, "webcam": 0.5, "casino": 1.0, "poker": 0.5, "betting": 1.0,
    "bet": 0.5, "slots": 1.0, "gambling": 1.0, "viagra": 1.0, "cialis": 1.0, "torrent": 0.5,
    "crack": 0.5, "hookup": 1.0,
}
SOFT_LIMIT = 2.0
# Terms of a vocabulary from a table, which every task holds.
MAX_TERMS = 1_000_000
# (host, path, verdict): holds for the host and its subdomains and paths that start so.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
_FOLD = str.maketrans(UPPER, LOWER)


def url_host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def build_automaton(strict: list[str], soft: dict[str, float]) -> ahocorasick.Automaton:
    """An automaton over all terms; each carries (term, strict or not, weight).

    A term in both lists is strict. Terms are lower-cased like urls; empty ones are left out.
    """
    automaton = ahocorasick.Automaton()
    for term, weight in soft.items():
        if term:
            automaton.add_word(term.translate(_FOLD), (term.translate(_FOLD), False, weight))
    for term in strict:
        if term:
            automaton.add_word(term.translate(_FOLD), (term.translate(_FOLD), True, 0.0))
    if len(automaton):
        automaton.make_automaton()
    return automaton


def find_terms(automaton: ahocorasick.Automaton, url: str | None) -> tuple[list[str], dict]:
    """The distinct strict terms and the distinct soft ones with weights, in ``url``.

    A term counts where neither the character before nor the one after it is a letter
    or a digit.
    """
    strict, soft = [], {}
    if not url or not len(automaton):
        return strict, soft
    text = url.translate(_FOLD)
    for end, (term, is_strict, weight) in automaton.iter(text):
        start = end - len(term)
        if (start >= 0 and text[start].isalnum()) or text[end + 1 : end + 2].isalnum():
            continue
        if is_strict:
            if term not in strict:
                strict.append(term)
        else:
            soft[term] = weight
    return sorted(strict), soft


def vocabulary_of(terms: DataFrame, most: int = MAX_TERMS) -> tuple[list[str], dict[str, float]]:
    """Strict and soft terms of a table ``(term, strict, weight)``, as ``filter_urls`` takes them.

    A null ``strict`` is false, a null weight 1; of a soft term's weights the largest counts. Every
    task holds all terms, so a table of more than ``most`` is refused. Null terms are left out.
    """
    rows = (
        terms.where(F.col("term").isNotNull())
        .groupBy("term", F.coalesce("strict", F.lit(False)).alias("strict"))
        .agg(F.max(F.coalesce(F.col("weight").cast("double"), F.lit(1.0))).alias("weight"))
        .limit(most + 1)
        .collect()
    )
    if len(rows) > most:
        raise ValueError(f"a vocabulary has at most {most} terms")
    return sorted(r.term for r in rows if r.strict), {r.term: r.weight for r in rows if not r.strict}


def rule_tables(rules: list[tuple[str, str, str]]) -> dict[str, list[tuple[str, str, str]]]:
    """Rules by host, those with the longest path first."""
    by_host: dict = {}
    for host, path, verdict in rules:
        by_host.setdefault(host.translate(_FOLD), []).append((path, host + path, verdict))
    for found in by_host.values():
        found.sort(key=lambda x: -len(x[0]))
    return by_host


def find_rule(by_host: dict, host: str, path: str) -> tuple[str | None, str | None]:
    """The longest rule that fits, as (rule, verdict); of equally long ones that of the longer host."""
    best: tuple[str | None, str | None] = (None, None)
    while host:
        for prefix, rule, verdict in by_host.get(host, ()):
            if path.startswith(prefix):
                if best[0] is None or len(rule) > len(best[0]):
                    best = (rule, verdict)
                break
        host = host.partition(".")[2]
    return best


def filter_urls(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    rules: list[tuple[str, str, str]] = RULES,
    strict: list[str] = STRICT_TERMS,
    soft: dict[str, float] = SOFT_TERMS,
    soft_limit: float = SOFT_LIMIT,
) -> DataFrame:
    """``(key, host, path, rule, verdict, strict_terms, soft_terms, soft_weight)`` for each row.

    The verdict is that of the longest fitting rule. Without one, ``block`` if a strict
    term occurs or the distinct soft terms weigh ``soft_limit`` or more, else ``allow``.
    Terms are given, or come from a table (``vocabulary_of``).
    A null url, one without ``://`` and an empty one have an empty host and path; a null or
    empty one is allowed. Repeated rows are judged each for itself; an empty table gives an
    empty result; other columns are not read. Rows are judged where they lie, without a
    shuffle, and urls of any length are searched whole.
    """
    by_host, call = rule_tables(rules), uuid.uuid4().hex
    terms = pages.sparkSession.sparkContext.broadcast((list(strict), dict(soft)))

    @F.pandas_udf(
        "rule string, verdict string, strict_terms array<string>, "
        "soft_terms array<string>, soft_weight double"
    )
    def judge(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        automaton = kept_in_worker("url terms", call, lambda: build_automaton(*terms.value))
        for urls, hosts, paths in parts:
            rows = []
            for u, h, p in zip(urls, hosts, paths, strict=True):
                hard, mild = find_terms(automaton, u)
                weight = float(sum(mild[t] for t in sorted(mild)))
                rule, verdict = find_rule(by_host, h, p)
                if rule is None:
                    verdict = "block" if hard or (mild and weight >= soft_limit) else "allow"
                rows.append((rule, verdict, hard, sorted(mild), weight))
            yield pd.DataFrame(
                rows, columns=["rule", "verdict", "strict_terms", "soft_terms", "soft_weight"]
            )

    base = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"))
    base = base.select("*", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    judged = base.withColumn("found", judge("url", "host", "path"))
    return judged.select(F.col("key").alias(key), "host", "path", "found.*")
