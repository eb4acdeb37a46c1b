"""URL filter: host rules first, then a weighted vocabulary counted by an Aho-Corasick automaton."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.llm.common import extra_name, query, table

# The vocabulary. One strict term rejects, soft terms only together.
STRICT_TERMS = ("porn", "xxx", "hentai", "escort", "camgirls", "warez", "viagra", "casino-win")
SOFT_TERMS = (
    "adult", "bet", "bonus", "casino", "cheap", "crack", "dating", "free", "jackpot", "loan",
    "lottery", "nude", "pills", "poker", "replica", "sex", "slots", "torrent", "win",
)
SOFT_LIMIT = 2

# Fixed values: (host, path, verdict) of the query's rules.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_struct(host: Column, path: Column, rules: Iterable[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null without one. Longer hosts win ties."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]))):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        entry = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        best = F.when(fits, entry).otherwise(best)
    return best


class TermCounter:
    """Counts distinct strict and soft terms that stand between non-alphanumeric ASCII characters."""

    def __init__(self, strict: tuple[str, ...], soft: tuple[str, ...]):
        self.automaton = ahocorasick.Automaton()
        for term in dict.fromkeys((*strict, *soft)):
            self.automaton.add_word(term, (term, term in strict))
        self.empty = not len(self.automaton)
        self.automaton.make_automaton()

    def hits(self, text: str) -> tuple[int, int]:
        strict, soft = set(), set()
        for end, (term, is_strict) in () if self.empty else self.automaton.iter(text):
            start = end - len(term)
            if (start < 0 or not _inside(text[start])) and not _inside(text[end + 1 : end + 2]):
                (strict if is_strict else soft).add(term)
        return len(strict), len(soft)


def _inside(character: str) -> bool:
    return character.isascii() and character.isalnum()


def judge_urls(
    pages: DataFrame,
    url: str = "url",
    rules: Iterable[tuple[str, str, str]] = RULES,
    strict: tuple[str, ...] = STRICT_TERMS,
    soft: tuple[str, ...] = SOFT_TERMS,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """Adds host, path, rule, verdict, strict_hits and soft_hits; replaces columns of those names.

    A rule decides where one fits. Otherwise a URL is blocked by one strict term or by `soft_limit`
    distinct soft terms. Terms are looked up in the whole URL, A-Z in lower case, with boundary
    checks. A null or empty URL has an empty host and path, no rule and no hits: it is allowed.
    Repeated rows are judged alike. Nothing is shuffled.
    """
    rules = tuple(rules)

    @F.pandas_udf("strict_hits long, soft_hits long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = TermCounter(strict, soft)
        for urls in batches:
            yield pd.DataFrame([counter.hits(u) for u in urls], columns=["strict_hits", "soft_hits"])

    hits, ruled, address = (extra_name(pages, n) for n in ("_hits", "_ruled", "_address"))
    found = pages.withColumn(address, F.coalesce(F.col(url), F.lit("")))
    found = found.withColumn(hits, count(F.translate(F.col(address), UPPER, LOWER)))
    found = found.withColumns({"host": host_of(F.col(address)), "path": path_of(F.col(address))})
    found = found.withColumn(ruled, rule_struct(F.col("host"), F.col("path"), rules))
    bad = (F.col(f"{hits}.strict_hits") > 0) | (F.col(f"{hits}.soft_hits") >= soft_limit)
    return found.withColumns(
        {
            "rule": F.col(f"{ruled}.rule"),
            "verdict": F.coalesce(
                F.col(f"{ruled}.verdict"), F.when(bad, F.lit("block")).otherwise(F.lit("allow"))
            ),
            "strict_hits": F.col(f"{hits}.strict_hits"),
            "soft_hits": F.col(f"{hits}.soft_hits"),
        }
    ).drop(hits, ruled, address)


def _sql() -> str:
    def hits(terms: tuple[str, ...]) -> str:
        each = (f"regexp_matches(u, '(^|[^a-z0-9]){t}($|[^a-z0-9])')::INT" for t in terms)
        return "(" + " + ".join(each) + ")::BIGINT"

    ranked = sorted(RULES, key=lambda r: (-len(r[0] + r[1]), -len(r[0])))

    def case(value: int | None) -> str:
        whens = " ".join(
            f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') "
            f"THEN '{h + p if value is None else v}'"
            for h, p, v in ranked
        )
        return f"CASE {whens} END"

    lowered = f"translate(coalesce(url, ''), '{UPPER}', '{LOWER}')"
    return f"""
    WITH parts AS (
        SELECT page_id, {lowered} AS u,
               translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
               coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages),
    counted AS (
        SELECT *, {hits(STRICT_TERMS)} AS strict_hits, {hits(SOFT_TERMS)} AS soft_hits FROM parts)
    SELECT page_id, host, path, {case(None)} AS rule,
           coalesce({case(1)}, CASE WHEN strict_hits > 0 OR soft_hits >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END)
             AS verdict,
           strict_hits, soft_hits
    FROM counted"""


@query("op9_url_filter", _sql())
def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every page's URL."""
    judged = judge_urls(table(spark, folder, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits")
