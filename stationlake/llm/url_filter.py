"""URL filter: prefix rules, then a weighted vocabulary counted with Aho-Corasick.

A rule ``host/path`` fits its host and all subdomains if the url's path starts with the
rule's; the longest fitting rule decides.  Other urls are judged by the vocabulary: one
automaton over all terms runs once along the lower-cased url; an occurrence counts if the
characters before and after it are no ASCII letters or digits.  One strict term, or
``soft_hits`` distinct soft terms, block the url.

Edge cases: a null url, or one without ``://``, has an empty host and path, fits no rule and
is judged by the vocabulary on its text (null: allow).  Repeated rows are judged each for
itself; an empty table gives an empty result; other columns of the table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The rules of the contract.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/")]

STRICT = ["adult", "casino", "escort", "hentai", "malware", "phishing", "pills", "porn", "spam", "viagra", "warez",
          "xxx"]
SOFT = ["ads", "bets", "bonus", "cheap", "crack", "dating", "deal", "farm", "free", "jackpot", "loan", "poker",
        "promo", "track", "win"]
SOFT_HITS = 2
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


class Vocabulary:
    """Strict and soft terms in one Aho-Corasick automaton."""

    def __init__(self, strict: list[str] = STRICT, soft: list[str] = SOFT, soft_hits: int = SOFT_HITS) -> None:
        import ahocorasick

        self.soft_hits = soft_hits
        self.automaton = ahocorasick.Automaton()
        for kind, terms in (("soft", soft), ("strict", strict)):
            for t in terms:
                self.automaton.add_word(t.lower(), (kind, t.lower()))
        self.automaton.make_automaton()

    def hits(self, url: str | None) -> tuple[int, int]:
        """The numbers of distinct strict and distinct soft terms."""
        s = (url or "").translate(LOWER)
        strict, soft = set(), set()
        inside = lambda c: c.isascii() and c.isalnum()
        for end, (kind, term) in self.automaton.iter(s):
            start = end + 1 - len(term)
            if start > 0 and inside(s[start - 1]) or end + 1 < len(s) and inside(s[end + 1]):
                continue
            (strict if kind == "strict" else soft).add(term)
        return len(strict), len(soft)

    def blocks(self, strict: int, soft: int) -> bool:
        return strict >= 1 or soft >= self.soft_hits


def split_url(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path; both empty for null or no ``://``."""
    u = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(u, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(u, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]] = RULES, strict: list[str] = STRICT,
                soft: list[str] = SOFT, soft_hits: int = SOFT_HITS) -> DataFrame:
    """page_id, host, path, rule, verdict, strict_hits, soft_hits of every page."""
    host, path = split_url(F.col("url"))
    df = pages.select("page_id", "url").select("page_id", "url", host.alias("host"), path.alias("path"))
    rule = verdict = F.lit(None).cast("string")
    for kind, r in sorted(rules, key=lambda x: len(x[1])):  # the longest is asked first
        h, p = r.split("/", 1)
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith("/" + p)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)

    @F.pandas_udf("strict_hits long, soft_hits long, blocked boolean")
    def counted(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        voc = Vocabulary(strict, soft, soft_hits)
        for urls in parts:
            h = [voc.hits(u) for u in urls]
            yield pd.DataFrame({"strict_hits": pd.Series([a for a, _ in h], dtype="int64"),
                                "soft_hits": pd.Series([b for _, b in h], dtype="int64"),
                                "blocked": pd.Series([voc.blocks(a, b) for a, b in h], dtype="bool")})

    return (df.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"),
                      counted(F.col("url")).alias("c"))
            .select("page_id", "host", "path", "rule",
                    F.coalesce("by_rule", F.when(F.col("c.blocked"), F.lit("block")).otherwise(F.lit("allow")))
                    .alias("verdict"), F.col("c.strict_hits").alias("strict_hits"),
                    F.col("c.soft_hits").alias("soft_hits")))


def oracle() -> str:
    """DuckDB SQL of the whole query, one regular expression a term."""
    edge = "[^a-z0-9]"
    u = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    one = lambda t: f"regexp_matches({u}, '(^|{edge}){t}($|{edge})')::INT"
    soft = " + ".join(one(t) for t in SOFT)
    strict = " + ".join(one(t) for t in STRICT)
    fit = lambda r: (f"(host = '{r.split('/', 1)[0]}' OR ends_with(host, '.{r.split('/', 1)[0]}'))"  # noqa: E731
                     f" AND starts_with(path, '/{r.split('/', 1)[1]}')")
    longest = sorted(RULES, key=lambda x: -len(x[1]))
    whens = " ".join(f"WHEN {fit(r)} THEN '{r}'" for _, r in longest)
    kinds = " ".join(f"WHEN {fit(r)} THEN '{k}'" for k, r in longest)
    return f"""
WITH p AS (SELECT page_id, url,
       translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
       regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
c AS (SELECT *, CAST({strict} AS BIGINT) AS strict_hits, CAST({soft} AS BIGINT) AS soft_hits FROM p)
SELECT page_id, host, path, CASE {whens} END AS rule,
       CASE {kinds} WHEN strict_hits >= 1 OR soft_hits >= {SOFT_HITS} THEN 'block' ELSE 'allow' END AS verdict,
       strict_hits, soft_hits FROM c"""
