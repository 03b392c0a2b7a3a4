"""URL filters: site rules by host and path, and pattern rules behind a token index.

A pattern is literal text with ``*`` (anything), ``^`` (a separator or the end) and a leading
``||`` (the start of a host name); a leading ``@@`` makes it an exception. It is matched without
regard to A-Z case. Each pattern is filed under that of its whole tokens which is rarest among
the URLs given, and its regular expression only runs on URLs that hold the token. A pattern
without a whole token is filed under the empty token, which every URL holds.

Only DataFrame functions: no Python runs in tasks.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellstar.llm.shared import by_place

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST_AND_PATH = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Site rules of the query: (verdict, host, path).
SITES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)
#: Pages that carry no prose worth training on, by the shape of their URL.
PATTERNS = (
    "/login^", "/signin^", "/sign-in^", "/logout^", "/register^", "/wp-login.php", "/wp-admin^", "/cgi-bin/",
    "/cart^", "/checkout^", "/basket^", "^sessionid=", "^utm_source=", "^replytocom=", "/search?", "/feed^",
    "||ads.", "||ad.", "||tracker.", "||casino*.", "/porn^", "/xxx^", "/casino^", "/poker^", "/calendar/*/day/",
    ".exe^", ".zip^", ".jpg^", ".png^", ".gif^", ".mp4^", ".pdf^", "@@/search/help^", "@@||docs.*/login^",
)


def pattern_regex(pattern: str) -> str:
    """The regular expression of a pattern, over a lower-cased URL."""
    body = pattern.removeprefix("@@").lower()
    head = ""
    if body.startswith("||"):
        head, body = r"^[a-z][a-z0-9+.-]*://([^/?#]*[.@])?", body[2:]
    special = {"*": ".*", "^": "([^a-z0-9_.%-]|$)"}
    return "(?s)" + head + "".join(special.get(c) or (c if c.isalnum() else re.escape(c)) for c in body)


def pattern_tokens(pattern: str) -> list[str]:
    """Tokens that a URL must hold whole to match: bounded on both sides by something that ends a token."""
    body = pattern.removeprefix("@@").lower()
    return sorted(set(re.findall(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])", body)))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, HOST_AND_PATH, 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, HOST_AND_PATH, 2), F.lit(""))


def site_rule(at_host: Column, at_path: Column, sites: Sequence[tuple[str, str, str]]) -> Column:
    """struct(verdict, rule) of the longest site rule that fits, or null."""
    cases = []
    for verdict, site, start in sorted(sites, key=lambda r: -len(r[1] + r[2])):
        fits = ((at_host == site) | at_host.endswith(f".{site}")) & at_path.startswith(start)
        cases.append(F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(site + start).alias("rule"))))
    return F.coalesce(*cases)


def _rules(frame: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """The patterns as a local relation, a row per token (the empty one if there is no other)."""
    rows = [
        {"pattern": p, "regex": pattern_regex(p), "allow": p.startswith("@@"), "token": t}
        for p in dict.fromkeys(patterns) for t in pattern_tokens(p) or [""]
    ]
    schema = pa.schema([("pattern", pa.string()), ("regex", pa.string()), ("allow", pa.bool_()), ("token", pa.string())])
    return frame.sparkSession.createDataFrame(
        pa.Table.from_pylist(rows, schema=schema), "pattern string, regex string, allow boolean, token string"
    )


def matched_patterns(urls: DataFrame, patterns: Sequence[str] = PATTERNS) -> DataFrame:
    """(url, blocked, pattern) of each distinct url that a pattern matches; an exception wins over a block."""
    low = lower_ascii(F.col("url"))
    tokens = F.array_distinct(F.concat(F.array(F.lit("")), F.split(low, "[^a-z0-9]+")))
    held = urls.select("url").where("url is not null").distinct().select("url", F.explode(tokens).alias("token"))
    rules = _rules(urls, patterns)
    often = held.join(rules.select("token").distinct(), "token").groupBy("token").count()
    rarest = F.min_by("token", F.struct(F.coalesce("count", F.lit(0)), "token"))
    index = rules.join(often, "token", "left").groupBy("pattern", "regex", "allow").agg(rarest.alias("token"))
    found = held.join(index, "token").where(F.expr(f"rlike(translate(url, '{UPPER}', '{LOWER}'), regex)"))
    best = F.max(F.struct("allow", "pattern")).alias("best")
    return found.groupBy("url").agg(best).select("url", (~F.col("best.allow")).alias("blocked"), "best.pattern")


def judge(
    pages: DataFrame, sites: Sequence[tuple[str, str, str]] = SITES, patterns: Sequence[str] = PATTERNS,
    url_column: str = "url",
) -> DataFrame:
    """``pages`` with host, path, rule, pattern and verdict added (replacing columns so named).

    The longest site rule decides; without one, a matching pattern blocks unless an exception matches,
    and everything else is allowed. A null or empty url, or one without ``://``, has empty host and path
    and no site rule; a null url is allowed. Repeated rows stay and are judged alike. Columns of the
    input that have one of the added names are replaced; others may have any name.
    """
    added = ("host", "path", "rule", "verdict", "pattern")
    names = [c for c in pages.columns if c not in added]
    rows = by_place(pages)
    rest = [F.col(f"c{k}") for k, c in enumerate(pages.columns) if c not in added]
    named = rows.select(*rest, F.col(f"c{pages.columns.index(url_column)}").alias("__url"))
    hits = matched_patterns(named.select(F.col("__url").alias("url")), patterns)
    hits = hits.select(F.col("url").alias("__hit"), F.col("blocked").alias("__blocked"), F.col("pattern").alias("__pattern"))
    joined = named.join(hits, F.col("__url") == F.col("__hit"), "left")
    rule = site_rule(host(F.col("__url")), path(F.col("__url")), sites)
    by_pattern = F.when(F.col("__blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return joined.select(
        *rest, host(F.col("__url")).alias("host"), path(F.col("__url")).alias("path"), rule["rule"].alias("rule"),
        F.coalesce(rule["verdict"], by_pattern).alias("verdict"), F.col("__pattern").alias("pattern"),
    ).toDF(*names, *added)


def oracle() -> str:
    """The query's rows as DuckDB SQL, every pattern tried on every URL."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    fits, verdicts = [], []
    for verdict, site, start in sorted(SITES, key=lambda r: -len(r[1] + r[2])):
        test = (
            f"(host = {quoted(site)} or ends_with(host, {quoted('.' + site)})) and starts_with(path, {quoted(start)})"
        )
        fits.append(f"when {test} then {quoted(site + start)}")
        verdicts.append(f"when rule = {quoted(site + start)} then {quoted(verdict)}")
    low = f"translate(url, '{UPPER}', '{LOWER}')"
    tests = {allow: " or ".join(
        f"regexp_matches({low}, {quoted(pattern_regex(p))})" for p in PATTERNS if p.startswith("@@") == allow
    ) for allow in (False, True)}
    return f"""
        with parts as (
            select page_id, url, translate(coalesce(regexp_extract(url, {quoted(HOST_AND_PATH)}, 1), ''), '{UPPER}', '{LOWER}') as host,
                   coalesce(regexp_extract(url, {quoted(HOST_AND_PATH)}, 2), '') as path
            from pages
        ), ruled as (select *, case {' '.join(fits)} end as rule from parts)
        select page_id, host, path, rule,
               case {' '.join(verdicts)} when ({tests[True]}) then 'allow' when ({tests[False]}) then 'block' else 'allow' end as verdict
        from ruled
    """
