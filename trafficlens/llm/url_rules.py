"""URL filtering by pattern rules indexed by their rarest literal token, DataFrame operations only.

A rule carries the whole tokens (runs of a-z, 0-9) that every URL it fits must hold. The rarest of
them, by counts over all URLs of the input, is its key in an index of buckets. A URL's distinct
tokens fetch the rules under their keys; only those run their regular expressions. The index is a
constant of the plan (at most ``MAX_RULES`` rules, else an error), so judging needs no shuffle.

Two kinds of rules: listed rules (a host with a path prefix) and patterns (the method's own). The
longest fitting listed rule decides; without one a fitting pattern blocks; else the URL is allowed.
Null URLs and URLs without ``://`` have empty host and path and are allowed unless a pattern fits.
Repeated rows are judged each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.common import table

MAX_RULES = 20_000
LISTED = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Pages without running text: the tokens that a URL must hold, and the expression over the lower-cased URL.
PATTERNS = (
    (("login",), r"/(?:user/)?login(?:[/?#.]|$)"),
    (("signup",), r"/signup(?:[/?#.]|$)"),
    (("cart",), r"/cart(?:[/?#.]|$)"),
    (("checkout",), r"/checkout(?:[/?#.]|$)"),
    (("wp", "admin"), r"/wp-admin(?:[/?#]|$)"),
    (("search", "q"), r"/search/?\?(?:[^#]*&)?q="),
    (("casino",), r"^[a-z]+://[^/?#]*\bcasino\b"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE = "struct<literal:string,listed:boolean,size:int,rule:string,verdict:string,regex:string>"


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    regex: str
    listed: bool
    tokens: tuple[str, ...] = field(default=())


def listed_rule(verdict: str, name: str) -> Rule:
    """A rule like ``example.org/en/1``: its host, all subdomains, and paths that start alike."""
    host, slash, path = name.partition("/")
    # Path pieces count as whole tokens only between two separators; the last may go on in the URL.
    pieces = [t for t in re.split(r"[^a-z0-9]+", host) if t]
    inner = (slash + path).lower()
    pieces += [m for m in re.findall(r"(?<=[^a-z0-9])[a-z0-9]+(?=[^a-z0-9])", inner)]
    return Rule(name, verdict, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + path)}", True, tuple(pieces))


def rules_of(listed=LISTED, patterns=PATTERNS) -> list[Rule]:
    found = [listed_rule(*r) for r in listed]
    return found + [Rule(regex, "block", regex, False, tuple(tokens)) for tokens, regex in patterns]


def host_of(url: Column) -> Column:
    after = F.instr(url, "://")
    rest = F.substr(url, after + 3)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.when(after > 0, F.translate(host, UPPER, LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    after = F.instr(url, "://")
    rest = F.substr(url, after + 3)
    return F.when(after > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.split(F.lower(F.coalesce(url, F.lit(""))), r"[^a-z0-9]+"))


def token_counts(urls: DataFrame, url: Column, tokens: set[str]) -> dict[str, int]:
    """How many URLs hold each of the rules' tokens. At most as many rows as there are such tokens."""
    if not tokens:
        return {}
    known = F.array(*[F.lit(t) for t in sorted(tokens)])
    seen = urls.select(F.explode(F.array_intersect(url_tokens(url), known)).alias("token"))
    return {r["token"]: r["n"] for r in seen.groupBy("token").agg(F.count("*").alias("n")).collect()}


def rule_index(rules: list[Rule], counts: dict[str, int]) -> tuple[Column, int]:
    """Buckets of rules, by the CRC of each rule's rarest token; rules without a token stand under ''."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} fit into the plan")
    width = max(16, 2 * len(rules))
    buckets: list[list[Column]] = [[] for _ in range(width)]
    for r in rules:
        literal = min(r.tokens, key=lambda t: (counts.get(t, 0), -len(t), t), default="")
        row = F.struct(*[F.lit(v).alias(k) for k, v in (
            ("literal", literal), ("listed", r.listed), ("size", len(r.name)), ("rule", r.name), ("verdict", r.verdict), ("regex", r.regex))])
        buckets[zlib.crc32(literal.encode()) % width].append(row)
    return F.array(*[F.array(*b).cast(f"array<{RULE}>") for b in buckets]), width


def judge(urls: DataFrame, url_col: str = "url", rules: list[Rule] | None = None) -> DataFrame:
    """The input with host, path, rule (the deciding listed rule or null) and verdict."""
    rules = rules_of() if rules is None else rules
    url = F.col(f"`{url_col}`")
    index, width = rule_index(rules, token_counts(urls, url, {t for r in rules for t in r.tokens}))
    host, path = host_of(url), path_of(url)
    address, whole = F.coalesce(F.concat(host, path), F.lit("")), F.lower(F.coalesce(url, F.lit("")))

    def fetch(token: Column) -> Column:
        return F.filter(F.get(index, F.pmod(F.crc32(token.cast("binary")), F.lit(width)).cast("int")), lambda r: r["literal"] == token)

    tokens = F.array_union(url_tokens(url), F.array(F.lit("")))
    fetched = F.flatten(F.transform(tokens, fetch))
    fitting = F.filter(fetched, lambda r: F.rlike(F.when(r["listed"], address).otherwise(whole), r["regex"]))
    best = F.array_max(F.transform(fitting, lambda r: F.struct(r["listed"], r["size"], r["rule"], r["verdict"])))
    # An input column of one of these names gives way to the result.
    kept = urls.drop(*[c for c in ("host", "path", "rule", "verdict") if c != url_col])
    found = kept.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit("")), "_best": best})
    return found.withColumns({
        "rule": F.when(F.col("_best.listed"), F.col("_best.rule")),
        "verdict": F.coalesce(F.col("_best.verdict"), F.lit("allow")),
    }).drop("_best")


def _sql() -> str:
    ranked = sorted(LISTED, key=lambda r: (len(r[1]), r[1]), reverse=True)
    fits = []
    for verdict, name in ranked:
        host, _, path = name.partition("/")
        fits.append((f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')", name, verdict))
    rule = " ".join(f"WHEN {test} THEN '{name}'" for test, name, _ in fits)
    verdict = " ".join(f"WHEN {test} THEN '{v}'" for test, _, v in fits)
    pattern = " OR ".join(f"regexp_matches(lower(coalesce(url, '')), '{regex}')" for _, regex in PATTERNS)
    return f"""WITH cut AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut)
SELECT page_id, host, path, CASE {rule} END AS rule,
       CASE {verdict} WHEN {pattern} THEN 'block' ELSE 'allow' END AS verdict FROM parts"""


ORACLE = _sql()


def op6_url_filters(spark, folder: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page's URL."""
    return judge(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")
