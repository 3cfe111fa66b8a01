"""URL filters by pattern rules.

A rule is a host (it and all its subdomains), the start of a path, in which ``*`` stands for any
run of characters, and a verdict. Each rule becomes a regular expression over ``host + path`` and
is indexed under its rarest literal token: the tokens are the whole ASCII words of the rule, the
rarest is the one fewest rules hold. A url fetches the rules indexed under its own tokens, and only
those run their expressions; the longest fitting rule wins.

All of it is built-in expressions. Up to `INLINE_RULES` rules the index is a constant inside the
plan and urls are judged where they are read, without a shuffle. A longer list is joined by token
to the different urls, broadcast only if its size is known to be small; same rows either way.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.operators.joins import attach

ALLOW, BLOCK = "allow", "block"
#: Rules up to which the index is part of the plan (a lookup there reads the index in order).
INLINE_RULES = 256

_RULE = "struct<rule:string,verdict:string,pattern:string,size:int,host_size:int>"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("com", "/", ALLOW),
    Rule("example.com", "/en/", BLOCK),
    Rule("www.example.com", "/en/", ALLOW),
    Rule("net", "/es/", BLOCK),
    Rule("net", "/fr/", BLOCK),
)


def rule_regex(rule: Rule) -> str:
    """Over host + path: the host ends at the first slash or at the end."""
    host, path = rule.host.lower(), rule.path
    parts = [re.sub(r"([^A-Za-z0-9/])", r"\\\1", p) for p in path.split("*")]
    end = "(?:/|$)" if not path else ""
    lead = "" if not path or path.startswith(("/", "*")) else "(?!)"
    dotted = host.replace("\\", "\\\\").replace(".", "\\.")
    return f"(?s)^(?:[^/]*\\.)?{dotted}{end}{lead}{'.*'.join(parts)}"


def rule_tokens(rule: Rule) -> set[str]:
    """Words that every fitting url holds as whole words."""
    marked = f".{rule.host.lower()}{rule.path or '/'}"
    found = set()
    for match in re.finditer(r"[A-Za-z0-9]+", marked):
        closed = match.end() < len(marked) and marked[match.end()] != "*"
        if closed and marked[match.start() - 1] != "*":
            found.add(match.group())
    return found


def rule_index(rules: Sequence[Rule]) -> dict[str, list[dict]]:
    """Rules by their rarest token; those without a token under the empty one."""
    tokens = [rule_tokens(rule) for rule in rules]
    rules_with = Counter(token for own in tokens for token in own)
    index: dict[str, list[dict]] = {}
    for rule, own in zip(rules, tokens, strict=True):
        rarest = min(own, key=lambda t: (rules_with[t], -len(t), t), default="")
        index.setdefault(rarest, []).append({
            "rule": rule.text, "verdict": rule.verdict, "pattern": rule_regex(rule),
            "size": len(rule.text), "host_size": len(rule.host),
        })
    return index


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for urls without ``://``."""
    start = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(
        F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "abcdefghijklmnopqrstuvwxyz",
    )
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return host, path


def _tokens(subject: Column) -> Column:
    """Different words of a url, and the empty one that fetches rules without a token."""
    return F.array_distinct(
        F.concat(F.array(F.lit("")), F.regexp_extract_all(subject, F.lit("[A-Za-z0-9]+"), 0))
    )


def _order(rule: Column) -> Column:
    """Longest first; then the longer host, block before allow, and the text of the rule."""
    return F.struct(
        rule["size"].alias("size"), rule["host_size"].alias("host_size"),
        rule["verdict"].alias("verdict"), rule["rule"].alias("rule"),
    )


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    url_col: str = "url",
    keep: Sequence[str] = ("page_id",),
    default: str = ALLOW,
    inline_rules: int = INLINE_RULES,
) -> DataFrame:
    """`keep` columns of every row, with host, path, rule and verdict.

    Urls that no rule fits, null, empty and broken ones included, have a null rule and the
    `default` verdict. Repeated rows each get their verdict; other columns are not read; an empty
    table or an empty rule list is fine.
    """
    host, path = url_parts(F.col(url_col))
    parts = pages.select(*keep, host.alias("host"), path.alias("path"))
    index = rule_index(rules)
    if len(rules) <= inline_rules:
        best = _best_inline(parts, index)
    else:
        best = _best_joined(parts, index)
    return best.select(
        *keep, "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict"),
    )


def _best_inline(parts: DataFrame, index: dict[str, list[dict]]) -> DataFrame:
    known = F.from_json(F.lit(json.dumps(index)), f"map<string,array<{_RULE}>>")
    subject = F.concat("host", "path")
    fetched = F.flatten(F.filter(
        F.transform(_tokens(subject), lambda token: F.try_element_at(known, token)),
        lambda rules: rules.isNotNull(),
    ))
    fitting = F.filter(fetched, lambda rule: F.regexp_like(subject, rule["pattern"]))
    return parts.withColumn("_best", F.array_max(F.transform(fitting, _order)))


def _best_joined(parts: DataFrame, index: dict[str, list[dict]]) -> DataFrame:
    spark = parts.sparkSession
    flat = [{"token": token, **rule} for token, rules in index.items() for rule in rules]
    schema = "array<struct<token:string," + _RULE.removeprefix("struct<").removesuffix(">") + ">>"
    rules = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(flat)), schema)))
    urls = parts.select("host", "path").distinct()
    asked = urls.withColumn("token", F.explode(_tokens(F.concat("host", "path"))))
    best = (
        attach(asked, rules, "token", "inner")
        .where(F.regexp_like(F.concat("host", "path"), F.col("pattern")))
        .groupBy("host", "path")
        .agg(F.max(_order(F.struct("size", "host_size", "verdict", "rule"))).alias("_best"))
    )
    return parts.join(best, ["host", "path"], "left")
