"""URL filter: rules indexed by their rarest literal token (operator 10).

A rule is a regular expression over ``host + path + ?query`` together with the
literal tokens that every match must contain.  One Spark pass counts how often
the rules' tokens occur in the URLs; each rule is filed under its rarest token.
A URL's tokens then fetch the few candidate rules, and only those expressions
run.  Rules without a literal token are candidates for every URL.

The rule list is caller-given and travels to the tasks in blocks of
``BLOCK_RULES`` rules.  Blocks run one after the other, each keeping the better
of its own and the earlier match, so what is sent at once has a fixed bound
whatever the length of the list.  There is no shuffle of URLs, so a hot host
costs nothing.

``parse_rules`` reads lists in the usual blocker format: host anchors, wildcards,
separators, exceptions.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesmith.llm.common import UPPER, ascii_lower, col, kept_columns, staged

#: Most rules compiled and sent to a task at once.
BLOCK_RULES = 20_000

_TOKEN = re.compile(r"[0-9a-z]+")
_LOWER = str.maketrans(UPPER, UPPER.lower())

ADDED = ["host", "path", "rule", "pattern", "verdict"]


@dataclass(frozen=True)
class UrlRule:
    """``kind`` 0: host and path rule, 1: free pattern or exception, 2: pattern
    that exceptions overrule.  Lower kinds decide first, then the longer name."""
    name: str
    verdict: str
    regex: str
    literals: tuple[str, ...]
    kind: int = 1


def host_path_rule(name: str, verdict: str) -> UrlRule:
    """``example.com/en/``: the host, its subdomains, and paths that start so."""
    host, slash, rest = name.partition("/")
    host, path = host.translate(_LOWER), slash + rest
    literals = _TOKEN.findall(host)
    in_path = list(_TOKEN.finditer(path.translate(_LOWER)))
    # a token that ends the prefix may go on in the URL, so it is no whole token
    literals += [m.group() for m in in_path if m.end() < len(path)]
    edge = "" if path else r"(?=$|[/?#])"
    return UrlRule(name, verdict, rf"^(?:[^/?#]*\.)?{re.escape(host)}{edge}{re.escape(path)}", tuple(literals), 0)


def pattern_rule(name: str, verdict: str, regex: str, *literals: str) -> UrlRule:
    return UrlRule(name, verdict, regex, tuple(t.translate(_LOWER) for t in literals), 1)


def parse_rules(lines: Iterable[str], comment: str = "!") -> list[UrlRule]:
    """Rules of a blocker list: ``||host^`` holds for a host and its subdomains,
    ``|`` anchors a pattern's start or end, ``*`` stands for anything, ``^`` for a
    separator or the end, ``/.../`` is a regular expression, ``@@`` marks an exception.

    Blank lines and comments are passed over, and so are rules with options
    (``$``) or for page elements (``##``), which need more than a URL.
    """
    return [rule for line in lines if (rule := _parsed(line.strip(), comment)) is not None]


_SEPARATOR = r"(?:[^0-9A-Za-z_.%-]|$)"


def _parsed(line: str, comment: str) -> UrlRule | None:
    if not line or line.startswith((comment, "[")) or "##" in line or "#@#" in line:
        return None
    exception = line.startswith("@@")
    pattern = line[2:] if exception else line
    verdict, kind = ("allow", 1) if exception else ("block", 2)
    if len(pattern) > 2 and pattern.startswith("/") and pattern.endswith("/"):
        return UrlRule(line, verdict, "(?i)" + pattern[1:-1], (), kind)
    if "$" in pattern:
        return None
    host, start, end = pattern.startswith("||"), pattern.startswith("|"), pattern.endswith("|")
    body = re.sub(r"^https?://", "", pattern.lstrip("|").removesuffix("|")) if start else pattern.removesuffix("|")
    before = r"^(?:[^/?#]*\.)?" if host else "^" if start else ""
    regex = "".join({"*": ".*", "^": _SEPARATOR}.get(ch, re.escape(ch)) for ch in body)
    # a token is whole only between other characters, or at an anchored edge
    low = body.translate(_LOWER)
    literals = tuple(m.group() for m in _TOKEN.finditer(low)
                     if (low[m.start() - 1] != "*" if m.start() else start) and (low[m.end()] != "*" if m.end() < len(low) else end))
    return UrlRule(line, verdict, f"(?i){before}{regex}{'$' if end else ''}", literals, kind)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    return F.coalesce(F.when(F.instr(url, "://") > 0,
                             ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.when(F.instr(url, "://") > 0,
                             F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)), F.lit(""))


def _rest(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + 3, F.length(url))


def token_counts(urls: DataFrame, url_col: str, tokens: set[str]) -> dict[str, int]:
    """URLs that hold each rule token, counted over all rows; at most one row
    per token of the rule block comes back."""
    if not tokens:
        return {}
    spark = urls.sparkSession
    wanted = spark.createDataFrame([(t,) for t in sorted(tokens)], "token string")
    found = (urls.select(F.explode(F.array_distinct(F.split(ascii_lower(col(url_col)), "[^0-9a-z]+"))).alias("token"))
             .join(F.broadcast(wanted), "token").groupBy("token").count())
    return {r["token"]: r["count"] for r in found.collect()}


def filter_urls(urls: DataFrame, rules: list[UrlRule], url_col: str = "url", default: str = "allow") -> DataFrame:
    """All columns of ``urls`` plus host, path, rule, pattern and verdict.

    ``rule`` is the winning host and path rule (null if none), ``pattern`` the
    winning pattern rule where no host and path rule fits.  A null URL or one
    without ``://`` has empty host and path, no rule and the default verdict.
    Every input row gives one output row, repeated rows included; an empty
    table gives an empty result.  Input columns named like the added ones are
    replaced.
    """
    keep = [c for c in kept_columns(urls, ADDED) if c != url_col]
    base = urls.select(*[col(c) for c in keep], col(url_col).alias("__url"), F.lit(None).cast(_MATCH).alias("__best"))
    for low in range(0, len(rules), BLOCK_RULES):
        block = rules[low:low + BLOCK_RULES]
        if low:
            base = staged(base, "url-rules")
        counts = token_counts(base, "__url", {t for r in block for t in r.literals})
        # structs compare field by field: kind first (host and path rules), then length, then list order
        base = base.withColumn("__best", F.greatest("__best", _matcher(block, counts, low)(F.col("__url"))))
    b = F.col("__best")
    url = F.col("__url")
    return base.select(
        *[col(c) for c in keep if c.lower() != url_col.lower()], url.alias(url_col),
        url_host(url).alias("host"), url_path(url).alias("path"),
        F.when(b["kind"] == 0, b["name"]).alias("rule"),
        F.when(b["kind"] < 0, b["name"]).alias("pattern"),
        F.coalesce(b["verdict"], F.lit(default)).alias("verdict"))


_MATCH = "struct<kind:int,length:int,earlier:int,name:string,verdict:string>"


def file_rules(block: list[UrlRule], counts: dict[str, int]) -> dict[str, list[int]]:
    """Rule numbers by rarest literal token; "" holds rules without one."""
    index: dict[str, list[int]] = defaultdict(list)
    for i, rule in enumerate(block):
        index[min(rule.literals, key=lambda t: (counts.get(t, 0), t), default="")].append(i)
    return dict(index)


def _matcher(block: list[UrlRule], counts: dict[str, int], before: int = 0):
    index = file_rules(block, counts)
    rules = tuple(block)

    @F.pandas_udf(_MATCH)
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compiled: dict[int, re.Pattern] = {}
        for urls in batches:
            yield frame([best_match(u, rules, index, compiled, before) for u in urls])

    def frame(out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame({k: pd.Series([m[i] for m in out], dtype=t) for i, (k, t) in enumerate(
            (("kind", "Int32"), ("length", "Int32"), ("earlier", "Int32"), ("name", object), ("verdict", object)))})
    return match


def best_match(url: str | None, rules, index, compiled: dict[int, re.Pattern], before: int = 0) -> tuple:
    """The winning rule of one URL as (-kind, length, -number, name, verdict).
    ``compiled`` keeps the expressions that candidates have needed so far."""
    nothing = (None,) * 5
    if url is None or "://" not in url:
        return nothing
    rest = url.partition("://")[2]
    end = re.match(r"[^/?#]*", rest).end()
    target = rest[:end].translate(_LOWER) + rest[end:].partition("#")[0]
    best = nothing
    for token in {"", *_TOKEN.findall(target.translate(_LOWER))}:
        for i in index.get(token, ()):
            rule = rules[i]
            key = (-rule.kind, len(rule.name), -i - before, rule.name, rule.verdict)
            if best is nothing or key[:3] > best[:3]:
                if i not in compiled:
                    compiled[i] = re.compile(rule.regex, re.DOTALL)
                if compiled[i].search(target):
                    best = key
    return best
