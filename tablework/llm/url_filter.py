"""URL filters by host suffix and path prefix, in DataFrame expressions only.

A rule holds for its host, all its subdomains, and paths that start with its
path. Every URL is expanded into (host suffix, path prefix) expressions; rules
are gathered by a short prefix of their digests, expressions meet them in an
equi-join on that prefix alone, and of what they meet only rules with an equal
full digest count. The longest rule (host and path
together) wins; of equal ones a block comes before an allow, then the text order
decides. URLs without a matching rule get the default verdict.

Only suffix and prefix lengths that some rule has are expanded, so a URL with
thousands of labels or a path of any length stays cheap and no rule is missed.
A null URL or one without ``://`` has an empty host and path and matches only
rules with an empty host. Repeated rows and repeated rules change nothing; null
fields of a rule are empty texts; no rules leave the default everywhere, and an
empty table of pages gives no rows. Other columns of the pages, whatever their
names, are not read by ``judge``; ``with_verdicts`` keeps them, and there a
clash with ``rule`` or ``verdict`` is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm.columns import reserve

#: Hex digits of the digest that the join compares; full digests are compared after it.
PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What stands after the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")


def _expression(host: Column, path: Column) -> Column:
    """Host and path as one text that only this pair has: the host's length comes first."""
    return F.concat(F.char_length(host).cast("string"), F.lit(":"), host, path)


def _lengths(values: DataFrame, length: Column) -> list[int]:
    """The distinct lengths among the rules: as many as a host has labels or a path characters."""
    return sorted(r[0] for r in values.select(length.alias("n")).distinct().collect())


def judge(
    pages: DataFrame, rules: DataFrame, url: str = "url", page_id: str = "page_id", default: str = "allow"
) -> DataFrame:
    """``page_id``, host, path, rule and verdict of every row of ``pages``.

    ``rules`` has host, path and verdict (allow or block).
    """
    fixed = rules.select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("host", "path")],
        F.coalesce("verdict", F.lit("block")).alias("verdict"),
    ).distinct()
    labels = _lengths(fixed, F.size(F.split("host", r"\.")))
    widths = _lengths(fixed, F.char_length("path"))
    digest = lambda c: F.sha2(c, 256)
    keyed_rules = fixed.select(
        digest(_expression(F.col("host"), F.col("path"))).alias("__rule_digest"),
        F.concat("host", "path").alias("__rule"),
        F.col("verdict").alias("__verdict"),
    )
    # Few rules share a short prefix: chance pairs, and both verdicts of one address.
    by_prefix = keyed_rules.groupBy(F.substring("__rule_digest", 1, PREFIX_DIGITS).alias("__key")).agg(
        F.collect_list(F.struct("__rule_digest", "__rule", "__verdict")).alias("__rules")
    )

    parsed = pages.select(
        F.col(page_id).alias("page_id"),
        F.coalesce(host_of(F.col(url)), F.lit("")).alias("host"),
        F.coalesce(path_of(F.col(url)), F.lit("")).alias("path"),
    )
    # One row per distinct address: hosts and pages that repeat are judged once.
    addresses = parsed.select("host", "path").distinct()
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in labels]).cast("array<int>"), lambda n: n <= F.size(parts)),
        lambda n: F.array_join(F.slice(parts, -n, n), "."),
    )
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in widths]).cast("array<int>"), lambda n: n <= F.char_length("path")),
        lambda n: F.left(F.col("path"), n),
    )
    expanded = (
        addresses.select("host", "path", F.explode(suffixes).alias("__suffix"), prefixes.alias("__prefixes"))
        .select("host", "path", "__suffix", F.explode("__prefixes").alias("__prefix"))
        .select("host", "path", digest(_expression(F.col("__suffix"), F.col("__prefix"))).alias("__digest"))
        .withColumn("__short", F.substring("__digest", 1, PREFIX_DIGITS))
    )
    met = expanded.join(by_prefix, F.col("__short") == F.col("__key"))
    confirmed = F.filter("__rules", lambda r: r["__rule_digest"] == F.col("__digest"))
    matched = met.select("host", "path", F.inline(confirmed))
    winner = matched.groupBy("host", "path").agg(
        F.max(
            F.struct(
                F.char_length("__rule").alias("length"),
                (F.col("__verdict") == "block").alias("blocks"),
                F.col("__rule").alias("rule"),
                F.col("__verdict").alias("verdict"),
            )
        ).alias("__best")
    )
    return (
        parsed.join(winner, ["host", "path"], "left")
        .select(
            "page_id",
            "host",
            "path",
            F.col("__best.rule").alias("rule"),
            F.coalesce("__best.verdict", F.lit(default)).alias("verdict"),
        )
    )


def with_verdicts(
    pages: DataFrame, rules: DataFrame, url: str = "url", page_id: str = "page_id", default: str = "allow"
) -> DataFrame:
    """All columns of ``pages`` with rule and verdict; rows are matched by their URL."""
    reserve(pages, ["rule", "verdict"])
    found = judge(pages.select(F.col(url).alias("__url")).distinct().withColumn("__id", F.col("__url")), rules, "__url", "__id", default)
    return (
        pages.join(found.select(F.col("page_id").alias("__page"), "rule", "verdict"), F.col(url).eqNullSafe(F.col("__page")), "left")
        .drop("__page")
    )
