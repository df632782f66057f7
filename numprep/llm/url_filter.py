"""URL rules: host-suffix and path-prefix expressions, matched on short hash prefixes, confirmed on full digests."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hexadecimal digits of the short hash prefix.
PREFIX_DIGITS = 8
DEFAULT_VERDICT = "allow"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rows (rule_host, rule_path, rule_verdict) of (host, path, verdict) triples."""
    return spark.createDataFrame(list(rules), "rule_host string, rule_path string, rule_verdict string")


def _folder(path: Column) -> Column:
    """The path up to and with its last slash."""
    return F.regexp_extract(path, r"(?s)\A(.*/)", 1)


def _slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def prepare_rules(rules: DataFrame) -> DataFrame:
    """One row per rule: its text, verdict, digest and hash prefix.

    The digest is of host and path up to the path's last slash. Rules with a NULL are no rules, hosts are put in lower
    case, and of equal rules with both verdicts the one that blocks holds.
    """
    host = F.translate("rule_host", _UPPER, _LOWER)
    usable = rules.dropna(subset=["rule_host", "rule_path", "rule_verdict"]).withColumn("rule_host", host)
    one = usable.groupBy("rule_host", "rule_path").agg(F.max("rule_verdict").alias("rule_verdict"))
    digest = F.sha2(F.concat("rule_host", F.lit("\n"), _folder(F.col("rule_path"))), 256)
    return one.withColumn("rule_digest", digest).withColumn("rule_prefix", F.substring("rule_digest", 1, PREFIX_DIGITS))


def _expressions(labels: int, slashes: int) -> Column:
    """Host suffixes of at most ``labels`` labels, each with the path's leading folders of at most ``slashes``.

    No rule is longer than that, so none is missed, and a host of a thousand labels costs no more than others.
    """
    parts = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
        lambda n: F.array_join(F.slice(parts, -n, n), "."),
    )
    steps = F.split("path", "/", -1)
    count = F.least(F.size(steps) - 1, F.lit(slashes))
    folders = F.concat(
        F.array(F.lit("")),
        F.when(
            count > 0,
            F.transform(F.sequence(F.lit(1), count), lambda n: F.concat(F.array_join(F.slice(steps, 1, n), "/"), F.lit("/"))),
        ).otherwise(F.array().cast("array<string>")),
    )
    return F.flatten(F.transform(suffixes, lambda s: F.transform(folders, lambda f: F.concat(s, F.lit("\n"), f))))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """All rows of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (columns of these names are replaced).

    A rule fits its host and all subdomains, if the path starts with the rule's path. The longest rule wins, then the
    one with the longer host. Without a rule that fits, ``rule`` is NULL and ``verdict`` the default. A URL that is NULL
    or has no ``://`` has an empty host and path, which no rule with a host fits.

    Each different (host, path) is judged once, so a URL that many rows share costs one judgement. The rules are joined
    by Spark's own choice: it sends them to all tasks only below its broadcast threshold, and else shuffles both sides
    and splits hot prefixes. Rows without changes in any other column come back, repeated rows included.
    """
    pages = pages.drop(*[c for c in ("host", "path", "rule", "verdict") if c in pages.columns and c != url])
    located = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    prepared = prepare_rules(rules)
    deepest = prepared.agg(
        F.max(_labels(F.col("rule_host"))).alias("labels"), F.max(_slashes(F.col("rule_path"))).alias("slashes")
    ).first()
    expressions = _expressions(deepest["labels"] or 1, deepest["slashes"] or 0)
    wanted = located.select("host", "path").distinct()
    hashed = wanted.select("host", "path", F.explode(expressions).alias("expression"))
    hashed = hashed.withColumn("digest", F.sha2("expression", 256))
    fits = (
        hashed.withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
        .join(prepared, F.col("prefix") == F.col("rule_prefix"))
        .where((F.col("digest") == F.col("rule_digest")) & F.startswith("path", F.col("rule_path")))
    )
    rank = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("all"),
        F.length("rule_host").alias("of_host"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    judged = fits.groupBy("host", "path").agg(F.max(rank).alias("best"))
    out = located.join(judged, ["host", "path"], "left")
    return out.select(
        *[located[c] for c in pages.columns],
        "host",
        "path",
        judged["best"]["rule"].alias("rule"),
        F.coalesce(judged["best"]["verdict"], F.lit(default)).alias("verdict"),
    )
