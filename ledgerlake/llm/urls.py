"""URL filter: host-suffix and path-prefix expressions, hash-prefix join, digest check.

Every distinct host is expanded into its suffixes, which meet the hosts of the rules in an
equi-join on the first 32 bits of their SHA-256; the full digest confirms. An address of such
a host is then expanded into the expressions a rule could have: the suffix joined with the
head of its path, for the lengths that the rules of that suffix have and no others. They
meet the rules in the same way, and the longest rule wins (host and path together; of equal
ones a block wins). Work follows the rules that can apply to a host, not the number of
different shapes in the whole list, which has no limit.

Defined cases: a null address, or one without `://`, has an empty host and path, and only
the default judges it. Host and path are taken as written, ports and user names included,
apart from A-Z in the host. Rules with a null field take no part; repeated rules count once.
Repeated pages are judged each. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import carried, lower_ascii, quoted

MADE = ("host", "path", "rule", "verdict")
PREFIX_DIGITS = 8  # hexadecimal digits of the digest that the join compares


def split_address(address: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of an address."""
    at = F.instr(address, "://")
    rest = F.coalesce(F.when(at > 0, F.call_function("substring", address, at + 3)), F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0))
    return host, F.regexp_extract(rest, "^[^/?#]*+([^?#]*)", 1)


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def compiled(rules: DataFrame) -> DataFrame:
    """Rules (action, host, path) with digest, join key, host, labels and length of path."""
    host, path = lower_ascii(F.col("host")), F.col("path")
    text = F.concat(host, path)
    return (
        rules.where("action is not null and host is not null and path is not null")
        .select(
            text.alias("rule"),
            host.alias("host"),
            F.col("action"),
            _digest(text).alias("digest"),
            F.size(F.split(host, "[.]")).alias("labels"),
            F.length(path).alias("reach"),
        )
        .groupBy("rule", "host", "digest", "labels", "reach")
        .agg(F.max("action").alias("action"))  # of equal rules "block" is above "allow"
        .withColumn("key", F.substring("digest", 1, PREFIX_DIGITS))
    )


def _shapes(hosts: DataFrame, ready: DataFrame, most: int) -> DataFrame:
    """(host, labels, reaches): suffixes that rules have, with the lengths of their paths."""
    ruled = ready.groupBy("host").agg(F.collect_set("reach").alias("reaches"))
    ruled = ruled.select(_digest(F.col("host")).alias("full"), "reaches")
    ruled = ruled.withColumn("key", F.substring("full", 1, PREFIX_DIGITS))
    labels = F.least(F.size(F.split("host", "[.]")), F.lit(most))
    suffixes = (
        hosts.select("host", F.explode(F.sequence(F.lit(1), labels)).alias("labels"))
        .withColumn("digest", _digest(F.expr("substring_index(host, '.', -labels)")))
        .withColumn("key", F.substring("digest", 1, PREFIX_DIGITS))
    )
    return suffixes.join(ruled, "key").where("digest = full").select("host", "labels", "reaches")


def judge(pages: DataFrame, rules: DataFrame, address: str = "url", default: str = "allow") -> DataFrame:
    """The pages with host, path, the rule that decides (else null) and the verdict."""
    names = carried(pages, None, MADE)
    host, path = split_address(quoted(address))
    pages = pages.select(*[quoted(n) for n in names], host.alias("host"), path.alias("path"))
    ready = compiled(rules)
    most = ready.agg(F.max("labels")).first()[0]
    if most is None:
        return pages.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    addresses = pages.select("host", "path").distinct()
    shapes = _shapes(addresses.select("host").distinct(), ready, most)
    # a host with very many addresses is split on their side
    expressions = (
        addresses.join(shapes, "host")
        .withColumn("reach", F.explode(F.expr("filter(reaches, r -> r <= length(path))")))
        .withColumn("digest", _digest(F.expr("concat(substring_index(host, '.', -labels), left(path, reach))")))
        .select("host", "path", F.substring("digest", 1, PREFIX_DIGITS).alias("key"), "digest")
    )
    rules_side = ready.select("key", F.col("digest").alias("full"), "rule", "action")
    best = (
        expressions.join(rules_side, "key")
        .where("digest = full")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("n"), "action", "rule")).alias("won"))
        .select("host", "path", F.col("won.rule").alias("rule"), F.col("won.action").alias("action"))
    )
    return pages.join(best, ["host", "path"], "left").select(
        *[quoted(n) for n in names],
        "host",
        "path",
        "rule",
        F.coalesce("action", F.lit(default)).alias("verdict"),
    )
