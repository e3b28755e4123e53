"""URL filters by host-suffix and path-prefix expressions.

Every URL is expanded into the expressions a rule could have, the expressions
are joined with the rules on a short prefix of their SHA-256, full digests
confirm a hit, and the longest rule decides. Everything stays in DataFrame
functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import lower_ascii, text_or_empty

# After the first "://": the host, then the path. The lazy run stops at the first one.
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# Rules up to this many are broadcast (about 150 bytes each); more are joined by shuffle.
BROADCAST_RULES = 100_000
# Hex digits of the digest that the join uses.
SHORT = 8


def host(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.regexp_extract(text_or_empty(url), PARTS, 1))


def path(url: Column) -> Column:
    """From the host to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(text_or_empty(url), PARTS, 2)


def digest(host: Column, path: Column) -> Column:
    """The blank keeps a host's end apart from a path that does not start with a slash."""
    return F.sha2(F.concat(host, F.lit(" "), path), 256)


def prepared_rules(rules: DataFrame) -> DataFrame:
    """Rules ``host, path, verdict`` with their digests.

    Rows with a NULL or empty host or a NULL verdict say nothing and are dropped,
    a NULL path is the empty prefix. Of equal rules a block wins.
    """
    return (
        rules.select(lower_ascii("host").alias("h"), text_or_empty(F.col("path")).alias("p"), "verdict")
        .where((F.col("h") != "") & F.col("verdict").isNotNull())
        .groupBy("h", "p").agg(F.max("verdict").alias("rule_verdict"))
        .select(
            F.concat("h", "p").alias("rule"), "rule_verdict",
            F.length("h").alias("rule_host"), F.length(F.concat("h", "p")).alias("rule_length"),
            (F.length("h") - F.length(F.translate("h", ".", "")) + 1).alias("labels"),
            F.length("p").alias("prefix"),
            digest(F.col("h"), F.col("p")).alias("rule_digest"),
        )
    )


def judge(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow",
    broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """One row per row of ``pages``: ``<key>, host, path, rule, verdict``.

    A rule fits its host and all subdomains if the path starts with the rule's.
    The longest rule (host and path together) wins, then the longer host. Without
    a rule the verdict is ``default``. NULL URLs and URLs without ``://`` have an
    empty host and path, so no rule fits. Other columns are not read. Repeated
    rows and NULL keys each give their own row; an empty table or no rules give
    an empty table or the default.

    Only the (labels, path length) forms that rules have are expanded, so the
    expansion is as small as the rules allow. Rows are grouped by key, URL parts
    and input partition: no key can hold more than one partition's rows, and one
    narrow exchange is all that is moved. A rule table above ``broadcast_rules``
    is joined by shuffle; frequent expressions are then split by the adaptive
    skew join, because the rule side is unique.
    """
    ready = prepared_rules(rules)
    forms = [(r["labels"], r["prefix"]) for r in ready.select("labels", "prefix").distinct().collect()]
    small = ready.limit(broadcast_rules + 1).count() <= broadcast_rules
    rows = pages.select(F.col(key).alias("_key"), host(F.col(url)).alias("_host"), path(F.col(url)).alias("_path"))
    # Copies inside one input partition are counted and restored at the end.
    keys = ["_key", "_host", "_path", "_part"]
    rows = rows.withColumn("_part", F.spark_partition_id())
    labels = F.length("_host") - F.length(F.translate("_host", ".", "")) + 1
    form = F.col("_form")
    fits = (form["labels"] <= labels) & (form["prefix"] <= F.length("_path")) & (F.col("_host") != "")
    expression = digest(
        F.expr("substring_index(_host, '.', -_form.labels)"), F.substring("_path", F.lit(1), form["prefix"]))
    listed = F.array(*[F.struct(F.lit(a).alias("labels"), F.lit(b).alias("prefix")) for a, b in forms]) if forms else (
        F.array().cast("array<struct<labels:int,prefix:int>>"))
    expanded = (
        rows.withColumn("_form", F.explode_outer(listed))
        .withColumn("_digest", F.when(fits, expression))
        .select(*keys, "_digest", F.substring("_digest", 1, SHORT).alias("_short"),
                # One form of each row carries the count of its copies.
                ((form == listed[0]).cast("bigint") if forms else F.lit(1)).alias("_copy"))
    )
    wanted = ready.select(
        F.substring("rule_digest", 1, SHORT).alias("_rule_short"), "rule_digest", "rule", "rule_verdict",
        "rule_host", "rule_length")
    on = (F.col("_short") == F.col("_rule_short")) & (F.col("_digest") == F.col("rule_digest"))
    joined = expanded.join(F.broadcast(wanted) if small else wanted, on, "left")
    best = F.max(F.when(F.col("rule").isNotNull(), F.struct("rule_length", "rule_host", "rule", "rule_verdict")))
    judged = joined.groupBy(*keys).agg(best.alias("_best"), F.sum("_copy").alias("_copies"))
    return judged.withColumn("_each", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(
        F.col("_key").alias(key), F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.col("_best.rule").alias("rule"),
        F.coalesce("_best.rule_verdict", F.lit(default)).alias("verdict"),
    )
