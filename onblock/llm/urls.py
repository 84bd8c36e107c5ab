"""URL verdicts from host and path rules by expansion, hash prefixes and full digests.

A url is expanded into every host suffix joined with every path prefix that a rule of the table could have. The expressions
meet the rules in an equi-join on the first digits of a digest; the full digest confirms a meeting, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onblock.llm.tables import carried, quoted, unpacked

PREFIX_DIGITS = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path as text; both empty where the url is null or has no `://`. Only A-Z is lower-cased, ports stay."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _counted(first: int, last: Column, f) -> Column:
    """f(first), ..., f(last) as an array, empty where last < first."""
    return F.when(last >= first, F.transform(F.sequence(F.lit(first), last), f)).otherwise(F.array().cast("array<string>"))


def expressions(host: Column, path: Column, labels: int, slashes: int, lengths: list[int]) -> Column:
    """Host suffixes of up to so many labels with: no path, the prefixes that end in one of the first slashes, and those of given lengths."""
    parts, steps = F.split(host, r"\.", -1), F.split(path, "/", -1)
    hosts = _counted(1, F.least(F.size(parts), F.lit(labels)), lambda i: F.array_join(F.slice(parts, F.size(parts) - i + 1, i), "."))
    by_slash = _counted(1, F.least(F.size(steps) - 1, F.lit(slashes)), lambda i: F.concat(F.array_join(F.slice(steps, 1, i), "/"), F.lit("/")))
    by_length = F.filter(
        F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]).cast("array<string>"), lambda x: x.isNotNull()
    )
    prefixes = F.array_union(F.array_union(F.array(F.lit("")), by_slash), by_length)
    return F.flatten(F.transform(hosts, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))


def url_verdicts(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule and verdict to every row of pages.

    rules: host, path (empty or starting with `/`), verdict. A rule fits its host and all hosts below it if the path of the url
    starts with the rule's; the longest rule (host and path together, then the longer host) wins, `block` before `allow` between
    equal ones. Rule rows with nulls fit nothing. Urls without a fitting rule get the default. Null urls have an empty host and
    path and fit no rule, nor do urls without `://`. Repeated urls are judged once, and all their rows are kept; an empty table
    gives an empty result. Columns of pages named like a result are replaced.

    Only the shapes of the rules (most labels, most slashes, lengths of paths that don't end in a slash) come to the driver.
    """
    table = rules.select(
        F.translate(quoted("host"), UPPER, LOWER).alias("host"), quoted("path").alias("path"), quoted("verdict").alias("verdict")
    ).filter("host is not null and path is not null and verdict is not null")
    text = F.concat("host", "path")
    table = table.select(
        F.sha2(text, 256).alias("digest"),
        F.struct(F.length(text).alias("n"), F.length("host").alias("h"), F.col("verdict") == "block", text.alias("rule"), "verdict").alias("hit"),
        F.size(F.split("host", r"\.", -1)).alias("labels"),
        (F.length("path") - F.length(F.translate("path", "/", ""))).alias("slashes"),
        F.when((F.col("path") != "") & ~F.col("path").endswith("/"), F.length("path")).alias("odd"),
    )
    shape = table.agg(F.max("labels"), F.max("slashes"), F.sort_array(F.collect_set("odd"))).first()

    address = F.coalesce(quoted(url), F.lit(""))
    host, path = host_and_path(F.col("address"))
    found = (
        pages.select(address.alias("address"))
        .distinct()
        .select("address", F.explode(expressions(host, path, shape[0] or 0, shape[1] or 0, shape[2])).alias("part"))
        .select("address", F.sha2("part", 256).alias("full"))
        .withColumn("prefix", F.left("full", F.lit(PREFIX_DIGITS)))
        .join(table.select("digest", "hit", F.left("digest", F.lit(PREFIX_DIGITS)).alias("prefix")), "prefix")
        .filter("full = digest")
        .groupBy(F.col("address").alias("met"))
        .agg(F.max("hit").alias("hit"))
    )
    joined = pages.select(carried(pages).alias("row"), address.alias("address")).join(found, F.col("address") == F.col("met"), "left")
    return unpacked(
        joined,
        "row",
        pages.columns,
        {"host": host, "path": path, "rule": F.col("hit.rule"), "verdict": F.coalesce("hit.verdict", F.lit(default))},
    )
