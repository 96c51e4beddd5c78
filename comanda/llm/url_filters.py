"""URL verdicts by rules and by a cascade of Bloom filters, in SQL functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.llm import bloom
from comanda.llm.bloom import Bloom
from comanda.llm.common import stored

# (verdict, host, path): fits the host and its subdomains where the path starts so.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

# Largest filter, all levels together, that is handed to every task. Some 50
# million listed keys fit; beyond it, keys are matched by a shuffled join.
MAX_FILTER_BYTES = 64 << 20


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or the end, A-Z lower-cased; path: on to ? or #.

    Both are empty for null and where there is no ://.
    """
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def build_cascade(universe: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> list[Bloom] | None:
    """Filters that together tell the listed keys of ``universe`` from the others.

    ``universe`` holds every key once: key (not null), listed. Level 1 encodes
    the listed keys; level 2 the others that pass level 1; level 3 the listed
    ones that pass level 2; and so on until none passes. Each level is built by
    distributed aggregates; the driver sees counts alone. The size of a filter
    follows from its count; None if the levels come to more than ``max_bytes``.
    No listed keys: no levels.
    """
    levels: list[Bloom] = []
    inside, outside = universe.where("listed"), universe.where(~F.col("listed"))
    n, rest = inside.count(), outside.count()
    total = 0
    while n:
        # The first level balances its own size against the second's; later ones halve.
        rate = min(0.5, max(0.001, n / (rest * math.sqrt(2)))) if not levels and rest else 0.5
        total += bloom.filter_bits(n, rate) // 8
        if total > max_bytes:
            return None
        level = bloom.build(inside, n, rate, len(levels) + 1)
        levels.append(level)
        left = stored(outside.where(bloom.passes(F.col("key"), level)), "passing")
        inside, outside, n, rest = left, inside, left.count(), n
    return levels


def is_listed(key: Column, levels: Sequence[Bloom]) -> Column:
    """Membership of a key of the universe: exact, from the levels alone.

    A key that stops at an odd level is not listed; at an even one, it is; a
    key that passes all belongs to what the last level encodes.
    """
    answer = F.lit(len(levels) % 2 == 1)
    for i in range(len(levels), 0, -1):
        answer = F.when(bloom.passes(key, levels[i - 1]), answer).otherwise(F.lit(i % 2 == 0))
    return answer


def judge(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    max_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """A verdict for every page: page_id, host, path, rule, verdict.

    ``pages`` needs page_id and url, ``listed`` has a column key: hosts to
    block. The longest rule that fits decides; without one, the host is blocked
    if listed, else allowed. Membership is asked of a Bloom cascade built over
    all hosts of ``pages``, so it is exact and rows meet no join. Filters above
    ``max_bytes`` are not handed out; keys are then matched by a shuffled join,
    to the same result.

    Null urls and those without :// have the empty host, which a list may hold.
    Repeated rows are judged each; listed keys that are null, repeated or not in
    the pages change nothing. Other columns of ``pages`` are left out.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    wanted = listed.select(F.col("key").alias("key")).where("key is not null").distinct()
    hosts = urls.select(F.col("host").alias("key")).distinct()
    marked = wanted.withColumn("mark", F.lit(True))
    universe = stored(
        hosts.join(marked, "key", "left").select("key", F.col("mark").isNotNull().alias("listed")), "hosts"
    )
    levels = build_cascade(universe, max_bytes)
    if levels is None:
        found = urls.join(marked.withColumnRenamed("key", "host"), "host", "left")
        found = found.withColumn("_listed", F.col("mark").isNotNull())
    else:
        found = urls.withColumn("_listed", is_listed(F.col("host"), levels))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("_listed"), F.lit("block")).otherwise(F.lit("allow"))
    return found.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"))


def tracking_hosts(pages: DataFrame, share: float = 0.2) -> DataFrame:
    """Hosts of which at least ``share`` of the pages carry a tracking parameter.

    The list that the registered query blocks; a column key.
    """
    host, _ = host_and_path(F.col("url"))
    tracked = F.coalesce(F.col("url").contains("utm_").cast("int"), F.lit(0))
    rates = pages.groupBy(host.alias("key")).agg(F.sum(tracked).alias("n"), F.count(F.lit(1)).alias("of"))
    return rates.where((F.col("n") >= share * F.col("of")) & (F.col("key") != "")).select("key")
