"""URL filter: allow and block rules, and for the rest trust and distrust over the host graph.

Hosts link to hosts. Trust starts at hosts with allowed pages and follows the links, distrust
starts at hosts with blocked pages and goes against them (who links to blocked hosts is
suspect). Both are personalised PageRank. A host is blocked if distrust makes up more than a given
share of its own trust and distrust and is larger than a threshold. Neither depends on hosts that
no links lead to or from: seeds weigh by the shares of their own pages, not by the table's sums.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import stage

# Fixed values: (verdict, host, path) of the rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DAMPING = 0.85
TOLERANCE = 1e-9
#: Distrust as a share of a host's trust and distrust, above which it is suspect.
SPAM_SHARE = 0.5
#: Distrust that a suspect host has at least: a host without links gets it with 1 of 15 pages blocked, and
#: a wholly blocked host passes it on over at most 16 links, each the only one to its target.
THRESHOLD = 0.01

_LINK = r"""(?i)\b(?:href|src|action)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


def ascii_lower(value: Column) -> Column:
    return F.translate(value, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://``, lower-cased in A-Z, and the path; both empty for null or other texts."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return ascii_lower(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def rule_columns(rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits ``host`` and ``path``, as text, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(path))
        rule = F.when(fits, host + path).otherwise(rule)
        verdict = F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """Distinct (``src``, ``dst``) of absolute links between different hosts."""
    linked = F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))))
    found = pages.where("host <> '' AND html IS NOT NULL").select(F.col("host").alias("src"), linked.alias("dst"))
    found = found.select("src", ascii_lower(F.col("dst")).alias("dst"))
    return found.where("dst <> '' AND src <> dst").distinct()


def propagate(
    seeds: DataFrame, links: DataFrame, damping: float = DAMPING, rounds: int | None = None, tolerance: float = TOLERANCE, scaled: bool = True
) -> DataFrame:
    """(``host``, ``trust``, ``distrust``) from ``seeds`` (``host``, ``good``, ``bad``) over ``links``.

    The seeds are scaled to a sum of one each, unless ``scaled`` is false. Every round joins the
    current values with the links twice and sums per host; the values are staged, and the loop ends
    when no host's moves by more than ``tolerance``, however many hosts there are. A round moves them by at most ``damping`` times
    the round before, which bounds the rounds; ``rounds`` ends the loop earlier. Mass of hosts without
    links is lost, as nothing follows it.
    """
    sums = seeds.agg(F.sum("good"), F.sum("bad")).first()
    if not scaled:
        total, sums = sum(x or 0.0 for x in sums), (1.0, 1.0)
    else:
        total = 2.0
    if rounds is None:
        rounds = 2 + max(0, math.ceil(math.log(tolerance / max(total, 1.0)) / math.log(damping)))
    out = links.groupBy("src").agg((1 / F.count("*")).alias("forth"))
    into = links.groupBy("dst").agg((1 / F.count("*")).alias("back"))
    edges = stage(links.join(out, "src").join(into, "dst"), "url-edges")
    start = seeds.select(
        "host", (F.col("good") / F.lit(float(sums[0] or 1))).alias("good"), (F.col("bad") / F.lit(float(sums[1] or 1))).alias("bad")
    )
    ends = edges.select(F.col("src").alias("host")).unionByName(edges.select(F.col("dst").alias("host")))
    nodes = start.unionByName(ends.select("host", F.lit(0.0).alias("good"), F.lit(0.0).alias("bad")))
    start = stage(nodes.groupBy("host").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")), "url-seeds")
    values = start.select("host", F.col("good").alias("trust"), F.col("bad").alias("distrust"))
    for _ in range(rounds):
        forth = edges.join(values.withColumnRenamed("host", "src"), "src").select(
            F.col("dst").alias("host"), (F.col("trust") * F.col("forth")).alias("t"), F.lit(0.0).alias("d")
        )
        back = edges.join(values.withColumnRenamed("host", "dst"), "dst").select(
            F.col("src").alias("host"), F.lit(0.0).alias("t"), (F.col("distrust") * F.col("back")).alias("d")
        )
        moved = forth.unionByName(back).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        old = values.select("host", F.col("trust").alias("was"), F.col("distrust").alias("bad_was"))
        new = start.join(moved, "host", "left").join(old, "host").select(
            "host",
            ((1 - damping) * F.col("good") + damping * F.coalesce("t", F.lit(0.0))).alias("trust"),
            ((1 - damping) * F.col("bad") + damping * F.coalesce("d", F.lit(0.0))).alias("distrust"),
            "was",
            "bad_was",
        )
        new = stage(new, "url-values")
        step = new.agg(F.max(F.greatest(F.abs(F.col("trust") - F.col("was")), F.abs(F.col("distrust") - F.col("bad_was"))))).first()[0]
        values = new.select("host", "trust", "distrust")
        if not step or step < tolerance:
            break
    return values


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = THRESHOLD, spam_share: float = SPAM_SHARE
) -> DataFrame:
    """Per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``trust``, ``distrust``.

    The longest fitting rule decides; a page without one follows its host. A host seeds trust
    and distrust by the share of its pages that rules allow and block; it is blocked if distrust is
    more than ``spam_share`` of both and more than ``threshold``, to 12 digits. Null or odd urls have
    an empty host, no rule, no trust, and are allowed; null html has no links. Repeated rows
    are kept; empty table: no rows; other columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    rule, verdict = rule_columns(rules)
    seen = pages.select("page_id", "html", host.alias("host"), path.alias("path"))
    ruled = stage(seen.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled")), "url-ruled")
    links = stage(host_links(seen), "url-links")
    seeds = (
        ruled.where("host <> ''")
        .groupBy("host")
        .agg(
            F.avg((F.coalesce("ruled", F.lit("")) == "allow").cast("double")).alias("good"),
            F.avg((F.coalesce("ruled", F.lit("")) == "block").cast("double")).alias("bad"),
        )
    )
    # rounded, so that the order of sums doesn't settle ties
    values = propagate(seeds, links, scaled=False).select("host", *(F.round(c, 12).alias(c) for c in ("trust", "distrust")))
    mass = F.round(F.col("distrust") - spam_share * (F.col("trust") + F.col("distrust")), 12)
    suspect = (mass > 0) & (F.col("distrust") > threshold)
    return ruled.join(values, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", F.when(suspect, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
