"""Host reputation by empirical Bayes: outcomes of a host's pages, shrunk to its domain, its suffix and all pages.

Labelled pages are those a rule decides. The share of blocked pages of a suffix is drawn to that of all pages, a
domain's to its suffix, a host's to its domain, by beta-binomial priors whose strengths are estimated from how much
the shares of a level differ (method of moments). A page no rule decides is blocked if a lower bound of its host's
posterior share is beyond ``LIMIT``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Z = 1.645  # one-sided 95 %
LIMIT = 0.5
LEAST_STRENGTH, MOST_STRENGTH = 0.5, 1000.0
# Suffixes of two labels under which domains are registered. ``judged`` and ``reputations`` take others.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "co.nz")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for pages of ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def decide(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, NULL if none does. Rules of a list are few: each is one condition."""
    text = verdict = None
    for rule in sorted(rules, key=lambda rule: -len(rule.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        text = F.when(fits, rule.text) if text is None else text.when(fits, rule.text)
        verdict = F.when(fits, rule.verdict) if verdict is None else verdict.when(fits, rule.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if text is None else (text, verdict)


def suffix_of(host: Column, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), F.substring_index(host, ".", -3)).otherwise(two)


def _strength(level: DataFrame) -> DataFrame:
    """One row: how many pages the prior of a level's shares is worth, from the spread of the shares."""
    labelled = level.filter(F.col("n") > 0)
    sums = labelled.agg(
        F.count(F.lit(1)).alias("g"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("n"),
        F.coalesce(F.sum("k"), F.lit(0)).cast("double").alias("k"),
        F.coalesce(F.sum(F.col("n").cast("double") * F.col("n")), F.lit(0.0)).alias("nn"),
        F.coalesce(F.sum(F.col("k").cast("double") * F.col("k") / F.col("n")), F.lit(0.0)).alias("kk"),
    )
    mean = F.col("k") / F.nullif("n", F.lit(0.0))
    within = mean * (1 - mean)
    between = F.col("kk") - F.col("k") * mean - (F.col("g") - 1) * within
    room = within * (F.col("n") - F.col("nn") / F.nullif("n", F.lit(0.0)) - (F.col("g") - 1))
    alike = between / F.nullif(room, F.lit(0.0))
    strength = F.when(alike > 0, 1 / alike - 1).otherwise(F.lit(MOST_STRENGTH))
    bounded = F.least(F.greatest(strength, F.lit(LEAST_STRENGTH)), F.lit(MOST_STRENGTH))
    return sums.select(F.round(F.coalesce(bounded, F.lit(MOST_STRENGTH)), 6).alias("strength"))


def reputations(pages: DataFrame, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """``host`` with ``n`` labelled pages, ``share`` (posterior mean of blocked pages) and ``bound`` (its lower bound).

    ``pages`` has ``host`` and ``label`` (allow, block or NULL), ``suffixes`` are those of two labels. One row per host; its pages are counted where they
    are read, so a host with a third of all pages sends one row per task.
    """
    hosts = pages.groupBy("host").agg(F.count("label").alias("n"), F.count_if(F.col("label") == "block").alias("k"))
    hosts = hosts.withColumns({"domain": domain_of(F.col("host"), suffixes), "suffix": suffix_of(F.col("host"), suffixes)})

    def level(*by: str) -> DataFrame:
        return hosts.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))

    def shrunk(rows: DataFrame, parent: Column) -> Column:
        strength = F.col("strength")
        return (F.col("k") + strength * parent) / (F.col("n") + strength)

    # A strength is one row, and so is the share of all pages.
    everything = hosts.agg(F.coalesce(((F.sum("k") + 0.5) / (F.sum("n") + 1.0)), F.lit(0.5)).alias("all_share"))
    suffixes = level("suffix")
    suffixes = suffixes.join(F.broadcast(_strength(suffixes))).join(F.broadcast(everything))
    suffixes = suffixes.select(F.col("suffix").alias("of_suffix"), shrunk(suffixes, F.col("all_share")).alias("suffix_share"))
    domains = level("domain", "suffix")
    domains = domains.join(F.broadcast(_strength(domains))).join(suffixes, F.col("suffix") == F.col("of_suffix"))
    domains = domains.select(F.col("domain").alias("of_domain"), shrunk(domains, F.col("suffix_share")).alias("domain_share"))
    found = hosts.join(F.broadcast(_strength(hosts))).join(domains, F.col("domain") == F.col("of_domain"))
    found = found.select("host", "n", "strength", shrunk(found, F.col("domain_share")).alias("share"))
    deviation = F.sqrt(F.greatest(F.col("share") * (1 - F.col("share")), F.lit(0.0)) / (F.col("n") + F.col("strength") + 1))
    return found.select("host", "n", "share", F.round(F.col("share") - Z * deviation, 9).alias("bound"))


def judged(
    pages: DataFrame, rules: Sequence[Rule], columns: Sequence[str] = ("page_id",), suffixes: Sequence[str] = TWO_LABEL_SUFFIXES
) -> DataFrame:
    """``columns`` of each page (``url`` decides), ``host``, ``path``, ``rule`` and ``verdict``.

    A NULL url, or one without ``://``, has an empty host and path and is judged like any other host. Repeated pages
    count as often as they are there, other columns are ignored, and an empty table gives an empty result.
    """
    parts = pages.select(*columns, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    text, verdict = decide(F.col("host"), F.col("path"), rules)
    labelled = parts.select("*", text.alias("rule"), verdict.alias("label"))
    bounds = reputations(labelled, suffixes).select(F.col("host").alias("of_host"), "bound")
    by_host = F.when(F.col("bound") > LIMIT, "block").otherwise("allow")
    # Spark splits a frequent host's pages over tasks here; the other side has one row per host.
    return labelled.join(bounds, F.col("host") == F.col("of_host"), "left").select(
        *columns, "host", "path", "rule", F.coalesce("label", by_host).alias("verdict")
    )


def rules_by_text(rules: Sequence[tuple[str, str]]) -> list[Rule]:
    """Rules from pairs of a verdict and a text like ``example.com/en/``."""
    parts = [(verdict, text.partition("/")) for verdict, text in rules]
    return [Rule(verdict, host, slash + path) for verdict, (host, slash, path) in parts]
