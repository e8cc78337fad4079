"""URL filters: host rules, and host reputation by empirical Bayes.

Labelled outcomes (1: bad) are counted by host. Each host's rate is shrunk towards that of its registered domain, the domain's
towards that of its suffix, and the suffix's towards the rate of all (with nine good outcomes and a bad one added). How strongly is told by the spread of the rates
themselves, one beta-binomial concentration per level by the method of moments. A host is blocked if the lower bound of its
posterior rate, ``z`` posterior deviations below its mean, is above the limit; so a few bad pages alone do not block it.
Rules come first.

Counts are combined before the shuffle, so a host with a third of all pages costs a row per task; only its verdict goes
back to the pages. All tables joined to the pages are measured before they are broadcast.

Defined cases: a null url, or one without ``://``, has an empty host and path, and its own reputation under that name; pages
without an outcome, and hosts without any, take what their domain tells; several outcomes of a page count as bad if one is;
rows are judged one by one, so repeated and null page ids are kept; empty tables block nothing; of rules equally long
the one with the longer host wins, then block before allow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import sized_join
from ..session import materialize

Z = 1.645
LIMIT = 0.5
# The spread is taken between these; outside them a level would tell all or nothing.
LEAST_SPREAD, MOST_SPREAD = 0.0001, 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The text after the first ``://`` up to ``/``, ``?`` or ``#``, in lower case, and what follows up to ``?`` or ``#``."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + F.lit(3), F.length(url))
    known = F.coalesce(at > 0, F.lit(False))
    host = F.when(known, F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)).otherwise("")
    path = F.when(known, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise("")
    return host, path


def domain_and_suffix(host: Column, suffixes: Sequence[str] = ()) -> tuple[Column, Column]:
    """The registered domain and the suffix of a host: the last label, or the longest of ``suffixes`` that fits."""
    last = F.substring_index(host, ".", -1)
    suffix = last
    for known in sorted(suffixes, key=len):
        suffix = F.when((host == known) | host.endswith("." + known), F.lit(known)).otherwise(suffix)
    head = F.left(host, F.greatest(F.length(host) - F.length(suffix) - 1, F.lit(0)))
    domain = F.when(head == "", host).otherwise(F.concat_ws(".", F.substring_index(head, ".", -1), suffix))
    return domain, suffix


def _concentration(groups: DataFrame, rate: float) -> float:
    """How many outcomes the parent's rate is worth for a group, from the spread of the groups' rates."""
    n, y = F.col("n"), F.col("y")
    row = groups.filter("n > 0").agg(
        F.sum(n).alias("all"), F.sum(n * n).alias("squares"), F.count(F.lit(1)).alias("k"),
        F.sum((y - n * F.lit(rate)) * (y - n * F.lit(rate)) / n).alias("s"),
    ).first()
    even = rate * (1 - rate)
    room = even * (row["all"] - row["squares"] / row["all"] - (row["k"] - 1)) if row["all"] else 0.0
    spread = (row["s"] - even * (row["k"] - 1)) / room if room > 0 else MOST_SPREAD  # one group tells nothing
    return 1 / min(max(spread, LEAST_SPREAD), MOST_SPREAD) - 1


def reputation(counts: DataFrame, *, suffixes: Sequence[str] = (), z: float = Z) -> DataFrame:
    """``host``, ``mean`` and ``bound``: the posterior rate of bad outcomes and its lower bound, per row of ``counts``.

    ``counts`` has one row per ``host`` with ``n`` outcomes, ``y`` of them bad.
    """
    domain, suffix = domain_and_suffix(F.col("host"), suffixes)
    hosts = counts.withColumns({"domain": domain, "suffix": suffix})
    total = hosts.agg(F.sum("n").alias("n"), F.sum("y").alias("y")).first()
    rate = ((total["y"] or 0) + 1) / ((total["n"] or 0) + 10)
    by_suffix = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    by_domain = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    shrunk = lambda parent, weight: (F.col("y") + parent * F.lit(weight)) / (F.col("n") + F.lit(weight))
    strength = [_concentration(level, rate) for level in (by_suffix, by_domain, hosts)]
    of_suffix = by_suffix.select("suffix", shrunk(F.lit(rate), strength[0]).alias("suffix_rate"))
    of_domain = by_domain.join(of_suffix, "suffix").select(
        "domain", "suffix", shrunk(F.col("suffix_rate"), strength[1]).alias("domain_rate")
    )
    mean = shrunk(F.col("domain_rate"), strength[2])
    found = hosts.join(of_domain, ["domain", "suffix"]).withColumn("mean", mean)
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.lit(strength[2]) + 1))
    return found.select("host", "mean", (F.col("mean") - F.lit(z) * deviation).alias("bound"))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host`` and ``rules``: those that fit a host or a parent of it, the longest first. Hosts without any are left out.

    ``rules`` has ``host``, ``path`` and ``action``; the rules that fit one host must fit in a row.
    """
    named = rules.select(
        F.col("host").alias("_of"), F.concat("host", "path").alias("rule"), "path", "action",
        F.size(F.split("host", "\\.")).alias("depth"),
    )
    deepest = named.agg(F.max("depth")).first()[0] or 0
    labels = F.split("host", "\\.")
    size = F.size(labels)
    parents = F.transform(
        F.sequence(F.lit(1), F.least(size, F.lit(max(deepest, 1)))),
        lambda k: F.array_join(F.slice(labels, size - k + 1, k), "."),
    )
    fitting = sized_join(hosts.select("host", F.explode(parents).alias("_of")), named, ["_of"], "inner")
    order = F.struct(
        (-F.length("rule")).alias("a"), (-F.length("_of")).alias("b"), (F.col("action") != "block").alias("c"),
        "rule", "path", "action",
    )
    return fitting.groupBy("host").agg(F.array_sort(F.collect_set(order)).alias("rules"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: DataFrame, *, page_id: str = "page_id", url_col: str = "url",
          outcome_id: str = "page_id", bad_col: str = "bad", suffixes: Sequence[str] = (), z: float = Z,
          limit: float = LIMIT) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (null if none fits) and ``verdict`` (allow or block) of every page."""
    host, path = host_and_path(F.col(url_col))
    parsed = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    bad = outcomes.filter(F.col(outcome_id).isNotNull() & F.col(bad_col).isNotNull()).groupBy(
        F.col(outcome_id).alias("page_id")).agg(F.max(F.col(bad_col).cast("int")).alias("_bad"))
    labelled = parsed.select("page_id", "host").join(bad, "page_id", "left")
    counts = labelled.groupBy("host").agg(F.count("_bad").alias("n"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("y"))
    hosts = materialize(counts, "hosts")
    blocked = reputation(hosts, suffixes=suffixes, z=z).filter(F.col("bound") > limit).select("host", F.lit(True).alias("_blocked"))
    known = hosts.join(host_rules(hosts, rules), "host", "left").join(blocked, "host", "left")
    told = materialize(known.filter("rules IS NOT NULL OR _blocked").select("host", "rules", "_blocked"), "verdicts")
    placed = sized_join(parsed, told, ["host"], "left")
    fits = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))
    own = F.when(F.col("_blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return placed.withColumn("_fit", fits).select(
        "page_id", "host", "path", F.col("_fit.rule").alias("rule"), F.coalesce("_fit.action", own).alias("verdict")
    )
