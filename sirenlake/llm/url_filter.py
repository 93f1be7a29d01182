"""URL filter: stated rules, and host reputation by empirical Bayes for the rest.

Outcomes of labelled pages are counted per host. Host rates are shrunk towards their registered domain,
domains towards their suffix, suffixes towards the overall rate, each through a beta-binomial prior whose
strength is estimated from the spread of the level (method of moments). A host is blocked if the lower
posterior bound of its bad rate is above the cutoff. DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
SALTS = 16


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.regexp_extract(F.substring(url, at + 3, F.length(url)), r"^[^/?#]*", 0)
    return F.coalesce(F.when(at > 0, F.translate(rest, UPPER, LOWER)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    return F.coalesce(F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; NULL if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def _domain(host: Column) -> Column:
    """Last two labels of a host, without user and port."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    return F.substring_index(bare, ".", -2)


def _shrink(level: DataFrame) -> DataFrame:
    """Posterior (alpha, beta) of every row from its counts ``n``, ``x`` and the mean ``prior`` of its parent."""
    spread = F.col("prior") * (1 - F.col("prior"))
    excess = F.col("n") * F.pow(F.col("x") / F.col("n") - F.col("prior"), 2)
    seen = level.where("n > 0").agg(F.sum(excess).alias("excess"), F.sum(spread).alias("spread"), F.sum(spread * (F.col("n") - 1)).alias("more")).first()
    more = seen["more"] or 0.0
    within = min(max((seen["excess"] - seen["spread"]) / more, 0.001), 0.999) if more > 0 else 0.001
    strength = (1 - within) / within
    return level.withColumn("alpha", F.col("prior") * strength + F.col("x")).withColumn("beta", (1 - F.col("prior")) * strength + F.col("n") - F.col("x"))


def host_reputation(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """Posterior of the bad rate per host: ``host``, ``n``, ``x``, ``mean``, ``low``, ``high``.

    ``outcomes`` has ``host`` and ``bad`` (0, 1 or NULL for an unlabelled page). Hosts without labelled
    pages take the posterior mean of their domain, and so on up. Without any label all rates are 0.5.
    """
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("x"))
    hosts = hosts.withColumn("domain", _domain(F.col("host"))).withColumn("suffix", F.substring_index("domain", ".", -1))
    counts = (F.sum("n").alias("n"), F.sum("x").alias("x"))
    domains = hosts.groupBy("domain", "suffix").agg(*counts)
    suffixes = domains.groupBy("suffix").agg(*counts)
    total = suffixes.agg(*counts).first()
    overall = (total["x"] + 0.5) / (total["n"] + 1.0) if total["n"] else 0.5
    mean = (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("prior")
    suffixes = _shrink(suffixes.withColumn("prior", F.lit(overall)))
    domains = _shrink(domains.join(suffixes.select("suffix", mean), "suffix"))
    hosts = _shrink(hosts.join(domains.select("domain", mean), "domain"))
    size = F.col("alpha") + F.col("beta")
    rate = F.col("alpha") / size
    sd = F.sqrt(F.col("alpha") * F.col("beta") / (size * size * (size + 1)))
    return hosts.select("host", "n", "x", rate.alias("mean"), F.greatest(rate - z * sd, F.lit(0.0)).alias("low"), F.least(rate + z * sd, F.lit(1.0)).alias("high"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]] = RULES, cutoff: float = 0.5, z: float = 1.645) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` per page.

    A labelled page (``labels.doc_id`` = ``page_id``) is bad if its quality is 0 or it is toxic; of
    repeated labels the worst counts, NULL labels count as none. Rules come before reputation. Hosts
    are shared by very many pages, so the blocked hosts are joined with salt. A NULL url and one without
    ``://`` have empty host and path and are judged like any host. Empty tables give an empty result;
    repeated rows give repeated rows; other columns of ``pages`` are not read.
    """
    seen = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    outcome = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("page_id")).agg(F.max(bad).alias("bad"))
    reputation = host_reputation(seen.select("page_id", "host").join(outcome, "page_id", "left"), z)
    salted = reputation.where(F.col("low") > cutoff).select("host", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit("block").alias("by_host"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    salt = F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int")
    return (
        seen.withColumn("salt", salt)
        .join(salted, ["host", "salt"], "left")
        .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.col("by_host"), F.lit("allow")).alias("verdict"))
    )
