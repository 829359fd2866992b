"""URL filtering by rules and by an empirical-Bayes reputation of hosts.

Labelled outcomes of pages (good or not) are counted by host. A host's rate of
good pages gets a beta prior centred on its registered domain's rate, a
domain's one centred on its suffix's, a suffix's one centred on the overall
rate. How strong each prior is, is estimated from the outcomes: the overdispersion
of the children around their parents, by the method of moments for
beta-binomial counts. A host is blocked if the upper bound of its posterior
rate is below ``least_good``: few labels, or none, leave it near its domain.

Only DataFrame functions are used. Pages are folded by host before they meet
anything; the join back splits hot hosts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import cut, join_counted

# Fixed values: (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
LEAST_GOOD = 0.5
Z = 2.0
MIN_RHO, MAX_RHO = 1e-4, 0.5
_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty if the url is null or has no ``://``."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _SMALL), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, the first listed of equals; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for verdict_, host_, path_ in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host == host_) | host.endswith(f".{host_}")) & path.startswith(path_)
        rule = F.when(fits, F.lit(host_ + path_)).otherwise(rule)
        verdict = F.when(fits, F.lit(verdict_)).otherwise(verdict)
    return rule, verdict


def _strength(children: DataFrame, parent: str, p: str) -> float:
    """Prior strength: pooled over the parents, from columns n, good and the parent's rate ``p``.

    With S the sum of n (rate - p)^2 / (p (1 - p)) over K children of N outcomes,
    E[S] = (K - 1)(1 - rho) + rho (N - sum n^2 / N), and strength = 1 / rho - 1.
    """
    spread = F.col("n") * F.pow(F.col("good") / F.col("n") - F.col(p), F.lit(2)) / (F.col(p) * (1 - F.col(p)))
    sums = (
        children.where("n > 0")
        .groupBy(parent)
        .agg(
            F.sum(spread).alias("s"),
            (F.count("*") - 1).alias("free"),
            (F.sum("n") - F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("mass"),
        )
        .agg(F.sum("s").alias("s"), F.sum("free").alias("free"), F.sum("mass").alias("mass"))
        .first()
    )
    room = (sums.mass or 0) - (sums.free or 0)
    rho = ((sums.s or 0) - (sums.free or 0)) / room if room > 0 else MIN_RHO
    return 1 / min(max(rho, MIN_RHO), MAX_RHO) - 1


def reputations(outcomes: DataFrame, least_good: float = LEAST_GOOD, z: float = Z) -> DataFrame:
    """For each host (host, pages, n, good): mean and upper bound of its posterior rate and the verdict."""
    labels = F.split(F.regexp_replace("host", r":\d*$", ""), r"\.")
    hosts = cut(
        outcomes.withColumns(
            {
                "suffix": F.element_at(labels, -1),
                "domain": F.when(F.size(labels) < 2, F.element_at(labels, -1)).otherwise(
                    F.concat_ws(".", F.slice(labels, -2, 2))
                ),
            }
        )
    )
    sums = F.sum("n").alias("n"), F.sum("good").alias("good"), F.count("*").alias("children")
    domains = cut(hosts.groupBy("suffix", "domain").agg(*sums))
    suffixes = cut(domains.groupBy("suffix").agg(*sums))
    all_ = suffixes.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    overall = ((all_.good or 0) + 1) / ((all_.n or 0) + 2)

    def shrunk(children: DataFrame, key: str, parent: str, p: str, name: str) -> DataFrame:
        m = _strength(children, parent, p)
        rate = (F.col("good") + F.col(p) * m) / (F.col("n") + m)
        return children.select(key, rate.alias(name), F.col("children").alias("met"))

    rates = shrunk(suffixes.withColumn("p0", F.lit(overall)).withColumn("root", F.lit(0)), "suffix", "root", "p0", "p1")
    met = cut(join_counted(domains, rates, ["suffix"], "met", F.col("domain")).drop("met"))
    rates = shrunk(met, "domain", "suffix", "p1", "p2")
    met = cut(join_counted(hosts, rates, ["domain"], "met", F.col("host")))
    m = _strength(met, "domain", "p2")
    a = F.col("good") + F.col("p2") * m
    b = F.col("n") - F.col("good") + (1 - F.col("p2")) * m
    mean = a / (a + b)
    return met.withColumns({"mean": mean, "upper": mean + z * F.sqrt(mean * (1 - mean) / (a + b + 1))}).select(
        "host",
        "pages",
        "mean",
        "upper",
        F.when(F.col("upper") < least_good, "block").otherwise("allow").alias("reputation"),
    )


def url_filter(
    pages: DataFrame,
    labels: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    label_id_col: str = "doc_id",
    good_col: str = "quality",
    rules: Sequence[tuple[str, str, str]] = RULES,
    least_good: float = LEAST_GOOD,
    z: float = Z,
) -> DataFrame:
    """The verdict on each page: that of the longest rule that fits, else of its host's reputation.

    ``labels`` holds outcomes by page id: 1 good, 0 not; null outcomes and ids
    count for nothing, and each of several labels of a page counts. A null url
    or one without ``://`` has an empty host and path; all such pages share one
    reputation. Repeated pages give a row each and count each. An empty table
    gives an empty result; other columns are ignored.

    Returns page_id, host, path, rule, verdict, and of the host the posterior mean
    and upper bound of the rate of good pages, to nine decimals: good_mean, good_upper.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    judged = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    marks = (
        labels.select(F.col(label_id_col).cast("long").alias("page_id"), F.col(good_col).cast("long").alias("good"))
        .where("page_id is not null and good is not null")
        .groupBy("page_id")
        .agg(F.count("*").alias("n"), F.sum("good").alias("good"))
    )
    outcomes = (
        judged.join(marks, "page_id", "left")
        .groupBy("host")
        .agg(
            F.count("*").alias("pages"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
            F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        )
    )
    known = cut(reputations(outcomes, least_good, z))
    met = join_counted(judged, known, ["host"], "pages", F.xxhash64("page_id", "path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return met.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.col("reputation")).alias("verdict"),
        F.round("mean", 9).alias("good_mean"),
        F.round("upper", 9).alias("good_upper"),
    )
