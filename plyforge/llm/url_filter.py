"""Empirical-Bayes host reputation for URLs, in DataFrame expressions only.

Pages that a rule decides are the labelled outcomes (1: block). A host's block rate is shrunk
towards its registered domain's, that towards its suffix's, that towards the rate of all labelled
pages, through beta-binomial priors. Each level's concentration is estimated from the labelled
pages by the method of moments (intraclass correlation of children around their parents), and a
prior never weighs more than the evidence behind its mean. A page
without a rule is blocked when the lower posterior bound of its host's block rate is above
``threshold``.

Null url or one without ``://``: host and path are empty, no rule fits, the suffix is empty, and the
page is judged like any other host without labels. A port belongs to the host, not to its domain; null and repeated ids are kept. Repeated rows count as often as they occur. An
empty table gives an empty result. Other columns are ignored.

Skew: statistics are partial aggregates. Hosts that hold over ``hot`` of all pages are joined by
broadcast (there are at most 1/hot of them); the rest by a shuffle on host.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plyforge.llm.common import ascii_lower, written

Rule = tuple[str, str, str]
# Public suffixes of two labels under which names are registered.
TWO_LABEL_SUFFIXES = (
    "ac.jp", "ac.uk", "co.id", "co.il", "co.in", "co.jp", "co.ke", "co.kr", "co.nz", "co.th", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.co", "com.eg", "com.hk", "com.mx",
    "com.my", "com.ng", "com.pe", "com.ph", "com.pk", "com.pl", "com.sa", "com.sg", "com.tr", "com.tw", "com.ua", "com.vn", "edu.au", "edu.cn", "go.jp", "gob.mx", "gov.au", "gov.br", "gov.cn",
    "gov.in", "gov.uk", "ltd.uk", "ne.jp", "net.au", "net.br", "net.cn", "net.in", "net.nz", "net.uk", "or.jp", "or.kr", "org.au", "org.br", "org.cn", "org.in", "org.mx", "org.nz", "org.uk", "org.za",
)
IP = r"^([0-9]{1,3}\.){3}[0-9]{1,3}$|^\[.*\]$"
LOW_K, HIGH_K = 0.5, 1000.0


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): the host A-Z lower-cased, the path up to the query; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def registered(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix), without a port. An IP address is a domain of its own, and all of them share a suffix."""
    bare = F.regexp_replace(host, ":[0-9]*$", "")
    two = F.substring_index(bare, ".", -2)
    long, ip = two.isin(*TWO_LABEL_SUFFIXES), bare.rlike(IP)
    domain = F.when(ip, bare).when(long, F.substring_index(bare, ".", -3)).otherwise(two)
    return domain, F.when(ip, F.lit("(ip)")).when(long, two).otherwise(F.substring_index(bare, ".", -1))


def fitted_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _concentration(children: DataFrame, rate: str) -> DataFrame:
    """One row k: the beta prior's weight, from children (n, b) around their parents' ``rate``."""
    p = F.col("b") / F.col("n")
    sums = children.filter("n > 0").agg(
        F.count("*").alias("groups"), F.sum("n").alias("total"), F.sum(F.col("n") * F.col("n") * F.lit(1.0)).alias("squares"),
        F.sum(F.col("n") * (p - F.col(rate)) * (p - F.col(rate))).alias("among"), F.sum(F.col("n") * p * (1 - p)).alias("within"),
    )
    ok = (F.col("groups") > 1) & (F.col("total") > F.col("groups"))
    msb, msw = F.col("among") / (F.col("groups") - 1), F.col("within") / (F.col("total") - F.col("groups"))
    size = (F.col("total") - F.col("squares") / F.col("total")) / (F.col("groups") - 1)
    spread = msb + (size - 1) * msw
    rho = F.when(ok & (spread > 0), (msb - msw) / spread)
    k = F.when(rho > 0, F.least(F.lit(HIGH_K), F.greatest(F.lit(LOW_K), 1 / F.greatest(rho, F.lit(1e-9)) - 1))).otherwise(F.when(rho.isNull(), F.lit(1.0)).otherwise(F.lit(HIGH_K)))
    return sums.select(k.alias("k"))


def reputation(labelled: DataFrame) -> DataFrame:
    """host, domain, suffix, bad (0/1 or null) -> a row per host: pages, mean, bound inputs.

    Returns host, pages (labelled or not), mean (posterior block rate), weight (its beta weight).
    """
    # A row per host: every later level is computed from this table, not from the pages again.
    hosts = written(labelled.groupBy("host", "domain", "suffix").agg(F.count("*").alias("pages"), F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("b")), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    root = suffixes.agg(((F.coalesce(F.sum("b"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("root"))
    rate = F.when(F.col("n") > 0, F.col("b") / F.col("n"))

    def shrunk(children: DataFrame, rate_above: str, mean_above: str, weight_above: Column, level: str, keep: list[str]) -> DataFrame:
        children = children.crossJoin(F.broadcast(_concentration(children, rate_above)))
        k = F.least(F.col("k"), weight_above)
        mean = (F.col("b") + k * F.col(mean_above)) / (F.col("n") + k)
        return children.select(*keep, rate.alias(f"{level}_rate"), mean.alias(f"{level}_mean"), (F.col("n") + k).alias(f"{level}_weight"))

    suffixes = shrunk(suffixes.crossJoin(F.broadcast(root)), "root", "root", F.lit(HIGH_K), "suffix", ["suffix"])
    domains = shrunk(domains.join(suffixes, "suffix"), "suffix_rate", "suffix_mean", F.col("suffix_weight"), "domain", ["domain"])
    hosts = shrunk(hosts.join(domains, "domain"), "domain_rate", "domain_mean", F.col("domain_weight"), "host", ["host", "pages"])
    return written(hosts.select("host", "pages", F.col("host_mean").alias("mean"), F.col("host_weight").alias("weight")), "reputation")


def judge(pages: DataFrame, rules: Sequence[Rule], url_col: str = "url", id_col: str = "page_id", z: float = 1.645, threshold: float = 0.5, hot: float = 0.001) -> DataFrame:
    """A row per page: id, host, path, rule (or null), verdict, block_rate, lower_bound."""
    host, path = url_parts(F.col(url_col))
    parsed = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    parsed = parsed.withColumn("fit", fitted_rule(F.col("host"), F.col("path"), rules))
    label = F.when(F.col("fit.verdict").isNotNull(), (F.col("fit.verdict") == "block").cast("int"))
    domain, suffix = registered(F.col("host"))
    stats = reputation(parsed.select("host", domain.alias("domain"), suffix.alias("suffix"), label.alias("bad")))
    total = stats.agg(F.coalesce(F.sum("pages"), F.lit(0))).first()[0]
    big = stats.filter(F.col("pages") > hot * total).select("host", F.col("mean").alias("m1"), F.col("weight").alias("w1"))
    rest = stats.filter(F.col("pages") <= hot * total).select(F.col("host").alias("key"), F.col("mean").alias("m2"), F.col("weight").alias("w2"))
    parsed = parsed.join(F.broadcast(big), "host", "left")
    # A page whose host is already resolved gets a key of its row's place, which no host has, so null and repeated ids spread too.
    own = F.concat(F.lit("/"), F.xxhash64(F.monotonically_increasing_id()).cast("string"))
    parsed = parsed.withColumn("key", F.when(F.col("m1").isNull(), F.col("host")).otherwise(own)).join(rest, "key", "left")
    mean, weight = F.coalesce("m1", "m2"), F.coalesce("w1", "w2")
    low = mean - z * F.sqrt(mean * (1 - mean) / (weight + 1))
    verdict = F.coalesce(F.col("fit.verdict"), F.when(low > threshold, "block").otherwise("allow"))
    return parsed.select(id_col, "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), mean.alias("block_rate"), low.alias("lower_bound"))
