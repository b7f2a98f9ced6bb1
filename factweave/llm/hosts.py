"""URL filters: rules by host and path, and an empirical-Bayes reputation of hosts.

Labelled page outcomes (bad or not) are counted per host, registered domain and
suffix. Each level's rate is shrunk towards the level above by a beta prior: the
suffix towards the overall rate, the domain towards its suffix, the host towards
its domain. The strength of each prior is estimated from how much the groups of
that level differ beyond chance (a moment estimate of the beta-binomial's
intra-class correlation): where they do not differ, a group's rate is that of the
level above. A host is blocked if the lower bound of its posterior bad rate lies
above ``worse`` times the rate of all labelled pages.

Every level is counted once and written, and the driver only sees its sums, so no
level is planned again for the next.

Cases: a null url, or one without ``://``, has empty host and path and is judged
by the overall rate; null outcomes are ignored; unlabelled hosts take their
domain's prior; without any outcome nothing is blocked; long urls are read whole;
repeated rows give repeated rows; empty tables give no rows; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factweave.llm.common import pick, stash

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Labels under which country domains register names (fixed values of public registries), as in ``co.uk``.
SECOND_LEVEL = tuple("ac asn art co com edu firm gen go gob gouv gov govt gv id ind info int ltd me mil muni ne net nhs nic nom or org plc police pro sch school web".split())
#: Suffixes of other forms under which unrelated parties have names (fixed values of public registries and hosting services).
SHARED = tuple("appspot.com azurewebsites.net blogspot.com cloudfront.net firebaseapp.com fly.dev github.io gitlab.io herokuapp.com netlify.app pages.dev readthedocs.io surge.sh tumblr.com vercel.app web.app weebly.com wixsite.com wordpress.com workers.dev".split())
#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: A table of hosts with at most so many rows is broadcast; a larger one is joined by shuffle, skew split by adaptive execution.
BROADCAST_HOSTS = 50_000
#: A host is blocked if its rate is, at this many deviations, above so many times the rate of all labelled pages.
Z, WORSE = 1.64, 1.0
#: Bounds of the estimated intra-class correlation, so that priors stay finite and proper.
LEAST_RHO, MOST_RHO = 1e-9, 0.999


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict, or null."""
    rule = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # later, longer rules stand outside
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """The registered domain (one label more than the suffix) and the suffix."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    last, second = F.try_element_at(labels, F.lit(-1)), F.try_element_at(labels, F.lit(-2))
    pair = F.concat_ws(".", second, last)
    double = (n >= 3) & ((F.length(last) == 2) & second.isin(*SECOND_LEVEL) | pair.isin(*SHARED))
    suffix = F.when(double, pair).otherwise(last)
    domain = F.when(double, F.concat_ws(".", F.try_element_at(labels, F.lit(-3)), second, last)).otherwise(pair)
    return domain, suffix


def _sums(groups: DataFrame) -> tuple[DataFrame, float]:
    """``groups`` (``n, bad, prior``), written, and the strength of their prior."""
    groups = stash(groups, "reputation")
    spread = (F.col("bad") / F.col("n") - F.col("prior")) ** 2 * F.col("n") / (F.col("prior") * (1 - F.col("prior")))
    s, g, n = groups.where("n > 0 and prior > 0 and prior < 1").agg(F.sum(spread), F.count("*"), F.sum("n")).first()
    rho = (s - g) / (n - g) if g and n > g else 0.0
    return groups, 1 / min(MOST_RHO, max(LEAST_RHO, rho)) - 1


def _joined(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """``left`` with the columns of ``right``, one row for each value of ``on``; broadcast if it has few rows."""
    return left.join(F.broadcast(right) if right.count() <= BROADCAST_HOSTS else right, on)


def reputation(outcomes: DataFrame) -> tuple[DataFrame, float]:
    """``host, n, bad, alpha, beta``: the posterior of every host in ``outcomes`` (``host, n, bad``, one row a host); and the overall rate."""
    domain, suffix = domain_and_suffix(F.col("host"))
    hosts = stash(outcomes.withColumn("domain", domain).withColumn("suffix", suffix), "hosts")
    n, bad = hosts.agg(F.coalesce(F.sum("n"), F.lit(0.0)), F.coalesce(F.sum("bad"), F.lit(0.0))).first()
    overall = (bad + 0.5) / (n + 1.0)
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]

    def mean(k: float) -> Column:
        return ((F.col("prior") * k + F.col("bad")) / (F.lit(k) + F.col("n"))).alias("prior")

    suffixes, k = _sums(hosts.groupBy("suffix").agg(*sums).withColumn("prior", F.lit(overall)))
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    domains, k = _sums(_joined(domains, suffixes.select("suffix", mean(k)), "suffix"))
    hosts, k = _sums(_joined(hosts.drop("suffix"), domains.select("domain", mean(k)), "domain"))
    alpha, beta = F.col("prior") * k + F.col("bad"), (1 - F.col("prior")) * k + F.col("n") - F.col("bad")
    return hosts.select("host", "n", "bad", alpha.alias("alpha"), beta.alias("beta")), overall


def lower_bound(alpha: Column, beta: Column, z: float = Z) -> Column:
    """Lower bound of a beta posterior, by its mean and deviation."""
    mean = alpha / (alpha + beta)
    return mean - z * F.sqrt(mean * (1 - mean) / (alpha + beta + 1))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, z: float = Z, worse: float = WORSE) -> DataFrame:
    """``page_id, host, path, rule, verdict, bad_rate_bound`` for every row of ``pages`` (``page_id, url``).

    ``outcomes`` has ``url, bad`` (1 bad, 0 not, null unknown) rows of labelled pages.
    """
    rows = pick(pages, page_id="page_id", url="url")
    host, path = host_and_path(F.col("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    labelled = pick(outcomes, url="url", bad="bad").where("bad is not null")
    seen = labelled.select(host_and_path(F.col("url"))[0].alias("host"), F.col("bad").cast("double").alias("bad"), F.lit(1.0).alias("one"))
    unseen = rows.select("host", F.lit(0.0).alias("bad"), F.lit(0.0).alias("one"))
    counts = seen.unionByName(unseen).groupBy("host").agg(F.sum("one").alias("n"), F.sum("bad").alias("bad"))
    hosts, overall = reputation(counts)
    hosts = hosts.select("host", lower_bound(F.col("alpha"), F.col("beta"), z).alias("bad_rate_bound"))
    rule, by_rule = matching_rule(F.col("host"), F.col("path"), rules)
    # Beyond rounding: where hosts do not differ, all bounds are the overall rate.
    by_method = F.when(F.col("bad_rate_bound") > worse * overall + 1e-6, "block").otherwise("allow")
    return _joined(rows, hosts, "host").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(by_rule, by_method).alias("verdict"), "bad_rate_bound")


#: The document that a page shows, as its url names it.
PAGE_DOCUMENT = r"^/[a-z]+/([0-9]{1,18})"


def label_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``url, bad`` of the pages whose document is labelled: bad if of low quality or toxic."""
    url = pick(pages, url="url")
    doc = F.expr("try_cast(nullif(document, '') as bigint)")
    url = url.withColumn("document", F.regexp_extract(host_and_path(F.col("url"))[1], PAGE_DOCUMENT, 1)).withColumn("doc", doc)
    known = pick(labels, doc="doc_id", quality="quality", toxic="toxic")
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    return url.join(known, "doc").select("url", bad.alias("bad"))


def oracle_sql() -> str:
    """The same judgement in DuckDB SQL, for ``pages`` and ``labels``."""
    cases = {"rule": "", "verdict": ""}
    for kind, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        fits = f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
        cases["rule"] += f"WHEN {fits} THEN '{h + p}' "
        cases["verdict"] += f"WHEN {fits} THEN '{kind}' "
    second, shared = (", ".join(f"'{x}'" for x in names) for names in (SECOND_LEVEL, SHARED))

    def strength(name: str) -> str:
        return f"""(SELECT 1 / least({MOST_RHO}, greatest({LEAST_RHO}, CASE WHEN g > 0 AND n > g THEN (s - g) / (n - g) ELSE 0.0 END)) - 1 AS k FROM
            (SELECT sum(pow(bad / n - prior, 2) * n / (prior * (1 - prior))) AS s, count(*) AS g, sum(n) AS n FROM {name} WHERE n > 0 AND prior > 0 AND prior < 1))"""

    mean = "(prior * k + bad) / (k + n)"
    return f"""
    WITH rest AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
    hosted AS (SELECT page_id, url, r, regexp_extract(r, '^[^/?#]*') AS raw FROM rest),
    rows_ AS (SELECT page_id, url, translate(raw, '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(r, length(raw) + 1), '^[^?#]*') AS path FROM hosted),
    labelled AS (SELECT host, CASE WHEN quality = 0 OR toxic = 1 THEN 1.0 WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 0.0 END AS bad
        FROM rows_ JOIN labels ON labels.doc_id = try_cast(nullif(regexp_extract(path, '{PAGE_DOCUMENT}', 1), '') AS BIGINT)),
    counts AS (SELECT host, sum(one) AS n, sum(bad) AS bad FROM
        (SELECT host, bad::DOUBLE AS bad, 1.0::DOUBLE AS one FROM labelled WHERE bad IS NOT NULL UNION ALL SELECT host, 0.0::DOUBLE, 0.0::DOUBLE FROM rows_) GROUP BY host),
    split AS (SELECT *, string_split(host, '.') AS l FROM counts),
    hosts0 AS (SELECT host, n, bad, CASE WHEN d THEN concat_ws('.', l[-3], l[-2], l[-1]) ELSE concat_ws('.', l[-2], l[-1]) END AS domain, CASE WHEN d THEN concat_ws('.', l[-2], l[-1]) ELSE l[-1] END AS suffix
        FROM (SELECT *, len(l) >= 3 AND (length(l[-1]) = 2 AND l[-2] IN ({second}) OR concat_ws('.', l[-2], l[-1]) IN ({shared})) AS d FROM split)),
    overall AS (SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1.0) AS rate FROM hosts0),
    s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT rate FROM overall) AS prior FROM hosts0 GROUP BY suffix),
    s1 AS (SELECT suffix, {mean} AS prior FROM s0, {strength("s0")}),
    d0 AS (SELECT domain, hosts0.suffix, sum(n) AS n, sum(bad) AS bad, any_value(prior) AS prior FROM hosts0 JOIN s1 ON hosts0.suffix = s1.suffix GROUP BY ALL),
    d1 AS (SELECT domain, suffix, {mean} AS prior FROM d0, {strength("d0")}),
    h0 AS (SELECT host, n, bad, prior FROM hosts0 JOIN d1 ON hosts0.domain = d1.domain AND hosts0.suffix = d1.suffix),
    h1 AS (SELECT host, prior * k + bad AS a, (1 - prior) * k + n - bad AS b FROM h0, {strength("h0")}),
    h2 AS (SELECT host, a / (a + b) - {Z} * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) AS bound FROM h1)
    SELECT page_id, host, path, CASE {cases["rule"]} END AS rule,
        CASE {cases["verdict"]} WHEN bound > {WORSE} * rate + 1e-6 THEN 'block' ELSE 'allow' END AS verdict, round(bound, 6) AS bad_rate_bound
    FROM rows_ JOIN h2 USING (host), overall"""
