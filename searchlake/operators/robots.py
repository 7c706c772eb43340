"""robots.txt rules as tables: parse (P9), group selection (W2), rule match
(J3), longest-match decision (W1) and the discovered-link filter (J7).

Input ``robots(domain, content)``: one row per host.  A robots file is
bounded in size, so the per-domain window work below never grows with the
number of URLs; URLs meet the rules in one join on ``domain`` with the
wildcard match as a residual condition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from searchlake.constants import USER_AGENT
from searchlake.functions import urls

# Characters escaped when a robots pattern becomes a regex ('*' and a final
# '$' are handled separately).
REGEX_SPECIALS = r"([\\.\[\]{}()+\-^?|])"
JAVA_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"


def _jtrim(c):
    return F.regexp_replace(c, JAVA_TRIM, "")


def robots_lines(robots: DataFrame) -> DataFrame:
    """``(domain, line_no, directive, value)`` for user-agent / allow /
    disallow lines; comments stripped, lines without ':' ignored."""
    raw = robots.select(
        "domain", F.posexplode(F.split(F.coalesce("content", F.lit("")), r"\r?\n")).alias("line_no", "raw")
    )
    line = _jtrim(F.substring_index("raw", "#", 1))
    parsed = raw.select("domain", "line_no", line.alias("line")).where(F.instr("line", ":") > 0)
    return parsed.select(
        "domain",
        "line_no",
        F.lower(_jtrim(F.substring_index("line", ":", 1))).alias("directive"),
        _jtrim(F.expr("substring(line, instr(line, ':') + 1)")).alias("value"),
    ).where(F.col("directive").isin("user-agent", "allow", "disallow"))


def robots_rules(robots: DataFrame, user_agent: str = USER_AGENT, empty_disallow_allows: bool = False) -> DataFrame:
    """P9 + W2: the rules of the group chosen for ``user_agent`` per domain:
    ``(domain, pattern, allow, rx)``.

    Every ``User-agent`` line opens a group (running sum over line numbers).
    Choice: exact agent (last wins) > longest agent that is a prefix of ours
    (first wins ties) > ``*`` (last wins).  No group or no rules = allow all,
    i.e. no rows.  An empty ``Disallow:`` matches every path and so blocks
    the site (reference behaviour); ``empty_disallow_allows=True`` follows
    the robots standard instead and ignores it.
    """
    ua = user_agent.lower()
    lines = robots_lines(robots)
    w = Window.partitionBy("domain").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("grp", F.sum((F.col("directive") == "user-agent").cast("int")).over(w))
    groups = lines.where(F.col("directive") == "user-agent").select(
        "domain", "grp", F.lower("value").alias("agent")
    )
    cls = (
        F.when(F.col("agent") == "*", F.lit(2))
        .when(F.col("agent") == F.lit(ua), F.lit(0))
        .when(F.lit(ua).startswith(F.col("agent")), F.lit(1))
    )
    groups = groups.withColumn("cls", cls).where(F.col("cls").isNotNull())
    order = Window.partitionBy("domain").orderBy(
        "cls",
        F.when(F.col("cls") == 1, -F.length("agent")).otherwise(F.lit(0)),
        F.when(F.col("cls") == 1, F.col("grp")).otherwise(-F.col("grp")),
    )
    chosen = groups.withColumn("rn", F.row_number().over(order)).where("rn = 1").select("domain", "grp")
    rules = lines.where(F.col("directive") != "user-agent").join(chosen, ["domain", "grp"])
    if empty_disallow_allows:
        rules = rules.where(~((F.col("directive") == "disallow") & (F.col("value") == "")))
    return rules.select(
        "domain",
        F.col("value").alias("pattern"),
        (F.col("directive") == "allow").alias("allow"),
        pattern_regex("value").alias("rx"),
    )


def pattern_regex(pattern) -> F.Column:
    """Robots wildcard -> anchored regex: ``*`` -> ``.*``; a final ``$``
    anchors the end, otherwise a prefix match; regex metacharacters escaped
    (a ``$`` elsewhere is left as is, so it acts as an anchor)."""
    p = F.col(pattern) if isinstance(pattern, str) else pattern
    anchored = p.endswith("$")
    body = F.when(anchored, F.regexp_replace(p, r"\$$", "")).otherwise(p)
    esc = F.regexp_replace(body, REGEX_SPECIALS, r"\\$1")
    esc = F.regexp_replace(esc, r"\*", ".*")
    return F.concat(F.lit("^"), esc, F.when(anchored, F.lit("$")).otherwise(F.lit(".*")))


def _normalize_path(path: F.Column) -> F.Column:
    return F.when(path.isNull() | (F.trim(path) == ""), F.lit("/")).when(
        path.startswith("/"), path
    ).otherwise(F.concat(F.lit("/"), path))


def rules_by_domain(rules: DataFrame) -> DataFrame:
    """One row per domain with its rule list (bounded by one robots file)."""
    prefix = ~F.col("pattern").contains("*") & ~F.col("pattern").contains("$")
    return rules.groupBy("domain").agg(
        F.collect_list(F.struct("pattern", "allow", "rx", prefix.alias("prefix"))).alias("_rules")
    )


def robots_allowed(targets: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """J3 + W1: ``targets`` plus ``allowed`` for each URL.

    Rules of the URL's host whose pattern matches the robots path are taken
    (equi join on the host, wildcard regex evaluated on the joined rule
    list); the longest pattern wins, equal length -> allow wins, no match ->
    allowed.  A URL without a parsable host is disallowed; a host without
    robots rules is allowed.  Adaptive execution broadcasts the per-domain
    rule lists when their bytes allow it; otherwise it is a shuffle join on
    the host, and a hot host's URLs are split by its skew handling.
    """
    per_domain = rules_by_domain(rules).withColumnRenamed("domain", "_domain")
    t = targets.withColumn("_domain", urls.host(url)).withColumn(
        "_path", _normalize_path(urls.robots_path(url))
    )
    j = t.join(per_domain, "_domain", "left")
    # Plain prefixes (no '*', no '$') match with startswith -- the same as
    # their anchored regex, without compiling a pattern per row.
    hits = F.filter(
        F.coalesce("_rules", F.array()),
        lambda r: F.when(r["prefix"], F.col("_path").startswith(r["pattern"])).otherwise(
            F.regexp_like(F.col("_path"), r["rx"])
        ),
    )
    best = F.array_max(F.transform(hits, lambda r: F.struct(F.length(r["pattern"]).alias("n"), r["allow"].alias("allow"))))
    allowed = F.when(F.col("_domain").isNull(), F.lit(False)).otherwise(F.coalesce(best["allow"], F.lit(True)))
    return j.select(*targets.columns, allowed.alias("allowed"))


def filter_links(edges: DataFrame, rules: DataFrame, allowed_domain: str | None, dst: str = "dst") -> DataFrame:
    """Keep discovered links that pass the domain filter and robots."""
    inside = edges.where(urls.domain_allowed(dst, allowed_domain))
    return robots_allowed(inside, rules, dst).where("allowed").drop("allowed")
