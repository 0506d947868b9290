"""URL filters: rules on hosts and path prefixes, matched by hashed expressions.

A rule is a host and a path. It fits the host and all its subdomains if the URL's path starts
with the rule's path; of the rules that fit, the longest wins (host and path together, then the
host alone, then ``block`` before ``allow``). Every distinct URL is expanded into the
expressions that a rule could have: each suffix of its host at a dot, with each prefix of its path
that ends with a slash, up to the most labels and slashes that a rule has. Rules are filed under their host and their path up to its last slash.
Both sides meet in an equi-join on a short hash prefix; the full digest of the expression, and
the rest of the rule's path, then confirm the match.

Scale: each distinct (host, path) is judged once, counted on the map side first, so a hot
page costs no more than any other. The rule table is broadcast only if it is counted to be at
most ``BROADCAST_RULES`` rows; beyond that the distinct expressions are joined with the rules
(no expression is hot then) and what matched is brought back by a spread join.

Edge cases: a null URL, or one without ``://``, has an empty host and path and fits no rule of a
host; repeated rows keep their rows; no rule fits: the default verdict; an empty page or rule
table works; extra columns are carried through whatever their names, except for those that the result
itself has (``host``, ``path``, ``rule``, ``verdict``); very long hosts and paths cost their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthmill.llm.common import ascii_lower, spread_lookup
from monthmill.workspace import Workspace

#: Verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
BROADCAST_RULES = 100_000
DEFAULT = "allow"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, hash or the end; A-Z in lower case."""
    rest = F.substring_index(after_scheme(url), "/", 1)
    return ascii_lower(F.substring_index(F.substring_index(rest, "?", 1), "#", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to a question mark, hash or the end."""
    rest = F.substring_index(F.substring_index(after_scheme(url), "?", 1), "#", 1)
    slash = F.instr(rest, "/")
    return F.when(slash > 0, F.substring(rest, slash, F.length(rest))).otherwise(F.lit(""))


def after_scheme(url: Column) -> Column:
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    return F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))


def host_suffixes(host: Column, most: Column) -> Column:
    """``a.b.c``, ``b.c`` and ``c``, of ``most`` labels at most."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(labels) - most + 1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def path_prefixes(path: Column, most: Column) -> Column:
    """The empty prefix and every prefix that ends with a slash, with ``most`` slashes at most."""
    parts = F.split(path, "/")
    slashes = F.least(F.size(parts) - 1, most)
    return F.concat(
        F.array(F.lit("")),
        F.when(
            slashes > 0,
            F.transform(
                F.sequence(F.lit(1), slashes),
                lambda i: F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/")),
            ),
        ).otherwise(F.array().cast("array<string>")),
    )


def digest(host: Column, prefix: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, prefix), 256)


def rule_table(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def filed(rules: DataFrame) -> DataFrame:
    """Rules by hash prefix and digest; of equal host and path only the block rule counts."""
    one = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    host, path = ascii_lower(F.col("host")), F.coalesce("path", F.lit(""))
    directory = F.regexp_replace(path, "[^/]*$", "")
    return one.filter(F.col("host").isNotNull()).select(
        digest(host, directory).alias("_u_digest"),
        host.alias("_u_rule_host"), path.alias("_u_rule_path"), F.col("verdict").alias("_u_verdict"),
        F.size(F.split(host, r"\.")).alias("_u_labels"), (F.size(F.split(directory, "/")) - 1).alias("_u_slashes"),
    ).withColumn("_u_short", F.substring("_u_digest", 1, 8))


def judge(
    pages: DataFrame,
    rules: DataFrame,
    space: Workspace,
    url: str = "url",
    default: str = DEFAULT,
    broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """The pages with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``."""
    own = ("host", "path", "rule", "verdict")
    names = [f"`{name}`" for name in pages.columns if name.lower() not in own]
    address = F.col(f"`{url}`")
    # the page's columns travel as one, so none of them can meet a helper of the same name
    rows = space.write(
        pages.select(F.struct(*names).alias("_u_page"), host_of(address).alias("_u_host"), path_of(address).alias("_u_path")),
        "url-rows",
    )
    distinct = rows.groupBy("_u_host", "_u_path").agg(F.count(F.lit(1)).alias("_u_rows"))
    distinct = space.write(distinct, "url-distinct")
    table = filed(rules)
    # no rule has more labels or slashes, so longer expressions of a URL cannot meet one
    depth = table.agg(F.max("_u_labels"), F.max("_u_slashes")).first()
    labels, slashes = (F.lit(n or 0) for n in depth)
    table = table.drop("_u_labels", "_u_slashes")
    expressions = distinct.select(
        "_u_host", "_u_path", F.explode(host_suffixes(F.col("_u_host"), labels)).alias("_u_suffix")
    ).select(
        "_u_host", "_u_path",
        F.explode(F.transform(path_prefixes(F.col("_u_path"), slashes), lambda p: digest(F.col("_u_suffix"), p))).alias("_u_digest"),
    ).withColumn("_u_short", F.substring("_u_digest", 1, 8))
    if table.limit(broadcast_rules + 1).count() <= broadcast_rules:
        matches = expressions.join(F.broadcast(table), ["_u_short", "_u_digest"])
    else:
        expressions = space.write(expressions, "url-expressions")
        counted = expressions.groupBy("_u_short", "_u_digest").agg(F.count(F.lit(1)).alias("_u_uses"))
        found = counted.join(table, ["_u_short", "_u_digest"])
        packed = found.groupBy("_u_short", "_u_digest", "_u_uses").agg(
            F.collect_list(F.struct("_u_rule_host", "_u_rule_path", "_u_verdict")).alias("_u_rules")
        )
        packed = space.write(packed, "url-matched")
        total = expressions.count()
        matches = spread_lookup(expressions, packed, ["_u_short", "_u_digest"], "_u_uses", total)
        matches = matches.select("_u_host", "_u_path", F.inline("_u_rules"))
    fitting = matches.filter(F.col("_u_path").startswith(F.col("_u_rule_path")))
    best = F.max(F.struct(
        F.length(F.concat("_u_rule_host", "_u_rule_path")).alias("long"),
        F.length("_u_rule_host").alias("host_long"),
        F.col("_u_verdict").alias("verdict"),
        F.concat("_u_rule_host", "_u_rule_path").alias("rule"),
    ))
    judged = fitting.groupBy("_u_host", "_u_path").agg(best.alias("_u_best"))
    decided = space.write(
        distinct.join(judged, ["_u_host", "_u_path"], "left").filter(F.col("_u_best").isNotNull()),
        "url-decided",
    )
    total = distinct.agg(F.sum("_u_rows")).first()[0] or 0
    out = spread_lookup(rows, decided, ["_u_host", "_u_path"], "_u_rows", total)
    return out.select(
        "_u_page.*", F.col("_u_host").alias("host"), F.col("_u_path").alias("path"),
        F.col("_u_best")["rule"].alias("rule"),
        F.coalesce(F.col("_u_best")["verdict"], F.lit(default)).alias("verdict"),
    )
