"""URL filter by rules and by a tree of path templates (DataFrame operations only).

A rule ``host/path`` fits the urls of its host and all subdomains whose path starts with the rule's path; the longest
fitting rule decides. All other urls are judged by the template of their path.

Templates grow level by level, for all hosts at once. Digits become ``{n}`` and long hexadecimal names ``{id}``. At a
node of the tree a segment becomes the wildcard ``*`` when the node has many children of which it is a rare one.
Sibling branches are compared by their share of bad labels (two-proportion tests): those like their siblings merge
into ``*``, and those above or below them that are like each other into ``*+`` or ``*-``. Branches thus stay apart
only where they are frequent and differ. A template is rejected when its bad share, smoothed towards its
host's and that towards the share of all hosts with (or without) a name part from ``BAD_NAMES``, reaches ``REJECT``.

Labels are 1 (bad), 0 (good) or null. Without a label column, ``weak_labels`` marks each url by itself: bad when its
host or path has a name part from ``BAD_NAMES`` or its page's text has ``PAGE_WORDS`` of them, else good, and null where
a blocking rule decides. The labels thus differ inside of a host, and its tree tells the branches apart. What uses none
of these words is not found.

Skew: urls are first counted per host and path, every count is combined before its shuffle, and a node joins one row
of totals, so a hot host or node can be split. Paths grow to their last name. Names that all paths below a node begin
with are taken at once, and where paths only end on the way of a longer one that way is taken to its first branch in the
round after; so the number of rounds follows the branches on a path, not its length.

Defined results: null urls and urls without ``://`` have an empty host and path, no rule, and the verdict of the empty
template; repeated urls get equal verdicts; an empty table gives no rows.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medalith.llm.frames import column, stored

MANY_CHILDREN = 16
RARE_SHARE = 0.05
DIFFERENT_Z = 1.96
PRIOR_URLS = 5.0
REJECT = 0.5
PAGE_WORDS = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Fixed rules: verdict by host and path.
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
#: Fixed words that count as labelled bad in names of hosts and paths, and several times in a page.
BAD_NAMES = (
    "ads", "adult", "bets", "betting", "casino", "gambling", "phishing", "pills", "poker", "porn", "slots", "spam", "viagra",
    "warez", "xxx",
)


def with_parts(pages: DataFrame, url_col: str = "url") -> list[Column]:
    """Host and path of a url, both empty without ``://``."""
    url = F.coalesce(column(pages, url_col).cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return [F.when(at > 0, host).otherwise("").alias("host"), F.when(at > 0, path).otherwise("").alias("path")]


def rule_of(rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits the columns ``host`` and ``path``, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit("/" + path))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _listed(names: Column) -> Column:
    return F.arrays_overlap(names, F.array(*[F.lit(name) for name in BAD_NAMES]))


def _page_words(html: Column) -> Column:
    """How many words of a page's text are listed."""
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return F.coalesce(F.regexp_count(text, F.lit(rf"(?i)\b(?:{'|'.join(BAD_NAMES)})\b")), F.lit(0))


def weak_labels(rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """Label of the columns ``host``, ``path`` and ``page_words``."""
    path_names = F.split(F.translate("path", UPPER, LOWER), "[^a-z]+")
    bad = _listed(F.split("host", "[.-]")) | _listed(path_names) | (F.col("page_words") >= PAGE_WORDS)
    return F.when(bad, 1).when(rule_of(rules)[1] == "block", None).otherwise(0)


def _segments() -> Column:
    """The path's names with digits and identifiers generalised."""
    names = F.filter(F.split("path", "/"), lambda s: s != "")
    return F.transform(
        names, lambda s: F.when(s.rlike("^[0-9a-fA-F-]{16,}$"), "{id}").otherwise(F.regexp_replace(s, "[0-9]+", "{n}"))
    )


def _side(total: str) -> Column:
    """-1 or 1 when a child's bad share is below or above that of all its siblings in the totals, 0 when it is alike."""
    own, rest = F.nullif(F.col("labelled"), F.lit(0)), F.nullif(F.col(f"labelled_{total}") - F.col("labelled"), F.lit(0))
    pooled = F.col(f"bad_{total}") / (own + rest)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / own + 1 / rest))
    apart = F.col("bad") / own - (F.col(f"bad_{total}") - F.col("bad")) / rest
    return F.when((spread > 0) & (F.abs(apart) > DIFFERENT_Z * spread), F.signum(apart).cast("int")).otherwise(0)


def _totals(children: DataFrame, keys: list[str], total: str) -> DataFrame:
    sums = [F.sum(c).alias(f"{c}_{total}") for c in ("n", "labelled", "bad")]
    return children.groupBy(*keys).agg(F.count("*").alias(f"children_{total}"), *sums)


def path_templates(spark: SparkSession, urls: DataFrame) -> DataFrame:
    """``host, path, template, n, labelled, bad`` for the distinct urls of ``urls(host, path, label)``.

    ``reach`` is how many names a path goes along with the longest one of its node before it leaves it; null if it does
    not, zero where that is not known.
    """
    counted = urls.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).cast("long").alias("bad")
    )
    start = counted.select("*", _segments().alias("names"), F.lit("").alias("template"), F.lit(0).alias("reach"))
    tree = stored(spark, start, "url-tree-0")
    done, depth = [], 0
    while True:
        done.append(tree.where(F.size("names") == 0).drop("names", "reach"))
        tree = tree.where(F.size("names") > 0)
        if not tree.limit(1).count():
            break
        depth += 1
        # a name ends with a slash, so all names between two ordered ones share what these share
        here = tree.withColumn("child", F.get("names", F.lit(0))).withColumn("rest", F.concat(F.array_join("names", "/"), F.lit("/")))
        children = here.groupBy("host", "template", "child").agg(
            *[F.sum(c).alias(c) for c in ("n", "labelled", "bad")], F.min("rest").alias("low"), F.max("rest").alias("high"),
            F.max_by("rest", F.size("names")).alias("longest"), F.min("reach").alias("known"),
        )
        sided = children.join(_totals(children, ["host", "template"], "node"), ["host", "template"]).withColumn("side", _side("node"))
        rare = (F.col("children_node") > MANY_CHILDREN) & (F.col("n") < RARE_SHARE * F.col("n_node"))
        # branches on the same side of their siblings may still be alike among themselves
        grouped = sided.join(_totals(sided, ["host", "template", "side"], "side"), ["host", "template", "side"])
        alike = (F.col("children_side") > 1) & (_side("side") == 0)
        merged = F.when(F.col("side") > 0, "*+").when(F.col("side") < 0, "*-").otherwise("*")
        name = F.when(alike, merged).when(rare, "*").otherwise(F.col("child"))
        shared = _common(_names("low"), _names("high"))
        known = F.coalesce("known", F.size(_names("longest")))
        alone = F.col("children_node") == 1
        named = grouped.select(
            "host", "template", "child", "longest", name.alias("name"), F.when(alone, F.greatest(shared, known)).otherwise(1).alias("skip")
        )
        joined = here.join(named, ["host", "template", "child"]).withColumn("taken", F.least(F.size("names"), "skip"))
        own = F.array_join(F.slice("names", F.lit(1), F.col("taken")), "/")
        grown = F.concat("template", F.lit("/"), F.when(F.col("name") == F.col("child"), own).otherwise(F.col("name")))
        along = _common(F.col("names"), _names("longest"))
        reach = F.when(F.col("name") != F.col("child"), 0).when(along < F.size("names"), along - F.col("taken"))
        left = F.slice("names", F.col("taken") + 1, F.size("names"))
        kept = joined.select("host", "path", "n", "labelled", "bad", left.alias("names"), grown.alias("template"), reach.alias("reach"))
        tree = stored(spark, kept, f"url-tree-{depth}")
    return functools.reduce(DataFrame.unionByName, done)


def _names(joined: str) -> Column:
    """The names of a text in which each one ends with a slash."""
    return F.split(F.expr(f"substring({joined}, 1, length({joined}) - 1)"), "/")


def _common(one: Column, two: Column) -> Column:
    """How many names two paths begin with in common."""
    differ = F.array_position(F.zip_with(one, two, lambda a, b: a.eqNullSafe(b)), F.lit(False))
    return F.when(differ == 0, F.size(one)).otherwise(differ - 1).cast("int")


def template_purity(templates: DataFrame) -> DataFrame:
    """``host, template, bad_share``: the smoothed share of bad labels of each template."""
    listed = _listed(F.split("host", "[.-]"))
    zero = F.lit(0)
    sums = [F.coalesce(F.sum(F.when(listed == kind, F.col(c))), zero).alias(f"{c}_{kind}") for kind in (True, False) for c in ("labelled", "bad")]
    total = templates.agg(*sums).first()
    of_listed, of_others = ((total[f"bad_{kind}"] + 0.5) / (total[f"labelled_{kind}"] + 1.0) for kind in (True, False))
    overall = F.first(F.when(listed, of_listed).otherwise(of_others))  # of a host, the same in all its rows
    hosts = templates.groupBy("host").agg(
        ((F.sum("bad") + PRIOR_URLS * overall) / (F.sum("labelled") + PRIOR_URLS)).alias("host_share")
    )
    own = templates.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")).join(hosts, "host")
    share = (F.col("bad") + PRIOR_URLS * F.col("host_share")) / (F.col("labelled") + PRIOR_URLS)
    return own.select("host", "template", share.alias("bad_share"))


def judge(
    spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", label_col: str | None = None,
    rules: tuple[tuple[str, str], ...] = RULES, html_col: str = "html",
) -> DataFrame:
    """``<id>, host, path, rule, verdict, template, bad_share`` for every row."""
    label = column(pages, label_col).cast("int").alias("label") if label_col else F.lit(None).cast("int").alias("label")
    page_words = _page_words(column(pages, html_col).cast("string")) if html_col in pages.columns and label_col is None else F.lit(0)
    urls = pages.select(column(pages, id_col).alias("id"), *with_parts(pages, url_col), label, page_words.alias("page_words"))
    if label_col is None:
        urls = urls.withColumn("label", weak_labels(rules))
    templates = path_templates(spark, urls.select("host", "path", "label"))
    shares = templates.select("host", "path", "template").join(template_purity(templates), ["host", "template"])
    rule, verdict = rule_of(rules)
    judged = urls.drop("label", "page_words").join(shares, ["host", "path"], "left")
    by_template = F.when(F.col("bad_share") >= REJECT, "block").otherwise("allow")
    return judged.select(
        F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, by_template).alias("verdict"), "template", "bad_share"
    )
