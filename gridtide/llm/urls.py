"""URL filters: block and allow rules, carried over to aliases.

Pages that name each other by a canonical link or a redirect are one page.  The connected
components over these edges get one decision: a member that a rule allows outweighs members
that rules block, and a url's own rule outweighs its component.  DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .support import with_columns

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Production rules.
BLOCK = ("net/", "example.com/de/")
ALLOW = ("example.net/en/", "org/fr/")
#: Rules are held as a constant of the plan; longer lists need a table of their own.
MAX_RULES = 10_000


def lower(value: Column) -> Column:
    """A-Z only; other letters stay."""
    return F.translate(value, UPPER, UPPER.lower())


def rest_of(url: Column) -> Column:
    """What follows the first ``://``; empty for null and for urls without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(rest: Column) -> Column:
    return lower(F.regexp_extract(rest, "^([^/?#]*)", 1))


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def node_of(rest: Column) -> Column:
    """Name of a url in the graph: host, path and query without scheme and fragment.

    Null where there is no host.
    """
    tail = F.regexp_extract(rest, "^[^/?#]*([^#]*)", 1)
    tail = F.when(F.startswith(tail, F.lit("/")), tail).otherwise(F.concat(F.lit("/"), tail))
    return F.when(F.regexp_like(rest, F.lit("^[^/?#]")), F.concat(host_of(rest), tail))


def rule_for(host: Column, path: Column, block=BLOCK, allow=ALLOW) -> Column:
    """Struct (size, allow, rule) of the longest rule that fits, or null.

    A rule ``host/path`` fits its host and all subdomains where the url's path starts with the
    rule's.  Of rules of equal length one that allows wins, then the larger text.
    """
    if len(block) + len(allow) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    by_host: dict[str, list[tuple[str, int, str]]] = {}
    for rules, kind in ((block, 0), (allow, 1)):
        for rule in rules:
            name, slash, rest = rule.partition("/")
            by_host.setdefault(name, []).append((slash + rest, kind, rule))
    if not by_host:
        return F.lit(None).cast("struct<size:int,allow:int,rule:string>")
    pairs = []
    for name, rules in sorted(by_host.items()):
        options = [
            F.struct(
                F.lit(start).alias("start"), F.lit(len(rule)).alias("size"),
                F.lit(kind).alias("allow"), F.lit(rule).alias("rule"),
            )
            for start, kind, rule in rules
        ]
        pairs += [F.lit(name), F.array(*options)]
    known = F.create_map(*pairs)
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    options = F.flatten(F.filter(F.transform(suffixes, lambda s: known[s]), lambda x: x.isNotNull()))
    fitting = F.filter(options, lambda r: F.startswith(path, r["start"]))
    ranked = F.transform(
        fitting,
        lambda r: F.struct(r["size"].alias("size"), r["allow"].alias("allow"), r["rule"].alias("rule")),
    )
    return F.array_max(ranked)


def targets_of(html: Column) -> Column:
    """Array of the targets of canonical links and refresh redirects, as written."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<script\b.*?</script>", " ")
    links = F.regexp_extract_all(bare, F.lit(r"(?i)(<link\b[^>]*>)"), 1)
    links = F.filter(links, lambda t: F.regexp_like(t, F.lit(r"(?i)\brel\s*=\s*[\"']?\s*canonical\b")))
    hrefs = F.transform(
        links, lambda t: F.regexp_extract(t, r"(?i)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)", 1)
    )
    metas = F.regexp_extract_all(bare, F.lit(r"(?i)(<meta\b[^>]*>)"), 1)
    metas = F.filter(
        metas, lambda t: F.regexp_like(t, F.lit(r"(?i)\bhttp-equiv\s*=\s*[\"']?\s*refresh\b"))
    )
    moves = F.transform(
        metas, lambda t: F.regexp_extract(t, r"(?i)\burl\s*=\s*[\"']?\s*([^\"'\s>]+)", 1)
    )
    return F.transform(F.concat(hrefs, moves), lambda x: F.replace(x, F.lit("&amp;"), F.lit("&")))


def absolute(target: Column, host: Column, path: Column) -> Column:
    """Target without its scheme, seen from a page; null for targets that are no pages."""
    return (
        F.when(F.regexp_like(target, F.lit("(?i)^https?://")), rest_of(target))
        .when(F.startswith(target, F.lit("//")), F.substring(target, 3, 1 << 30))
        .when(F.startswith(target, F.lit("/")), F.concat(host, target))
        .when((target == "") | F.regexp_like(target, F.lit("^#|^[A-Za-z][A-Za-z0-9+.-]*:")), None)
        .when(F.startswith(target, F.lit("?")), F.concat(host, path, target))
        .when(F.instr(path, "/") > 0, F.concat(host, F.regexp_extract(path, "^(.*/)", 1), target))
        .otherwise(F.concat(host, F.lit("/"), target))
    )


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``a, b``: nodes that a canonical link or redirect joins, each pair once."""
    rest = rest_of(F.col(url))
    host, path = host_of(rest), path_of(rest)
    nodes = F.transform(targets_of(F.col(html)), lambda t: node_of(absolute(t, host, path)))
    edges = pages.where(F.instr(html, "<") > 0).select(node_of(rest).alias("a"), F.explode(nodes).alias("b"))
    return edges.where("a is not null and b is not null and a <> b").distinct()


def alias_verdicts(edges: DataFrame, block=BLOCK, allow=ALLOW) -> DataFrame:
    """``node, class_verdict`` of every node in an edge: allow, block, or null without any rule."""
    nodes = connected_components(edges)
    rule = rule_for(host_of(F.col("node")), path_of(F.col("node")), block, allow)
    judged = nodes.select("node", "root", rule["allow"].alias("allow"))
    verdict = judged.groupBy("root").agg(F.max("allow").alias("allow"))
    verdict = verdict.select(
        "root", F.when(F.col("allow") == 1, "allow").when(F.col("allow") == 0, "block").alias("class_verdict")
    )
    return nodes.join(verdict, "root").select("node", "class_verdict")


def judge(
    pages: DataFrame, block=BLOCK, allow=ALLOW, url: str = "url", html: str = "html"
) -> DataFrame:
    """Add ``host, path, rule, verdict`` (and ``alias_verdict``) to each page.

    * a null url, or one without ``://``, has empty host and path, no rule and no aliases: allow;
    * null or empty html names no alias; links inside comments and scripts do not count;
    * pages without rule follow their component, and are allowed where it has no rule either;
    * equal urls get equal verdicts, repeated rows stay repeated, an empty table gives an empty
      result; input columns with a result's name are replaced.
    """
    verdicts = alias_verdicts(alias_edges(pages, url, html), block, allow)
    rest = rest_of(F.col(url))
    host, path = host_of(rest), path_of(rest)
    best = rule_for(host, path, block, allow)
    one = with_columns(
        pages, {"host": host, "path": path, "_best": best, "_node": node_of(rest)}
    )
    both = one.join(verdicts.withColumnRenamed("node", "_node"), "_node", "left")
    own = F.when(F.col("_best.allow") == 1, "allow").when(F.col("_best.allow") == 0, "block")
    return with_columns(
        both,
        {
            "rule": F.col("_best.rule"),
            "alias_verdict": F.col("class_verdict"),
            "verdict": F.coalesce(own, F.col("class_verdict"), F.lit("allow")),
        },
    ).drop("_best", "_node", "class_verdict")
