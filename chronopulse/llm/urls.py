"""URL filters: explicit host and path rules first, then a tree of path templates per host.

The tree's first level is the host, the next ones are path segments. Segments that vary (numbers, hashes, dates, or
more different ones under one parent than a limit) become wildcards; sibling branches whose labelled shares of blocked
urls do not differ significantly merge into a wildcard; a template is rejected if its smoothed labelled purity, the
share of its labelled urls that are blocked, reaches a threshold. Unlabelled branches join siblings if all labelled
ones merge. Other templates without labels go by the nearest ancestor in their host's tree, the host at last, with at
least two labelled branches; else by related hosts: by their template, or its nearest ancestor, in a tree of the paths
of all hosts under the longest suffix of their host (example.org, then org, at last all hosts) where at least two hosts
have labels there. A single branch, or a single host, does not tell how others are. agreement() measures what such
verdicts are worth.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import cut, discard, small, stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Segments that vary by their form: numbers and dates, with an extension or not; hex strings; uuids.
_VARIABLE = r"^(\d[\d_.-]*(\.[a-z]{1,5})?|[0-9a-fA-F]{12,}|[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})$"


@dataclass(frozen=True)
class Rule:
    """Blocks or allows a host, its subdomains and the paths that start with a path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


@dataclass(frozen=True)
class TreeConfig:
    """depth: levels at which segments widen and merge and labels are inherited (deeper ones are told apart as they are,
    so templates hold whole paths); suffix: labels of the
    longest suffix that makes hosts related; most_children: literal siblings before they all become a wildcard; chi_square: largest statistic of two branches that merge, with one degree of freedom (3.84: a
    p-value of 0.05); prior_weight: labelled urls that the overall share of blocked ones counts as; least_labelled,
    purity: when a template is rejected."""

    depth: int = 32
    suffix: int = 8
    most_children: int = 32
    chi_square: float = 3.84
    prior_weight: float = 2.0
    least_labelled: int = 5
    purity: float = 0.8


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; null or no "://": empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end; null or no "://": empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, else nulls; of rules of equal length the first by text."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _segments(path: Column) -> Column:
    """The path's non-empty segments, those that vary by their form as "*"."""
    every = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(every, lambda s: F.when(s.rlike(_VARIABLE), F.lit("*")).otherwise(s))


def _suffixes(host: Column, most: int) -> Column:
    """The host's proper suffixes of at most `most` labels, and the empty one, which all hosts have."""
    parts = F.split(host, r"\.")
    starts = F.sequence(F.greatest(F.lit(2), F.size(parts) - (most - 1)), F.size(parts) + 1)
    return F.array_distinct(F.transform(starts, lambda k: F.array_join(F.slice(parts, k, F.size(parts)), ".")))


def templates(urls: DataFrame, config: TreeConfig = TreeConfig()) -> DataFrame:
    """The tree of urls (host, path, label), label 1 blocked, 0 allowed, null unknown; any other columns are ignored.

    Returns one row per host and distinct generalised path: host, raw (its segments), template (its final segments),
    basis, level, n, blocked, purity, rejected. basis tells whose labels decide: own (the template's), host (an
    ancestor's in the host's tree), suffix (of hosts under a suffix of the host), hosts (of all hosts), or none; level is
    the number of the template's first segments that share them. n and blocked count these labelled urls and the blocked
    ones among them. Equal urls count as often as they occur. Urls collapse to distinct generalised paths before
    anything else, with partial sums, so a host with most of all urls costs no more than its distinct paths. Rows with a
    null host or path are left out.
    """
    label = F.col("label")
    known = urls.where("host is not null and path is not null")
    counts = known.select("host", _segments(F.col("path")).alias("raw"), label).groupBy("host", "raw")
    counts = cut(counts.agg(F.count("label").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("b")))
    suffix = F.explode(_suffixes(F.col("host"), config.suffix)).alias("suffix")
    labelled = F.when(F.col("n") > 0, F.col("host"))
    shared = counts.select(suffix, "raw", "n", "b", labelled.alias("labelled")).groupBy("suffix", "raw")
    shared = shared.agg(F.sum("n").alias("n"), F.sum("b").alias("b"), F.min("labelled").alias("x"), F.max("labelled").alias("y"))
    # one pass for the trees of hosts and of suffixes: an h or an s before their names tells them apart
    own_tree = counts.select(F.concat(F.lit("h"), "host").alias("host"), "raw", "n", "b", labelled.alias("x"), labelled.alias("y"))
    trees = _generalised(own_tree.unionByName(shared.select(F.concat(F.lit("s"), "suffix").alias("host"), "raw", "n", "b", "x", "y")), config)
    named = trees.withColumn("host", F.substring("host", F.lit(2), F.length("host")))
    tree, every = named.where(F.startswith(trees["host"], F.lit("h"))), named.where(F.startswith(trees["host"], F.lit("s")))
    totals = cut(tree.groupBy("host", "template").agg(F.sum("n").alias("t_n"), F.sum("b").alias("t_b")))
    n, b = totals.agg(F.sum("t_n"), F.sum("t_b")).first()
    prior = b / n if n else 0.0
    found = tree.select("host", "raw", "template").join(totals, ["host", "template"])
    found = found.join(_of_host(tree, totals, config), ["host", "template"], "left")
    found = found.join(_of_related(counts.select("host", "raw"), every, config), ["host", "raw"], "left")
    own, near = F.col("t_n") > 0, F.coalesce("of_host", F.col("of_related").dropFields("suffix"))
    related = F.when(F.col("of_related.suffix") == "", "hosts").when(F.col("of_related").isNotNull(), "suffix").otherwise("none")
    basis = F.when(own, "own").when(F.col("of_host").isNotNull(), "host").otherwise(related)
    level = F.when(own, F.size("template")).otherwise(near["level"])
    n = F.when(own, F.col("t_n")).otherwise(F.coalesce(near["n"], F.lit(0)))
    b = F.when(own, F.col("t_b")).otherwise(F.coalesce(near["b"], F.lit(0)))
    found = found.select("host", "raw", "template", basis.alias("basis"), level.alias("level"), n.alias("n"), b.alias("blocked"))
    purity = (F.col("blocked") + config.prior_weight * prior) / (F.col("n") + config.prior_weight)
    rejected = (F.col("purity") >= config.purity) & (F.col("n") >= config.least_labelled)
    return found.withColumn("purity", purity).withColumn("rejected", rejected)


def _generalised(tree: DataFrame, config: TreeConfig) -> DataFrame:
    """tree (host, raw, n, b and others) with template: its segments after widening and merging. Each level is written to
    a table; of these only the last stays."""
    tree, path = stored(tree.withColumn("template", F.col("raw")))
    deepest = min(config.depth, _deepest(tree))
    # generalise from the top: a wildcard above lets more branches below come together; then merge from the leaves up
    for level in (*range(deepest), *reversed(range(-deepest, 0))):
        changed = _widen(tree, level, config.most_children) if level >= 0 else _merge(tree, level + deepest, config.chi_square)
        before = path
        tree, path = stored(changed)
        discard(tree.sparkSession, before)
    return tree


def _deepest(tree: DataFrame) -> int:
    """Levels at which two paths of one host can meet: the largest second depth of any host."""
    depths = tree.groupBy("host", F.size("raw").alias("depth")).agg(F.count("*").alias("n"))
    so_far = F.sum("n").over(Window.partitionBy("host").orderBy(F.desc("depth")))
    return depths.withColumn("so_far", so_far).where("so_far > 1").agg(F.max("depth")).first()[0] or 0


def _prefixes(rows: DataFrame, most: int) -> DataFrame:
    """rows once for each prefix of their templates of up to `most` segments, with level and prefix."""
    rows = rows.withColumn("level", F.explode(F.sequence(F.lit(0), F.least(F.size("template"), F.lit(most)))))
    return rows.withColumn("prefix", F.slice("template", F.lit(1), F.col("level")))


def _of_host(tree: DataFrame, totals: DataFrame, config: TreeConfig) -> DataFrame:
    """(host, template, of_host: level, n, b of the nearest ancestor with two labelled branches) of unlabelled templates."""
    branch = F.coalesce(F.get("raw", F.col("level")), F.lit(""))
    ancestors = _prefixes(tree.where("n > 0"), config.depth).withColumn("branch", branch).groupBy("host", "prefix")
    ancestors = ancestors.agg(F.sum("n").alias("n"), F.sum("b").alias("b"), F.min("branch").alias("x"), F.max("branch").alias("y"))
    ancestors = ancestors.where("x <> y").select("host", "prefix", "n", "b")
    found = _prefixes(totals.where("t_n = 0"), config.depth).join(ancestors, ["host", "prefix"])
    return found.groupBy("host", "template").agg(F.max(F.struct("level", "n", "b")).alias("of_host"))


def _of_related(paths: DataFrame, every: DataFrame, config: TreeConfig) -> DataFrame:
    """(host, raw, of_related: labels, suffix, level, n, b of the nearest ancestor, itself included, in the tree of the
    longest suffix where it has labels of two hosts). A tree's root needs two labelled branches besides; that of all
    hosts counts as none."""
    branch = F.coalesce(F.get("raw", F.col("level")), F.lit(""))
    ancestors = _prefixes(every.where("n > 0"), config.depth).where("level > 0 or host <> ''").withColumn("branch", branch).groupBy("host", "prefix")
    ancestors = ancestors.agg(
        F.sum("n").alias("n"), F.sum("b").alias("b"), F.min("x").alias("x"), F.max("y").alias("y"), F.min("branch").alias("u"), F.max("branch").alias("v")
    )
    ancestors = cut(ancestors.where("x <> y and (u <> v or size(prefix) > 0)").select("host", "prefix", "n", "b"))
    found = _prefixes(every.select("host", "raw", "template"), config.depth).join(small(ancestors), ["host", "prefix"])
    found = found.groupBy(F.col("host").alias("suffix"), "raw").agg(F.max(F.struct("level", "n", "b")).alias("near"))
    asked = paths.select("host", "raw", F.explode(_suffixes(F.col("host"), config.suffix)).alias("suffix"))
    met = asked.join(found, ["suffix", "raw"])
    labels = F.when(F.col("suffix") == "", 0).otherwise(F.size(F.split("suffix", r"\.")))
    one = F.struct(labels.alias("labels"), "suffix", "near.level", "near.n", "near.b")
    return met.groupBy("host", "raw").agg(F.max(one).alias("of_related")).withColumn("of_related", F.col("of_related").dropFields("labels"))


def _at(level: int) -> Column:
    return F.get("template", F.lit(level))


def _starred(level: int) -> Column:
    return F.transform("template", lambda s, k: F.when(k == level, F.lit("*")).otherwise(s))


def _widen(tree: DataFrame, level: int, most: int) -> DataFrame:
    """A parent with more than `most` distinct literal children at a level gets a single wildcard child."""
    parent = F.slice("template", 1, level).alias("parent")
    here = tree.where((F.size("template") > level) & ~(_at(level) == "*"))
    children = here.select("host", parent, _at(level).alias("child")).distinct().groupBy("host", "parent").count()
    wide = children.where(F.col("count") > most).select(F.col("host").alias("h"), F.col("parent").alias("p"))
    same = (F.col("host") == F.col("h")) & (F.slice("template", 1, level) == F.col("p"))
    change = F.col("h").isNotNull() & (F.size("template") > level) & ~(_at(level) == "*")
    return tree.join(wide, same, "left").withColumn("template", F.when(change, _starred(level)).otherwise(F.col("template"))).drop("h", "p")


def _merge(tree: DataFrame, level: int, limit: float) -> DataFrame:
    """Siblings at a level (equal templates but for it) merge if chi-square tests find their shares alike.

    Labelled siblings, of which there are few after _widen, are taken in the order of their shares; each is tested
    against the group before it and joins it or starts a new one. A group of several becomes a wildcard: "*", or "*"
    and its first member if there are several groups. Siblings without labels join a wildcard if it is the only group.
    """
    here = tree.where(F.size("template") > level)
    branch = here.groupBy("host", "template").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).where("n > 0")
    one = F.struct((F.col("b") / F.col("n")).alias("share"), _at(level).alias("child"), "n", "b")
    siblings = branch.groupBy("host", _starred(level).alias("s")).agg(F.sort_array(F.collect_list(one)).alias("all")).where("size(all) > 1")

    def alike(g: Column, x: Column) -> Column:
        n, b = g["n"] + x["n"], g["b"] + x["b"]
        off = (g["b"] * x["n"] - x["b"] * g["n"]).cast("double")
        return (b == 0) | (b == n) | (off * off * n <= limit * g["n"] * x["n"] * b * (n - b))

    def step(groups: Column, x: Column) -> Column:
        last = F.element_at(groups, -1)
        grown = F.struct((last["n"] + x["n"]).alias("n"), (last["b"] + x["b"]).alias("b"), F.array_append(last["members"], x["child"]).alias("members"))
        new = F.struct(x["n"].alias("n"), x["b"].alias("b"), F.array(x["child"]).alias("members"))
        head = F.slice(groups, F.lit(1), F.size(groups) - 1)
        return F.when(alike(last, x), F.array_append(head, grown)).otherwise(F.array_append(groups, new))

    first = F.col("all")[0]
    start = F.array(F.struct(first["n"].alias("n"), first["b"].alias("b"), F.array(first["child"]).alias("members")))
    groups = siblings.select("host", "s", F.aggregate(F.slice("all", F.lit(2), F.size("all")), start, step).alias("groups"))
    groups = groups.withColumn("only", F.size("groups") == 1).select("host", "s", "only", F.explode("groups.members").alias("members"))
    groups = groups.where("size(members) > 1")
    star = F.when(F.col("only") | F.array_contains("members", "*"), F.lit("*")).otherwise(F.concat(F.lit("*"), F.col("members")[0]))
    named = groups.select(F.col("host").alias("h"), F.col("s").alias("s"), F.explode("members").alias("member"), star.alias("star"))
    whole = groups.where("only").select(F.col("host").alias("wh"), F.col("s").alias("ws"))
    deep = F.size("template") > level
    joined = tree.join(named, deep & (F.col("host") == F.col("h")) & (_starred(level) == F.col("s")) & (_at(level) == F.col("member")), "left")
    joined = joined.join(whole, deep & (F.col("host") == F.col("wh")) & (_starred(level) == F.col("ws")), "left")
    to = F.coalesce("star", F.when(F.col("wh").isNotNull(), F.lit("*")))
    changed = F.transform("template", lambda x, k: F.when(k == level, to).otherwise(x))
    return joined.withColumn("template", F.when(to.isNotNull(), changed).otherwise(F.col("template"))).select(*tree.columns)


def judge(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules=RULES,
    labels: DataFrame | None = None,
    config: TreeConfig = TreeConfig(),
) -> DataFrame:
    """page id, host, path, rule (its text, else null), verdict, basis: the longest rule's, else the template tree's.

    Urls that a rule fits serve as labelled ones, as do labels (url, label) if given. A url of a rejected template is
    blocked, any other allowed; so is a null url or one without "://" (its host and path are empty). basis is "rule",
    or as in templates(). One row per row of pages; repeated rows stay; an empty table gives no rows.
    """
    url = F.col(f"`{url_col}`")
    split = pages.select(F.col(f"`{id_col}`").alias("__id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    ruled = split.withColumns({"rule": rule, "ruling": verdict})
    known = ruled.select("host", "path", F.when(F.col("ruling") == "block", 1).when(F.col("ruling") == "allow", 0).alias("label"))
    if labels is not None:
        more = labels.where("label in (0, 1)")
        known = known.unionByName(more.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "label"))
    tree = templates(known, config).where("basis <> 'none'").select(F.col("host").alias("h"), F.col("raw").alias("r"), "rejected", F.col("basis").alias("by"))
    tree = cut(tree)
    same = F.col("ruling").isNull() & (F.col("host") == F.col("h")) & (_segments(F.col("path")) == F.col("r"))
    verdict = F.coalesce("ruling", F.when(F.col("rejected"), "block").otherwise("allow"))
    basis = F.when(F.col("ruling").isNotNull(), "rule").otherwise(F.coalesce("by", F.lit("none")))
    joined = ruled.join(small(tree), same, "left")
    return joined.select(F.col("__id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), basis.alias("basis"))


def agreement(urls: DataFrame, config: TreeConfig = TreeConfig(), modulus: int = 5, whole_hosts: bool = True) -> DataFrame:
    """(basis, n, agreeing): how often the tree agrees with labels that are hidden from it, by whose labels decide.

    urls: host, path, label as for templates(). Hidden are the labels of all urls of the hosts (or of the urls, if not
    whole_hosts) whose crc32 is divisible by modulus. Basis none says allow, as judge() does.
    """
    name = F.col("host") if whole_hosts else F.concat("host", "path")
    rows = cut(urls.where("host is not null and path is not null").select("host", "path", "label", (F.crc32(name.cast("binary")) % modulus == 0).alias("hidden")))
    tree = templates(rows.withColumn("label", F.when(~F.col("hidden"), F.col("label"))), config).select("host", "raw", "basis", "rejected")
    asked = rows.where("hidden and label is not null").select("host", _segments(F.col("path")).alias("raw"), "label")
    said = (F.col("rejected") & (F.col("basis") != "none")).cast("int")
    return asked.join(tree, ["host", "raw"]).groupBy("basis").agg(F.count("*").alias("n"), F.sum((said == F.col("label")).cast("bigint")).alias("agreeing"))
