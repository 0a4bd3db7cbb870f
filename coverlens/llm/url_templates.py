"""URL filter: rules first, then the labelled purity of path templates, in DataFrame functions only.

A path is cut into its non-empty segments (those from the ``DEPTH``-th on count as one, ``**``).  Segments that are ids by their shape become marks: runs of
digits ``{n}``, hexadecimal ids ``{hex}``, slugs of four words ``{slug}``, long mixed ids ``{id}``.  Equal shapes of a host are added
up, with the number of labelled and of bad pages.  Then the tree of each host is built level by level.  Below a node, a segment is
a branch if it is frequent (``LEAST`` pages and one in ``SHARE`` of the node's); the others are one branch together.  In the order of their
rates of bad pages, branches that differ from the group before them by no more than ``Z`` standard errors are merged with it.  A group is named by its
segments, ``(a|b)``, but ``*`` if it holds the infrequent ones.

A template's purity is one less its rate of bad labels, drawn towards its host's rate as if by ``PRIOR`` pages of it, and the host's
towards that of all labels likewise.  Templates of a purity below ``PURE`` are rejected.

Null urls and urls without ``://`` have an empty host and path and are judged like any others.  A null ``bad`` is no label.  Repeated rows
count and are returned one by one; other columns are ignored; an empty table gives no rows.  Without labels everything that no rule blocks is allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlens.llm.lookup import lookup
from coverlens.session import materialise

DEPTH = 8
LEAST, SHARE, Z = 8, 20, 2.0
PRIOR, PURE = 4.0, 0.5
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SUMS = ("n", "labelled", "bad")


def host_of(url: Column | str) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", 1), CAPITALS, SMALL), F.lit(""))


def path_of(url: Column | str) -> Column:
    return F.coalesce(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", 2), F.lit(""))


def ruling(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest of the (verdict, host, path) rules that fit, as (size, host_size, verdict, rule); null if none does.

    Of rules of one length the one of the longer host wins, then "block".
    """
    fitting = [
        F.when(
            ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path),
            F.struct(
                F.lit(len(rule_host + rule_path)).alias("size"),
                F.lit(len(rule_host)).alias("host_size"),
                F.lit(verdict).alias("verdict"),
                F.lit(rule_host + rule_path).alias("rule"),
            ),
        )
        for verdict, rule_host, rule_path in rules
    ]
    return F.array_max(F.array(*fitting)) if fitting else F.lit(None).cast("struct<size int, host_size int, verdict string, rule string>")


def shaped(segment: Column) -> Column:
    """A segment with its ids replaced by marks."""
    return (
        F.when(segment.rlike(r"^[0-9a-fA-F-]{8,}\z") & segment.rlike("[0-9]") & segment.rlike("[a-fA-F]"), "{hex}")
        .when(segment.rlike(r"^[^-_]+([-_][^-_]+){3,}\z"), "{slug}")
        .when((F.length(segment) >= 24) & segment.rlike("[0-9]"), "{id}")
        .otherwise(F.regexp_replace(segment, "[0-9]+", "{n}"))
    )


def segments_of(path: Column) -> Column:
    kept = F.filter(F.split(path, "/"), lambda s: s != "")
    head = F.transform(F.slice(kept, 1, DEPTH - 1), shaped)
    tail = F.when(F.size(kept) == DEPTH, F.transform(F.slice(kept, DEPTH, 1), shaped)).when(F.size(kept) > DEPTH, F.array(F.lit("**")))
    return F.concat(head, F.coalesce(tail, F.array().cast("array<string>")))


def _rate(labelled: Column, bad: Column) -> Column:
    return (bad + 0.5) / (labelled + 1.0)


def _alike(one: Column, other: Column) -> Column:
    """Whether two branches (labelled, bad) differ in their rate of bad pages by no more than chance."""
    a, b = _rate(one.labelled, one.bad), _rate(other.labelled, other.bad)
    return F.abs(a - b) <= Z * F.sqrt(a * (1.0 - a) / (one.labelled + 1.0) + b * (1.0 - b) / (other.labelled + 1.0))


def _merged(branches: Column) -> Column:
    """Groups (labelled, bad, segments) of alike branches (rate, segment, labelled, bad), met in the order of their rates."""
    kind = "array<struct<labelled: bigint, bad: bigint, segments: array<string>>>"

    def step(groups: Column, branch: Column) -> Column:
        last = F.element_at(groups, -1)
        fresh = F.struct(branch.labelled.alias("labelled"), branch.bad.alias("bad"), F.array(branch.segment).alias("segments"))
        grown = F.struct(
            (last.labelled + branch.labelled).alias("labelled"),
            (last.bad + branch.bad).alias("bad"),
            F.concat(last.segments, F.array(branch.segment)).alias("segments"),
        )
        joined = (F.size(groups) > 0) & _alike(last, branch)
        return F.when(joined, F.concat(F.slice(groups, 1, F.size(groups) - 1), F.array(grown))).otherwise(F.concat(groups, F.array(fresh))).cast(kind)

    return F.aggregate(F.array_sort(branches), F.array().cast(kind), step)


def _named(branches: DataFrame) -> DataFrame:
    """(host, template, segment, name, shapes) of the segments that do not go into the wildcard of their node; written.

    At most ``SHARE`` segments of a node are frequent, so their list is short; what is left of the node is one more, without a name.
    """
    node = ("host", "template")
    sums = [F.sum(c).alias(f"node_{c}") for c in SUMS]
    nodes = materialise(branches.groupBy(*node).agg(*sums, F.count("*").alias("branches")), "url-nodes")
    frequent = lookup(branches.where(F.col("n") >= LEAST), nodes, node, "branches", F.col("segment"))
    frequent = materialise(frequent.where(F.col("n") * SHARE >= F.col("node_n")), "url-frequent")
    own = F.struct(_rate(F.col("labelled"), F.col("bad")).alias("rate"), "segment", "labelled", "bad")
    lists = frequent.groupBy(*node, *[f"node_{c}" for c in SUMS]).agg(F.collect_list(own).alias("own"), *[F.sum(c).alias(c) for c in SUMS])
    labelled, bad = F.col("node_labelled") - F.col("labelled"), F.col("node_bad") - F.col("bad")
    rest = F.struct(_rate(labelled, bad).alias("rate"), F.lit(None).cast("string").alias("segment"), labelled.alias("labelled"), bad.alias("bad"))
    every = F.when(F.col("node_n") > F.col("n"), F.concat("own", F.array(rest))).otherwise(F.col("own"))
    groups = lists.select(*node, F.explode(_merged(every)).alias("group")).where(~F.exists("group.segments", F.isnull))
    listed = F.array_join(F.array_sort("group.segments"), "|")
    name = F.when(F.size("group.segments") == 1, listed).otherwise(F.concat(F.lit("("), listed, F.lit(")")))
    names = groups.select(*node, F.explode("group.segments").alias("segment"), name.alias("name"))
    return materialise(names.join(frequent.select(*node, "segment", "shapes"), [*node, "segment"]), "url-names")


def template_tree(shapes: DataFrame) -> DataFrame:
    """``shapes`` (host, shape, segments, n, labelled, bad; one row per host and shape) with the ``template`` of each, written."""
    deepest = shapes.agg(F.max(F.size("segments")).alias("d")).collect()[0]["d"] or 0  # at most DEPTH
    tree = shapes.withColumn("template", F.lit(""))
    for level in range(deepest):
        here = tree.withColumn("segment", F.get("segments", F.lit(level)))
        branches = here.where("segment is not null").groupBy("host", "template", "segment")
        branches = materialise(branches.agg(*[F.sum(c).alias(c) for c in SUMS], F.count("*").alias("shapes")), "url-branches")
        grown = lookup(here, _named(branches), ("host", "template", "segment"), "shapes", F.col("shape"))
        step = F.when(F.col("segment").isNull(), "").otherwise(F.concat(F.lit("/"), F.coalesce("name", F.lit("*"))))
        tree = materialise(grown.withColumn("template", F.concat("template", step)).drop("segment", "name"), "url-tree")
    return tree


def _purity(tree: DataFrame) -> DataFrame:
    """(host, template, purity) of all templates, written."""
    sums = [F.sum(c).alias(c) for c in SUMS]
    templates = materialise(tree.groupBy("host", "template").agg(*sums, F.count("*").alias("shapes")), "url-templates")
    every = templates.agg(*sums).collect()[0]
    general = ((every["bad"] or 0) + 1.0) / ((every["labelled"] or 0) + 2.0)
    rate = (F.sum("bad") + F.lit(PRIOR * general)) / (F.sum("labelled") + PRIOR)
    hosts = materialise(templates.groupBy("host").agg(rate.alias("host_rate"), F.count("*").alias("templates")), "url-hosts")
    found = lookup(templates, hosts, ("host",), "templates", F.col("template"))
    purity = 1.0 - (F.col("bad") + PRIOR * F.col("host_rate")) / (F.col("labelled") + PRIOR)
    return found.select("host", "template", "shapes", purity.alias("purity"))


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, url, bad) of every row of ``pages`` (page_id, url): a page whose path names a document by number has its label.

    ``labels`` (doc_id, quality, toxic): toxic documents and those of quality 0 are bad; of several rows of one id the worst counts.
    """
    number = F.regexp_extract(path_of("url"), "/([0-9]+)", 1).try_cast("long")
    named = materialise(pages.select("page_id", "url", number.alias("number")), "url-numbers")
    bad = (F.coalesce(F.col("toxic") == 1, F.lit(False)) | F.coalesce(F.col("quality") == 0, F.lit(False))).cast("int")
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("number")).agg(F.max(bad).alias("bad"))
    asked = named.where("number is not null").groupBy("number").agg(F.count("*").alias("pages"))
    return lookup(named, materialise(asked.join(known, "number"), "url-labels"), ("number",), "pages", F.col("page_id")).drop("number")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = ()) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every row of ``pages`` (page_id, url, bad).

    ``bad`` is 1, 0 or null (no label).  ``rules`` are (verdict, host, path); they are configuration, each tried on every row.
    """
    parsed = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"), F.col("bad").cast("int").alias("bad"))
    parsed = parsed.withColumn("shape", F.concat_ws("/", segments_of(F.col("path"))))
    parsed = parsed.withColumn("ruling", ruling(F.col("host"), F.col("path"), rules))
    parsed = materialise(parsed, "url-parsed")
    shapes = parsed.groupBy("host", "shape").agg(
        F.count("*").alias("n"),
        F.count("bad").alias("labelled"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"),
    )
    segments = F.when(F.col("shape") == "", F.array().cast("array<string>")).otherwise(F.split("shape", "/"))
    tree = template_tree(materialise(shapes.withColumn("segments", segments), "url-shapes"))
    purity = materialise(_purity(tree), "url-purity")
    named = lookup(tree.select("host", "shape", F.col("n").alias("rows"), "template"), purity, ("host", "template"), "shapes", F.col("shape"))
    found = lookup(parsed, materialise(named, "url-named"), ("host", "shape"), "rows", F.col("page_id"))
    learned = F.when(F.col("purity") < PURE, "block").otherwise("allow")
    return found.select(
        "page_id", "host", "path", F.col("ruling.rule").alias("rule"), F.coalesce("ruling.verdict", learned).alias("verdict"),
        "template", "purity",
    )
