"""URL filter (operator 6): a path-template tree per host.

Rules fix the verdict of the urls they fit; those urls are the labelled ones.
All urls then run down a tree of path segments, one per host and one over all
hosts together. Digits and hex runs become ``{n}`` and ``{x}``; at each level,
children of a node with many children and little support become the wildcard
``*``, and labelled children whose share of blocked urls does not differ
significantly (two-proportion z test between neighbours by share) are merged
into one branch ``~k``. A template is rejected when its smoothed share of
blocked urls (host template, backed off to the template over all hosts, backed
off to the overall share) reaches ``purity``.

Scale: work is done on distinct (host, generalised path) counts, built with
map-side combining; node totals are aggregates joined back, and windows only
see the at most ``1 / share`` branches of a node that stay literal. Only
built-in functions; urls are joined once at the end.

Defined cases: a null url, or one without ``://``, has empty host and path; a
path deeper than ``max_depth`` shares the branch ``**`` from the level on below
which its branch holds labels of one kind only; with
no labelled url every verdict of the method is allow. Repeated rows are
judged alike; extra columns pass through, same-named ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Production rules.
RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def split_url(url: str) -> tuple[str, str]:
    """SQL for host and path of a url column."""
    u = f"coalesce({url}, '')"
    return (f"translate(regexp_extract({u}, '{_PARTS}', 1), '{_UPPER}', '{_LOWER}')",
            f"regexp_extract({u}, '{_PARTS}', 2)")


def rule_sql(rules, host: str = "host", path: str = "path") -> str:
    """SQL for the position of the longest rule that fits, else null."""
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i].name), i))
    fits = [f"WHEN ({host} = {_text(rules[i].host)} OR endswith({host}, {_text('.' + rules[i].host)})) "
            f"AND startswith({path}, {_text(rules[i].path)}) THEN {i}" for i in order]
    return "CASE " + " ".join(fits) + " END" if fits else "CAST(NULL AS INT)"


def generalised(path: str) -> str:
    """SQL for the path with uuids and long hex runs as {x}, digits as {n}."""
    hexed = (f"regexp_replace({path}, '(?i)[0-9a-f]{{8}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{12}}"
             "|(?<![0-9a-z])(?=[a-f]*[0-9])[0-9a-f]{16,}(?![0-9a-z])', '{x}')")
    return f"regexp_replace({hexed}, '[0-9]+', '{{n}}')"


def template_tree(urls: DataFrame, max_depth: int = 8, max_children: int = 50, share: float = 0.02,
                  min_labels: int = 5, z_limit: float = 1.96) -> DataFrame:
    """``urls`` (tree, form, n, labelled, blocked; one row per tree and form)
    with the column ``template``. Below ``max_depth`` a branch is walked on as
    long as it holds both blocked and allowed labels; a branch of one kind stops
    there, as no template below could judge it differently."""
    rows, settled = urls.withColumn("segs", F.split("form", "/")).withColumn("template", F.lit("")), None
    deepest = rows.agg(F.max(F.size("segs"))).first()[0] or 0
    node = ["tree", "template"]
    for d in range(deepest):
        if d >= max_depth:
            mixed = rows.groupBy(*node).agg(F.sum("labelled").alias("lab"), F.sum("blocked").alias("blk"), F.max(F.size("segs")).alias("deep"))
            mixed = stored(mixed.filter(f"blk > 0 AND blk < lab AND deep > {d}").select(*node), f"mixed{d}")
            still = rows.join(mixed, node, "left_anti")
            still = still.withColumn("template", F.expr(f"IF(size(segs) > {d}, concat(template, '/**'), template)"))
            settled = still if settled is None else settled.union(still)
            rows = rows.join(mixed, node, "left_semi")
            if not mixed.limit(1).count():
                break
        here = rows.withColumn("seg", F.expr(f"IF(size(segs) > {d}, segs[{d}], NULL)"))
        kids = here.filter("seg IS NOT NULL").groupBy(*node, "seg").agg(
            F.sum("n").alias("n"), F.sum("labelled").alias("lab"), F.sum("blocked").alias("blk"))
        totals = kids.groupBy(*node).agg(F.count("*").alias("kids"), F.sum("n").alias("total"))
        kids = kids.join(totals, node).withColumn("rare", F.expr(f"kids > {max_children} AND n < {share} * total"))
        by_share = Window.partitionBy(*node).orderBy(F.expr("blk / lab"), "seg")
        gap = ("abs(p - q) / sqrt(((blk + pb + 1D) / (lab + pl + 2D)) * (1D - (blk + pb + 1D) / (lab + pl + 2D)) "
               "* (1D / lab + 1D / pl))")
        alike = (kids.filter(f"NOT rare AND lab >= {min_labels}")
                 .withColumn("pb", F.lag("blk").over(by_share)).withColumn("pl", F.lag("lab").over(by_share))
                 .withColumn("p", F.expr("blk / lab")).withColumn("q", F.expr("pb / pl"))
                 .withColumn("new", F.expr(f"CASE WHEN pl IS NULL OR {gap} >= {z_limit} THEN 1 ELSE 0 END"))
                 .withColumn("branch", F.sum("new").over(by_share)))
        alike = alike.withColumn("size", F.count("*").over(Window.partitionBy(*node, "branch")))
        names = (kids.select(*node, "seg", "rare")
                 .join(alike.select(*node, "seg", "branch", "size"), [*node, "seg"], "left")
                 .withColumn("name", F.expr("CASE WHEN rare THEN '*' WHEN size > 1 THEN concat('~', branch) ELSE seg END"))
                 .select(*node, "seg", "name"))
        rows = (here.join(names, [*node, "seg"], "left")
                .withColumn("template", F.expr("CASE WHEN seg IS NULL THEN template ELSE "
                                               + ("name" if d == 0 else "concat(template, '/', name)") + " END"))
                .drop("seg", "name"))
        rows = stored(rows, f"level{d}")
    return (rows if settled is None else rows.select(*settled.columns).union(settled)).drop("segs")


def filter_urls(pages: DataFrame, rules=RULES, url_col: str = "url", purity: float = 0.8, weight: float = 5.0,
                **tree) -> DataFrame:
    """``pages`` with host, path, rule, template, purity (smoothed share of
    blocked urls) and verdict."""
    host, path = split_url(f"`{url_col}`")
    outputs = ["host", "path", "rule", "template", "purity", "verdict"]
    seen = pages.drop(*[c for c in outputs if c != url_col]).withColumns({"host": F.expr(host), "path": F.expr(path)})
    seen = seen.withColumn("__rule", F.expr(rule_sql(rules))).withColumn("__form", F.expr(generalised("path")))
    names = "array(" + ", ".join(_text(r.name) for r in rules) + ")" if rules else "array(CAST(NULL AS STRING))"
    verdicts = "array(" + ", ".join(_text(r.verdict) for r in rules) + ")" if rules else "array(CAST(NULL AS STRING))"
    seen = seen.withColumns({"rule": F.expr(f"IF(__rule IS NULL, NULL, {names}[__rule])"),
                             "__fixed": F.expr(f"IF(__rule IS NULL, NULL, {verdicts}[__rule])")})

    counts = [F.count("*").alias("n"), F.expr("count(__fixed)").alias("labelled"),
              F.expr("count_if(__fixed = 'block')").alias("blocked")]
    forms = stored(seen.groupBy("host", F.col("__form").alias("form")).agg(*counts), "forms")
    pooled = forms.groupBy("form").agg(*(F.sum(c).alias(c) for c in ("n", "labelled", "blocked")))
    # host trees get the prefix h, the tree of all hosts the name *
    both = forms.select(F.concat(F.lit("h"), "host").alias("tree"), "form", "n", "labelled", "blocked").unionByName(
        pooled.select(F.lit("*").alias("tree"), "form", "n", "labelled", "blocked"))
    placed = template_tree(stored(both, "tree"), **tree)
    by_template = placed.groupBy("tree", "template").agg(F.sum("labelled").alias("lab"), F.sum("blocked").alias("blk"))
    overall = forms.agg(F.sum("labelled"), F.sum("blocked")).first()
    prior = float(overall[1] / overall[0]) if overall[0] else 0.0
    placed = placed.join(by_template, ["tree", "template"])
    shared = placed.filter("tree = '*'").select(
        "form", F.expr(f"(blk + {weight}D * {prior!r}D) / (lab + {weight}D)").alias("back"))
    judged = (placed.filter("tree <> '*'").join(shared, "form")
              .select(F.expr("substr(tree, 2)").alias("host"), F.col("form").alias("__form"), "template",
                      F.expr(f"(blk + {weight}D * back) / (lab + {weight}D)").alias("purity")))
    out = seen.join(judged, ["host", "__form"], "left")
    verdict = F.expr(f"coalesce(__fixed, IF(purity >= {float(purity)}D, 'block', 'allow'))")
    keep = [c for c in seen.columns if not c.startswith("__") and c not in outputs]
    return out.withColumn("verdict", verdict).select(*keep, *[c for c in outputs if c not in keep])
