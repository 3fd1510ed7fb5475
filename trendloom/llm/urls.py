"""URL filter: given rules first, then a tree of path templates per host.

The tree grows level by level. Segments with numbers and unlabelled ones are variable and become the
wildcard branch of their node. The others stand in the order of their rate of bad labels; a branch
joins the group before it unless its rate differs from that of the whole group. Below the first levels the tree goes on where labels are of both kinds
and shapes differ, however deep. The labels of a finished template, smoothed towards the overall
rate, decide on all its urls.

Work goes on over distinct (host, shape) rows, which are counted in each task before they meet, so
a host with a third of all urls is a few dozen rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.llm.licenses import LOWER, UPPER
from trendloom.llm.shared import stored

#: (verdict, host suffix and path prefix).
RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Levels that every tree has; what goes on below them is one open end unless its labels differ.
DEPTH = 3
#: Characters with a meaning in templates, and how they are written there as part of a segment.
MARKS = {"*": "%2A", "{": "%7B", "|": "%7C", "}": "%7D"}
#: Names that a merged branch shows; of more it shows the first and the last, and how many they are.
SHOWN = 100
#: Squared difference of two rates, in variances, from which they differ.
DIFFER = 3.84
#: Labels that the overall rate counts as, and the smoothed purity below which a template is blocked.
WEIGHT, PURITY = 20, 0.8


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    return F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    return F.regexp_extract(F.coalesce(rest, F.lit("")), "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits: the host or a subdomain of it, and a path that starts alike."""
    out = None
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        domain, slash, start = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit(f".{domain}"))) & F.startswith(path, F.lit(slash + start))
        out = F.when(fits, rule) if out is None else out.when(fits, rule)
    return F.lit(None).cast("string") if out is None else out


def _shape() -> Column:
    """The path's segments with numbers as ``#``, joined."""
    return F.array_join(F.filter(F.split(F.regexp_replace("path", "[0-9]+", "#"), "/"), lambda s: s != ""), "/")


def _cuts(rates: Column) -> Column:
    """Rates at which a new group begins, of a node's distinct rates in order, with their labels.

    Each rate is compared with the pooled rate of the group built so far, so a chain of small steps
    does not join what is far apart.
    """
    start = F.struct(F.array().cast("array<double>").alias("cuts"), F.lit(0.0).alias("labelled"), F.lit(0.0).alias("bad"))

    def step(group: Column, x: Column) -> Column:
        both = (x["bad"] + group["bad"]) / (x["labelled"] + group["labelled"])
        gap = x["rate"] - F.try_divide(group["bad"], group["labelled"])
        weight = 1 / x["labelled"] + F.try_divide(F.lit(1.0), group["labelled"])
        apart = (group["labelled"] > 0) & (gap > 0) & (gap * gap >= F.lit(DIFFER) * both * (1 - both) * weight)
        return F.when(apart, F.struct(F.concat(group["cuts"], F.array(x["rate"])).alias("cuts"), x["labelled"].alias("labelled"), x["bad"].alias("bad"))).otherwise(
            F.struct(group["cuts"].alias("cuts"), (group["labelled"] + x["labelled"]).alias("labelled"), (group["bad"] + x["bad"]).alias("bad")))

    return F.aggregate(rates, start, step, lambda group: group["cuts"])


def escaped(step: Column) -> Column:
    """A segment as it stands in a template; characters that templates use themselves are percent-encoded."""
    for mark, code in MARKS.items():
        step = F.replace(step, F.lit(mark), F.lit(code))
    return step


def _branches(tree: DataFrame, step: str) -> DataFrame:
    """``host, template, step, branch`` of the labelled branches, merged where their rates do not differ.

    Branches of one rate are one entry with a count before a node's rates meet, and of a large group
    only the number of names and the first and last of them travel.
    """
    node = ["host", "template"]
    branches = tree.groupBy(*node, step).agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    named = branches.filter((F.col(step) != "") & ~F.contains(F.col(step), F.lit("#")) & (F.col("labelled") > 0)).withColumn(
        "rate", F.col("bad") / F.col("labelled")
    )
    of_rate = named.groupBy(*node, "rate").agg(F.sum("labelled").cast("double").alias("labelled"), F.sum("bad").cast("double").alias("bad"))
    rates = F.array_sort(F.collect_list(F.struct("rate", "labelled", "bad")))
    cuts = of_rate.groupBy(*node).agg(_cuts(rates).alias("cuts"))
    groups = named.join(cuts, node).select(
        *node, step, escaped(F.col(step)).alias("name"), F.size(F.filter("cuts", lambda c: c <= F.col("rate"))).alias("alike")
    )
    key = [*node, "alike"]
    counted = groups.groupBy(*key).agg(F.count(F.lit(1)).alias("names"), F.min("name").alias("least"), F.max("name").alias("most"))
    some = groups.join(counted.filter(F.col("names").between(2, SHOWN)).select(*key), key).groupBy(*key).agg(
        F.array_join(F.array_sort(F.collect_list("name")), "|").alias("shown")
    )
    many = F.concat("least", F.lit("|"), F.col("names").cast("string"), F.lit(" names|"), "most")
    label = F.when(F.col("names") == 1, F.concat(F.lit("/"), "least")).otherwise(
        F.concat(F.lit("/{"), F.coalesce("shown", many), F.lit("}"))
    )
    labels = counted.join(some, key, "left").select(*key, label.alias("branch"))
    return groups.join(labels, key).select(*node, step, "branch")


def grow(shapes: DataFrame, depth: int) -> DataFrame:
    """``shapes`` with the ``template`` of each (host, shape); counts ``n, labelled, bad`` decide."""
    parts = F.split("shape", "/")
    step = lambda k: F.coalesce(F.try_element_at(parts, F.lit(k)), F.lit(""))
    extend = lambda tree: tree.join(_branches(tree, "step"), ["host", "template", "step"], "left").withColumn(
        "template", F.concat("template", F.coalesce("branch", F.when(F.col("step") == "", "").otherwise("/*")))).drop("branch", "step")
    tree = shapes.withColumn("template", F.lit(""))
    for k in range(1, depth + 1):
        tree = stored(extend(tree.withColumn("step", step(k))))
    done, level = [tree.filter(F.size(parts) <= depth)], depth
    left = tree.filter(F.size(parts) > depth)
    while True:
        # Labels of both kinds on different shapes may yet be told apart; all else is an open end.
        told = F.col("labelled") > 0
        nodes = left.groupBy("host", "template").agg(
            F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad"),
            F.min(F.when(told, F.col("shape"))).alias("least"), F.max(F.when(told, F.col("shape"))).alias("most"),
        ).filter("all_bad > 0 and all_bad < all_labelled and least < most").select("host", "template")
        mixed = stored(left.join(nodes, ["host", "template"], "left_semi"))
        done.append(left.join(nodes, ["host", "template"], "left_anti").withColumn("template", F.concat("template", F.lit("/**"))))
        if mixed.isEmpty():
            break
        level += 1
        tree = stored(extend(mixed.withColumn("step", step(level))))
        done.append(tree.filter(F.size(parts) <= level))
        left = tree.filter(F.size(parts) > level)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return stored(out)


def filter_urls(
    pages: DataFrame, labels: DataFrame, *, id_col: str = "page_id", url_col: str = "url", label_id_col: str = "doc_id",
    good_col: str = "quality", rules=RULES, depth: int = DEPTH, weight: int = WEIGHT, purity: float = PURITY,
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, template, labelled, purity.

    Labels (1 good, 0 bad) meet pages by id; of several labels the worst counts, null labels do not.
    A null url, or one without ``://``, has an empty host and path and belongs to the empty
    template. Without any label every template has purity 1 and is allowed. Repeated rows are
    judged alike. Column names of ``pages`` never clash, since only id and url are read.
    """
    url = F.col(url_col)
    told = labels.filter(F.col(good_col).isNotNull() & F.col(label_id_col).isNotNull()).groupBy(
        F.col(label_id_col).alias("label_id")
    ).agg(F.min(good_col).alias("good"))
    split = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    split = split.withColumn("shape", _shape())
    key = ["host", "shape"]
    shapes = stored(split.join(told, F.col("id") == F.col("label_id"), "left").groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), F.count("good").alias("labelled"),
        F.coalesce(F.sum(F.when(F.col("good") == 0, 1).otherwise(0)), F.lit(0)).alias("bad"),
    ))
    tree = grow(shapes, depth)
    total = shapes.agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")).first()
    overall = (total.labelled - total.bad) / total.labelled if total.labelled else 1.0
    smoothed = (F.col("all_labelled") - F.col("all_bad") + F.lit(weight * overall)) / (F.col("all_labelled") + F.lit(weight))
    judged = tree.groupBy("host", "template").agg(
        F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad")
    ).select("host", "template", "all_labelled", smoothed.alias("purity"))
    decided = tree.join(judged, ["host", "template"]).select(*key, "template", "all_labelled", "purity")
    rule = rule_of(F.col("host"), F.col("path"), rules)
    given = {text: verdict for verdict, text in rules}
    by_rule = F.coalesce(*[F.when(F.col("rule") == text, verdict) for text, verdict in given.items()], F.lit(None))
    own = F.when(F.col("purity") < purity, "block").otherwise("allow")
    return split.join(decided, key).withColumn("rule", rule).select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce(by_rule, own).alias("verdict"), "template",
        F.col("all_labelled").alias("labelled"), F.round("purity", 6).alias("purity"),
    )
