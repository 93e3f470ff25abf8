"""URL filters by a path-template tree per host.

Fixed rules judge first. For all other urls, each host's paths form a tree
that is built level by level: a segment becomes a wildcard if it is a number
or its parent has many, mostly rare children. Sibling branches with enough
labels whose shares of blocked urls do not differ significantly are merged into a
wildcard too. Where a node has one path left, the rest of it ends the template.

A template is judged by its labelled purity, the share of blocked urls smoothed by
its parent's. One with too few labelled urls is judged by the same template on all
hosts, and if that has too few, by its nearest ancestor that has enough; a
template is rejected only on such evidence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdigris.session import materialize

# Fixed values: (rule, host, path, verdict)
RULES = (("org/", "org", "/", "allow"), ("example.org/es/", "example.org", "/es/", "block"),
         ("example.org/en/1", "example.org", "/en/1", "block"), ("com/fr/", "com", "/fr/", "allow"),
         ("com/de/", "com", "/de/", "block"))
WIDE, RARE = 20, 0.2
PRIOR = 10.0
Z = 2.0
EVIDENCE = 5  # labelled urls that a purity, or a comparison of two, needs
SHARE = 1000  # a key with at least 1/SHARE of the rows is hot
NUMBER = r"^[0-9]+(\.[A-Za-z]+)?$"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lower-cased, path); both empty for a null url or one without ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(text, parts, 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), F.regexp_extract(text, parts, 2)


def apply_rules(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null if none does."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(
        F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))
        for rule, h, p, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0]))]
    return F.coalesce(*fits)


def _facts(rows: DataFrame, facts: DataFrame, keys: list[str], least: int) -> DataFrame:
    """``rows`` with the facts of their key; every key has one row of facts, with ``__rows``, how many rows have the key.

    Keys of ``least`` rows or more, at most ``SHARE`` of them, are broadcast; the others are joined by a shuffle.
    """
    hot = F.broadcast(facts.where(F.col("__rows") >= least).drop("__rows"))
    cold = facts.where(F.col("__rows") < least).drop("__rows")
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(cold, keys))


def _generalise(level: DataFrame, least: int) -> DataFrame:
    """(host, prefix, segment, __rows) -> step of the template, from counts of one level of all trees.

    ``level``, a written table, has one row per host, prefix and segment with n, labelled, blocked and __rows.
    """
    node = level.groupBy("host", "prefix").agg(
        F.count(F.lit(1)).alias("__rows"), F.count(F.lit(1)).alias("children"), F.sum("n").alias("total"),
        F.count_if(F.col("n") == 1).alias("single"),
        F.sum("labelled").alias("node_labelled"), F.sum("blocked").alias("node_blocked"))
    rows = _facts(level.withColumnRenamed("__rows", "rows"), node, ["host", "prefix"], least)
    number = F.col("segment").rlike(NUMBER)
    variable = number | ((F.col("children") >= WIDE) & (F.col("n") < RARE * F.col("total"))
                         & (F.col("single") * 2 >= F.col("children")))
    # a named branch like its siblings: its share of blocked urls within Z standard errors of theirs
    rest_n, rest_b = F.col("node_labelled") - F.col("labelled"), F.col("node_blocked") - F.col("blocked")
    share = F.col("node_blocked") / F.col("node_labelled")
    error = F.sqrt(share * (1 - share) * (1 / F.col("labelled") + 1 / rest_n))
    alike = ((F.col("labelled") >= EVIDENCE) & (rest_n >= EVIDENCE)
             & (F.abs(F.col("blocked") / F.col("labelled") - rest_b / rest_n) <= Z * error))
    merged = ~number & (F.col("children") > 1) & F.coalesce(alike, F.lit(False))
    return rows.select("host", "prefix", "segment", F.when(variable, F.lit("{var}")).when(
        merged, F.lit("{any}")).otherwise(F.col("segment")).alias("step"), F.col("rows").alias("__rows"))


def _purity(of: DataFrame, share: Column, n: Column) -> DataFrame:
    """``of`` (l, b, p_share, p_n: own labels, and the evidence of the parent) with ``share`` and evidence ``n``."""
    own = F.col("l") >= EVIDENCE
    smoothed = (F.col("b") + PRIOR * F.col("p_share")) / (F.col("l") + PRIOR)
    return of.withColumn("share", F.when(own, smoothed).otherwise(share)).withColumn("n_labelled", F.when(own, F.col("l")).otherwise(n))


def path_templates(urls: DataFrame) -> DataFrame:
    """Distinct (host, path) of ``urls`` (host, path, labelled, blocked) with ``template``, ``blocked_share``, the number
    of labelled urls ``n_labelled`` that it rests on, and ``evidence``: template, shape (the template on all hosts) or parent.
    """
    counted = materialize(urls.select("host", "path", "labelled", "blocked").groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
        .withColumn("parts", F.split(F.regexp_replace("path", "^/", ""), "/")).withColumn("prefix", F.lit("")), "url_paths")
    everything = counted.agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"), F.count(F.lit(1)).alias("rows")).first()
    labelled, least = everything["n"] or 0, max(2, -(-everything["rows"] // SHARE))
    overall = (everything["b"] or 0) / labelled if labelled else 0.0
    sums = [F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"), F.count(F.lit(1)).alias("__rows")]

    def nodes(rows: DataFrame) -> DataFrame:
        """Nodes of open paths: paths and the evidence that what lies below is smoothed by."""
        node = rows.groupBy("host", "prefix").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"), F.max("p_share").alias("p_share"),
                                                  F.max("p_n").alias("p_n"), F.count(F.lit(1)).alias("__rows"))
        return _purity(node, F.col("p_share"), F.col("p_n")).select(
            "host", "prefix", "share", "n_labelled", F.col("__rows").alias("paths"), "__rows")

    open_, done, level = counted.withColumn("p_share", F.lit(overall)).withColumn("p_n", F.lit(labelled).cast("long")), [], 0
    while not open_.isEmpty():
        # a node with one path left ends its template with the rest of it
        held = _facts(open_.drop("p_share", "p_n"), materialize(nodes(open_), "url_nodes"), ["host", "prefix"], least)
        ended = (F.col("paths") == 1) | (F.size("parts") <= level)
        rest = F.transform(F.slice("parts", level + 1, F.greatest(F.size("parts") - level, F.lit(0))),
                           lambda s: F.when(s.rlike(NUMBER), F.lit("{var}")).otherwise(s))
        held = materialize(held.withColumnsRenamed({"share": "p_share", "n_labelled": "p_n"}).withColumn("ended", ended).withColumn(
            "template", F.array_join(F.concat(F.array("prefix"), rest), "/")), "url_paths")
        done.append(held.where("ended").select("host", "path", "labelled", "blocked", "template", "p_share", "p_n"))
        going = held.where("NOT ended").withColumn("segment", F.get("parts", F.lit(level)))
        counts = materialize(going.groupBy("host", "prefix", "segment").agg(*sums), "url_level")
        steps = materialize(_generalise(counts, least), "url_steps")
        open_ = materialize(_facts(going, steps, ["host", "prefix", "segment"], least).select(
            "host", "path", "n", "labelled", "blocked", "parts", F.concat("prefix", F.lit("/"), "step").alias("prefix"), "p_share", "p_n"), "url_paths")
        level += 1
    if not done:
        return counted.select("host", "path", F.col("prefix").alias("template"), F.lit(0.0).alias("blocked_share"),
                              F.lit(0).cast("long").alias("n_labelled"), F.lit("parent").alias("evidence"))
    closed = done[0]
    for more in done[1:]:
        closed = closed.unionByName(more)
    # paths that ended in one template of one host: their labels together; and those of all hosts
    total = lambda by, l, b: closed.groupBy(*by).agg(F.sum("labelled").alias(l), F.sum("blocked").alias(b), F.count(F.lit(1)).alias("__rows"))
    rows = _facts(closed.drop("labelled", "blocked"), materialize(total(["host", "template"], "l", "b"), "url_templates"), ["host", "template"], least)
    rows = _facts(rows, materialize(total(["template"], "shape_n", "shape_b"), "url_shapes"), ["template"], least)
    like = F.col("shape_n") >= EVIDENCE
    of_shape = (F.col("shape_b") + PRIOR * overall) / (F.col("shape_n") + PRIOR)
    judged = _purity(rows, F.when(like, of_shape).otherwise(F.col("p_share")), F.when(like, F.col("shape_n")).otherwise(F.col("p_n")))
    kind = F.when(F.col("l") >= EVIDENCE, F.lit("template")).when(like, F.lit("shape")).otherwise(F.lit("parent"))
    return judged.select("host", "path", "template", F.col("share").alias("blocked_share"), "n_labelled", kind.alias("evidence"))


def judge_urls(pages: DataFrame, id_col: str = "page_id", rules: tuple = RULES, threshold: float = 0.5) -> DataFrame:
    """Verdict of every row: the longest fitting rule's, else its template's (block above ``threshold``, on evidence).

    The rules' verdicts are the labels the tree learns from. Null urls and urls without ``://`` have an empty
    host and path, fit no rule and are judged by the overall share of blocked urls; repeated rows are judged
    alike; an empty table gives no rows.
    """
    host, path = split_url(F.col("url"))
    rows = materialize(pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
                       .withColumn("__rule", apply_rules(F.col("host"), F.col("path"), rules)), "urls")
    ruled = F.col("__rule").isNotNull()
    learned = path_templates(rows.select("host", "path", ruled.cast("long").alias("labelled"),
                                         F.coalesce(F.col("__rule.verdict") == "block", F.lit(False)).cast("long").alias("blocked")))
    repeats = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("__rows"))
    learned = materialize(learned.join(repeats, ["host", "path"]), "url_judged")
    judged = _facts(rows, learned, ["host", "path"], max(2, -(-rows.count() // SHARE)))
    rejected = (F.col("blocked_share") > threshold) & (F.col("n_labelled") >= EVIDENCE)
    return judged.select(
        id_col, "host", "path", F.col("__rule.rule").alias("rule"),
        F.coalesce("__rule.verdict", F.when(rejected, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "template", F.round("blocked_share", 6).alias("blocked_share"), "n_labelled", "evidence")
