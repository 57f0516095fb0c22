"""Trees: parsing, restriction to taxa, constraints and likelihood-ratio tests."""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_TOKEN = re.compile(r"\s*([(),;]|:\s*[-+0-9.eE]+|'(?:[^']|'')*'|[^(),:;\s]+)")


def parse_newick(text: str) -> list[tuple[int, int | None, str | None, float | None]]:
    """Nodes of a tree as (node, parent, name, branch length), the root first. Lengths may be in scientific notation."""
    nodes: list[list] = [[0, None, None, None]]
    here = 0
    for token in _TOKEN.findall(text):
        if token == "(":
            nodes.append([len(nodes), here, None, None])
            here = len(nodes) - 1
        elif token == ",":
            nodes.append([len(nodes), nodes[here][1], None, None])
            here = len(nodes) - 1
        elif token == ")":
            here = nodes[here][1]
        elif token == ";":
            break
        elif token.startswith(":"):
            nodes[here][3] = float(token[1:])
        else:
            nodes[here][2] = token.strip("'").replace("''", "'") if token.startswith("'") else token
    return [tuple(n) for n in nodes]


def plain(x: float) -> str:
    """A number without an exponent."""
    s = f"{x:.12f}".rstrip("0").rstrip(".")
    return s or "0"


def write_newick(nodes) -> str:
    children: dict[int | None, list] = {}
    for n in nodes:
        children.setdefault(n[1], []).append(n)

    out, todo = [], [children[None][0]]
    while todo:  # a stack, as trees may be deeper than Python's calls
        n = todo.pop()
        if isinstance(n, str):
            out.append(n)
            continue
        tail = (n[2] or "") + (f":{plain(n[3])}" if n[3] is not None else "")
        below = children.get(n[0], [])
        if not below:
            out.append(tail)
            continue
        out.append("(")
        todo.append(")" + tail)
        for k, c in enumerate(reversed(below)):
            todo += [",", c] if k else [c]
    return "".join(out) + ";"


def restrict_tree(text: str, taxa: set[str], unroot: bool = True) -> str | None:
    """The tree of some taxa: others go, nodes of one child are merged with their branch lengths summed, and a root of
    two children is opened. Distances between the taxa that stay are kept. None without two taxa."""
    nodes = {n[0]: list(n) for n in parse_newick(text)}
    children: dict[int, list[int]] = {}
    for n in nodes.values():
        if n[1] is not None:
            children.setdefault(n[1], []).append(n[0])
    keep: dict[int, list[int]] = {}
    for i in sorted(nodes, reverse=True):  # children have larger numbers
        below = [c for c in children.get(i, []) if c in keep]
        if not children.get(i):
            if nodes[i][2] in taxa:
                keep[i] = []
        elif len(below) == 1 and nodes[i][1] is not None:
            child = below[0]
            a, b = nodes[i][3], nodes[child][3]
            nodes[child][3] = None if a is None and b is None else (a or 0.0) + (b or 0.0)
            keep[i] = keep.pop(child)
            nodes[i][2], nodes[i][3] = nodes[child][2], nodes[child][3]
        elif below:
            keep[i] = below
    root = 0
    if root not in keep:
        return None
    while len(keep[root]) == 1 and keep[keep[root][0]]:
        root = keep[root][0]
    if len(keep[root]) < 2:
        return None
    if unroot and len(keep[root]) == 2:
        inner = next((c for c in keep[root] if keep[c]), None)
        if inner is not None:
            other = next(c for c in keep[root] if c != inner)
            a, b = nodes[inner][3], nodes[other][3]
            nodes[other][3] = None if a is None and b is None else (a or 0.0) + (b or 0.0)
            keep[root] = [*keep[inner], other]
    out, todo = [], [(root, None)]
    while todo:
        i, parent = todo.pop()
        out.append((i, parent, nodes[i][2], None if parent is None else nodes[i][3]))
        todo += [(c, i) for c in reversed(keep[i])]
    return write_newick(out)


def restrict_trees(trees: DataFrame, taxa: DataFrame) -> DataFrame:
    """Trees (``locus, newick``) of the taxa that each locus has (``locus, taxon``): ``locus, newick, n_taxa``."""
    present = taxa.groupBy("locus").agg(F.collect_set("taxon").alias("_taxa"))

    @F.pandas_udf("string")
    def restrict(newick: pd.Series, names: pd.Series) -> pd.Series:
        return pd.Series([restrict_tree(t, set(n)) for t, n in zip(newick, names)], dtype=object)

    return trees.join(present, "locus").select("locus", restrict("newick", "_taxa").alias("newick"), F.size("_taxa").alias("n_taxa"))


class NewickNodes:
    """The nodes of a tree as rows: a table function, for DataFrames (:func:`tree_rows`) and, once registered, for SQL."""

    def eval(self, newick: str):
        if newick is None:
            return
        nodes, far = parse_newick(newick), []
        for node, parent, name, length in nodes:  # parents come first
            far.append(0.0 if parent is None else far[parent] + (length or 0.0))
            yield node, parent, name, length, far[node]


newick_nodes = F.udtf(NewickNodes, returnType="node: bigint, parent: bigint, name: string, branch_length: double, from_root: double")


def register(spark: SparkSession) -> None:
    """The table function ``newick_nodes(text)`` for ``LATERAL`` in SQL."""
    spark.udtf.register("newick_nodes", newick_nodes)


def tree_rows(trees: DataFrame) -> DataFrame:
    """Nodes of each tree: ``locus, node, parent, name, branch_length, from_root`` (the sum of lengths from the root), by a lateral join
    with the table function. Trees of any depth; null texts have no nodes."""
    return trees.select("locus", "newick").lateralJoin(newick_nodes(F.col("newick").outer())).drop("newick")


def rename_taxa(rows: DataFrame) -> DataFrame:
    """Short names for the taxa of each locus, by the order of the names: ``locus, taxon, short``."""
    w = F.row_number().over(Window.partitionBy("locus").orderBy("taxon"))
    return rows.select("locus", "taxon").distinct().withColumn("short", F.concat(F.lit("taxon"), w.cast("string")))


def constraint_trees(groups: DataFrame, taxa: DataFrame) -> DataFrame:
    """A constraint for each locus out of groups (``group_id, taxon``) and the taxa that it has: ``locus, newick``.

    Groups are restricted to the taxa present; taxa in no group stand beside them. A locus in which no group has two
    members is left out."""
    own = taxa.select("locus", "taxon").distinct().join(groups.select("group_id", "taxon").distinct(), "taxon", "left")
    grouped = own.where("group_id IS NOT NULL").groupBy("locus", "group_id").agg(F.array_sort(F.collect_list("taxon")).alias("t"))
    parts = grouped.select("locus", F.when(F.size("t") > 1, F.concat(F.lit("("), F.array_join("t", ","), F.lit(")"))).otherwise(F.element_at("t", 1)).alias("part"), (F.size("t") > 1).alias("real"))
    rest = own.where("group_id IS NULL").select("locus", F.col("taxon").alias("part"), F.lit(False).alias("real"))
    return parts.unionByName(rest).groupBy("locus").agg(F.array_join(F.array_sort(F.collect_list("part")), ",").alias("p"), F.bool_or("real").alias("ok")).where("ok").select("locus", F.concat(F.lit("("), "p", F.lit(");")).alias("newick"))


def chi2_upper(x: float, df: float) -> float:
    """Upper tail of the chi-squared distribution, by the series or the continued fraction of the incomplete gamma."""
    if df <= 0 or math.isnan(x):
        return math.nan
    if x <= 0:
        return 1.0
    a, x = df / 2, x / 2
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-15:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1 - total * front)
    b, c = x + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b if an * d + b else 1e-300)
        c = b + an / c if b + an / c else 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def likelihood_ratio(rows: DataFrame, least_taxa: int = 3) -> DataFrame:
    """Clock tests: ``locus, lrt, df, p`` from ``locus, n_taxa, ln_free, ln_clock``. Fewer taxa leave a locus out."""

    @F.pandas_udf("double")
    def tail(x: pd.Series, df: pd.Series) -> pd.Series:
        return pd.Series([chi2_upper(a, b) for a, b in zip(x, df)])

    lrt = 2 * (F.col("ln_free") - F.col("ln_clock"))
    out = rows.where(F.col("n_taxa") >= least_taxa).select("locus", lrt.alias("lrt"), (F.col("n_taxa") - 2).alias("df"))
    return out.withColumn("p", tail("lrt", F.col("df").cast("double")))


def clocklike(rows: DataFrame, conf: float = 0.05) -> DataFrame:
    """Loci that don't reject the clock."""
    return likelihood_ratio(rows).where(F.col("p") > conf)


def paired_trees(trees: DataFrame, constrained: DataFrame) -> DataFrame:
    """Two tables of trees (``locus, newick``) joined by name: ``locus, newick, constrained``. A locus that either lacks
    stops the query."""
    both = trees.select("locus", F.col("newick").alias("_a")).join(constrained.select("locus", F.col("newick").alias("_b")), "locus", "full_outer")
    sound = F.assert_true(F.col("_a").isNotNull() & F.col("_b").isNotNull(), F.concat(F.lit("no tree of one kind for "), "locus"))
    return both.select("locus", F.when(sound.isNull(), F.col("_a")).alias("newick"), F.col("_b").alias("constrained"))


def monophyletic(tests: DataFrame, conf: float = 0.05) -> DataFrame:
    """Loci whose constrained tree is not rejected (``p``) or is the better one (``constrained_best``)."""
    return tests.where((F.col("p") > conf) | F.col("constrained_best"))


def enough_difference(distances: DataFrame, least: float = 0) -> DataFrame:
    """Loci whose mean pairwise difference is beyond a threshold."""
    return distances.where(F.col("mean_distance") > least)
