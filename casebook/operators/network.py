"""The citation network: merging, filtering, expansion, statistics."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions import fixed
from casebook.operators.tables import kept, union_distinct

SEARCHED = ("title", "summary", "full_text")


def merge_lines(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Stored and new lines as one set."""
    return new.distinct() if old is None else union_distinct(old, new)


def courts(names: list[str]) -> list[str]:
    """Court names, groups replaced by their members."""
    return [c for n in names for c in fixed.COURT_GROUPS.get(n, (n,))]


def keyword_filter(query: str, columns: list[str]) -> Column:
    """A simple query text over ``columns``: words must all occur; ``|`` is or, ``-`` not, quotes make a phrase, ``*`` a prefix, parentheses group."""
    tokens = re.findall(r'-?"[^"]*"|[()|+]|[^\s()|+"]+', query)
    text = F.lower(F.concat_ws("\n", *columns))

    def term(t: str) -> Column:
        if t.startswith("-") and len(t) > 1:
            return ~term(t[1:])
        t = t.lower()
        if t.startswith('"'):
            return F.contains(text, F.lit(t.strip('"')))
        body = re.escape(t.rstrip("*"))
        return text.rlike(rf"(?<![\p{{L}}\p{{N}}]){body}" + ("" if t.endswith("*") else r"(?![\p{L}\p{N}])"))

    def disjunction(i: int) -> tuple[Column, int]:
        c, i = conjunction(i)
        while i < len(tokens) and tokens[i] == "|":
            d, i = conjunction(i + 1)
            c = c | d
        return c, i

    def conjunction(i: int) -> tuple[Column, int]:
        c = None
        while i < len(tokens) and tokens[i] not in ("|", ")"):
            if tokens[i] == "+":
                i += 1
                continue
            if tokens[i] == "(":
                d, i = disjunction(i + 1)
                i += 1
            else:
                d, i = term(tokens[i]), i + 1
            c = d if c is None else c & d
        return (F.lit(True) if c is None else c), i

    return disjunction(0)[0]


def filter_cases(
    cases: DataFrame, sources=("RS",), date_start: str = "1900-01-01", date_end: str = "2021-12-12", doc_types=("DEC",), instances=(), domains=(),
    articles: str = "", eclis: str = "", keywords: str = "", searched=SEARCHED,
) -> DataFrame:
    """Cases that meet all given conditions; at least one of eclis, keywords, articles, instances, domains must be given."""
    if not (eclis or keywords or articles or instances or domains):
        raise ValueError("give at least one of: eclis, keywords, articles, instances, domains")
    conds = [F.col("date_decision").between(F.lit(date_start).cast("date"), F.lit(date_end).cast("date"))]
    listed = lambda t: [x for x in re.split(r"[\s,;]+", t) if x]
    if sources:
        conds.append(F.col("source").isin(*sources))
    if doc_types:
        conds.append(F.col("document_type").isin(*doc_types))
    if instances:
        conds.append(F.col("instance").isin(*courts(list(instances))))
    if domains:
        conds.append(F.arrays_overlap("domains", F.array(*map(F.lit, domains))))
    if articles:
        conds.append(F.arrays_overlap("articles", F.array(*map(F.lit, [a.strip() for a in articles.split(",")]))))
    if eclis:
        conds.append(F.col("ecli").isin(*listed(eclis)))
    if keywords:
        conds.append(keyword_filter(keywords, [c for c in searched if c in cases.columns]))
    return cases.where(reduce(lambda a, b: a & b, conds))


def expand(seeds: DataFrame, edges: DataFrame, degrees_sources: int = 0, degrees_targets: int = 1) -> DataFrame:
    """``id`` of the seeds and of all nodes up to so many hops against and along the edges ``(source, target)``.

    Each hop joins only the nodes that are new, and the two directions start from the seeds each.
    """
    seeds = seeds.select(F.col("id")).distinct()

    def walk(hops: int, at: str, to: str) -> DataFrame:
        seen = front = seeds
        for k in range(hops):
            front = edges.join(front, edges[at] == front["id"], "left_semi").select(F.col(to).alias("id")).distinct().join(seen, "id", "left_anti")
            if k + 1 < hops:
                front = kept(front)  # read by the next hop and by the result
            seen = seen.unionByName(front)
        return seen

    back, ahead = walk(degrees_sources, "target", "source"), walk(degrees_targets, "source", "target")
    return back.unionByName(ahead).distinct()


def induced(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with both ends among ``nodes(id)``."""
    ids = nodes.select("id")
    return edges.join(ids, edges["source"] == ids["id"], "left_semi").join(ids, edges["target"] == ids["id"], "left_semi")


ATTRIBUTES = {"ID": ("id",), "QUERYHANDLER": ("id", "date_decision", "source"), "NETWORKSTATS": ("id", "date_decision", "instance"), "ALL": None}


def fetch(nodes: DataFrame, cases: DataFrame, attributes: str = "ALL") -> DataFrame:
    """Attributes of the nodes ``(id)``, as columns."""
    rows = cases.join(nodes.select("id"), "id", "left_semi")
    return rows if ATTRIBUTES[attributes] is None else rows.select(*[c for c in ATTRIBUTES[attributes] if c in rows.columns])


def query_network(cases: DataFrame, edges: DataFrame, degrees_sources: int = 0, degrees_targets: int = 1, limit: int | None = None, attributes: str = "ALL", **conditions) -> tuple[DataFrame, DataFrame, str]:
    """``(nodes(id, data), edges(id, source, target), message)``; ``data`` is JSON. With ``limit``, the smallest ids, and a message if there are more."""
    seeds = filter_cases(cases, **conditions).select(F.col("ecli").alias("id"))
    ids, message = expand(seeds, edges, degrees_sources, degrees_targets), ""
    if limit is not None:
        if ids.limit(limit + 1).count() > limit:
            message = f"the result is cut to {limit} nodes"
        ids = ids.orderBy("id").limit(limit)
    rows = fetch(ids, cases.withColumn("id", F.col("ecli")), attributes)
    nodes = rows.select("id", F.to_json(F.struct(*[c for c in rows.columns if c != "id"] or ["id"])).alias("data"))
    found = induced(ids, edges).select(F.concat_ws("_", "source", "target").alias("id"), "source", "target")
    return nodes, found, message


def degrees(edges: DataFrame) -> DataFrame:
    """``(id, in_degree, out_degree, degree)`` of every node on an edge: one aggregate over both ends."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("source").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")), F.struct(F.col("target").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")))).alias("e")).select("e.*")
    out = ends.groupBy("id").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))
    return out.withColumn("degree", F.col("in_degree") + F.col("out_degree"))


def pagerank(nodes: DataFrame, edges: DataFrame, rounds: int = 5, damping: float = 0.85) -> DataFrame:
    """``(id, rank)`` after a fixed number of rounds; ranks sum to 1, those of nodes without targets are shared by all."""
    ids = nodes.select("id").distinct()
    n = ids.count()
    if not n:
        return ids.withColumn("rank", F.lit(0.0))
    edges = kept(edges.select("source", "target"))
    out = edges.groupBy(F.col("source").alias("id")).agg(F.count(F.lit(1)).alias("out"))
    base = kept(ids.join(out, "id", "left"))
    rank = base.withColumn("rank", F.lit(1.0 / n))
    for k in range(rounds):
        idle = rank.where("out is null").agg(F.coalesce(F.sum("rank"), F.lit(0.0)).alias("idle"))
        given = edges.join(rank.select(F.col("id").alias("source"), (F.col("rank") / F.col("out")).alias("part")), "source").groupBy(F.col("target").alias("id")).agg(F.sum("part").alias("got"))
        new = base.join(given, "id", "left")
        rank = new.select("id", "out", ((1 - damping) / n + damping * (F.coalesce("got", F.lit(0.0)) + idle.scalar() / n)).alias("rank"))
        if k + 1 < rounds:
            rank = kept(rank)  # read twice in the next round
    return rank.select("id", "rank")


def statistics(nodes: DataFrame, edges: DataFrame, rounds: int = 5) -> DataFrame:
    """``(id, in_degree, out_degree, degree, rank)`` for every node."""
    d = nodes.select("id").distinct().join(degrees(edges), "id", "left").na.fill(0, ["in_degree", "out_degree", "degree"])
    return d.join(pagerank(nodes, edges, rounds), "id")
