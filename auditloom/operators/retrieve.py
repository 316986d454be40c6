"""Monitoring, graphs and retrieval over text and vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from auditloom.sources.scratch import remove, written


def unseen(items: DataFrame, seen: DataFrame, source: str, item: str, order: list, keep: int = 200) -> DataFrame:
    """Items not among each source's ``keep`` latest seen ones."""
    w = Window.partitionBy(source).orderBy(*order)
    latest = seen.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= keep).select(source, item)
    return items.join(latest, [source, item], "left_anti")


def bare_id(item: Column) -> Column:
    """An id without its version suffix."""
    return F.regexp_replace(item, r"v[0-9]+$", "")


def due(sources: DataFrame, state: DataFrame, now: Column) -> DataFrame:
    """``source, last_run``: enabled sources whose cadence in days has passed since their last run, or that never ran."""
    known = sources.where("enabled").join(state.select("source", "last_run"), "source", "left")
    passed = F.col("last_run").isNull() | (F.unix_timestamp(now) - F.unix_timestamp("last_run") >= F.col("cadence_days") * 86400)
    return known.where(passed).select("source", "last_run")


def advanced(state: DataFrame, runs: DataFrame, keep: int = 200) -> DataFrame:
    """``source, last_run, seen, total_seen, last_error`` after ``runs(source, ok, at, items, error)``.

    Only a run that went well moves a source's cursor: its items, versions left out, go in
    front of those seen before, of which the latest ``keep`` stay. A failed run leaves the
    cursor and its error; the next due run starts from the same place.
    """
    j = state.alias("s").join(runs.alias("r"), "source", "full_outer")
    ok = F.coalesce(F.col("r.ok"), F.lit(False))
    none = F.array().cast("array<string>")
    fresh = F.array_except(F.array_distinct(F.transform(F.coalesce("r.items", none), bare_id)), F.coalesce("s.seen", none))
    seen = F.slice(F.concat(fresh, F.coalesce("s.seen", none)), 1, keep)
    return j.select(
        "source", F.when(ok, F.col("r.at")).otherwise(F.col("s.last_run")).alias("last_run"), F.when(ok, seen).otherwise(F.coalesce("s.seen", none)).alias("seen"),
        (F.coalesce("s.total_seen", F.lit(0).cast("long")) + F.when(ok, F.size(fresh)).otherwise(0)).cast("long").alias("total_seen"),
        F.when(ok, F.lit(None).cast("string")).otherwise(F.coalesce("r.error", "s.last_error")).alias("last_error"),
    )


# ---- knowledge graph ------------------------------------------------------------------

# Kinds of relations between papers.
RELATIONS = "cites contradicts extends replicates uses-method uses-theory".split()


def search(nodes: DataFrame, words: str, fields: list[str]) -> DataFrame:
    """``nodes`` in which each of the words occurs in one of the fields, with ``hits``, how many fields have any."""
    wanted = [w for w in words.lower().split() if w]
    has = lambda w, f: F.coalesce(F.lower(f).contains(w), F.lit(False))
    found = nodes
    for w in wanted:
        found = found.where(F.exists(F.array(*[has(w, f) for f in fields]), lambda x: x))
    any_of = [F.exists(F.array(*[has(w, f) for w in wanted] or [F.lit(False)]), lambda x: x).cast("long") for f in fields]
    return found.withColumn("hits", sum(any_of, F.lit(0).cast("long")))


def relate(edges: DataFrame, paper: str, other: str | None = None) -> DataFrame:
    """``kind, direction, other`` of a paper's relations, or of those between two papers."""
    out = edges.where(F.col("src") == paper).select("kind", F.lit("out").alias("direction"), F.col("dst").alias("other"))
    both = out.union(edges.where(F.col("dst") == paper).select("kind", F.lit("in"), "src")).distinct()
    return both.where(F.col("other") == other) if other is not None else both


def distances(edges: DataFrame, starts: DataFrame, depth: int | None = None) -> DataFrame:
    """``id, steps``: the nodes that ``starts(id)`` reach along ``edges(src, dst)``, and the fewest steps to them; starts are 0 away.

    A search by frontiers: what is reached first is joined with the edges once, is written, and
    joins what was reached before, so a node is gone through once, however many paths lead to
    it. Null ids and edges with a null end are left out. Rounds are as many as the longest
    distance, or ``depth``.
    """
    spark = edges.sparkSession
    own, at = written(edges.where("src IS NOT NULL AND dst IS NOT NULL").select("src", "dst").distinct(), "edges")
    front, path = written(starts.where("id IS NOT NULL").select("id").distinct().withColumn("steps", F.lit(0)), "front")
    paths, schema, step = [path], front.schema, 0
    read = lambda where: spark.read.schema(schema).parquet(*where)
    while depth is None or step < depth:
        step += 1
        near = own.join(front.select(F.col("id").alias("src")), "src").select(F.col("dst").alias("id")).distinct()
        front, path = written(near.join(read(paths).select("id"), "id", "left_anti").withColumn("steps", F.lit(step)), "front")
        if front.isEmpty():
            remove(spark, path)
            break
        paths.append(path)
    out, _ = written(read(paths), "distances")
    for p in (at, *paths):
        remove(spark, p)
    return out


def lineage(edges: DataFrame, paper: str, kind: str = "extends", depth: int = 5) -> DataFrame:
    """``id, steps``: what a paper rests on through relations of a kind, the fewest steps counted; at most ``depth``."""
    start = edges.sparkSession.createDataFrame([(paper,)], edges.select(F.col("src").alias("id")).schema)
    return distances(edges.where(F.col("kind") == kind), start, depth).where("steps > 0")


def relations(edges: DataFrame) -> DataFrame:
    """``id, kind, direction, n``: every node's relations of each kind and direction, parallel ones once."""
    once = edges.select("src", "kind", "dst").distinct()
    ends = once.select(F.col("src").alias("id"), "kind", F.lit("out").alias("direction")).union(once.select("dst", "kind", F.lit("in")))
    return ends.groupBy("id", "kind", "direction").agg(F.count("*").alias("n"))


def graph_status(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``what, n``: nodes, edges, edges of each kind, nodes that no edge touches."""
    count = lambda df, what: df.agg(F.lit(what).alias("what"), F.count("*").alias("n"))
    kinds = edges.groupBy(F.concat(F.lit("edges: "), "kind").alias("what")).agg(F.count("*").alias("n"))
    return count(nodes, "nodes").union(count(edges, "edges")).union(kinds).union(count(gaps(nodes, edges), "isolated"))


def export(nodes: DataFrame, edges: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """The nodes that are kept, and the edges that have both ends among them."""
    some = nodes.where(keep)
    ids = some.select(F.col("id")).distinct()
    inside = edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    return some, inside


def bibtex(nodes: DataFrame) -> DataFrame:
    """``id, entry`` of papers with ``id, title, authors, year``; braces keep the case of titles."""
    field = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"  {name} = {{"), value, F.lit("}")))
    fields = F.array_compact(F.array(field("title", F.concat(F.lit("{"), "title", F.lit("}"))), field("author", F.array_join("authors", " and ")), field("year", F.col("year").cast("string"))))
    return nodes.select("id", F.concat(F.lit("@article{"), F.col("id").cast("string"), F.lit(",\n"), F.array_join(fields, ",\n"), F.lit("\n}")).alias("entry"))


def contradictions(edges: DataFrame) -> DataFrame:
    """``dst, supporters, contradictors, pairs, first_support, first_against``: targets that one side supports and another contradicts.

    ``pairs`` counts the pairs of different sources, which are not made: a target that very
    many support and contradict is one row.
    """
    sides = edges.where("kind IN ('supports', 'contradicts')").groupBy("dst", "src").agg(F.bool_or(F.col("kind") == "supports").alias("s"), F.bool_or(F.col("kind") == "contradicts").alias("c"))
    s, c = F.count_if("s"), F.count_if("c")
    pairs = s * c - F.count_if(F.col("s") & F.col("c"))
    out = sides.groupBy("dst").agg(s.alias("supporters"), c.alias("contradictors"), pairs.alias("pairs"), F.min(F.when(F.col("s"), F.col("src"))).alias("first_support"), F.min(F.when(F.col("c"), F.col("src"))).alias("first_against"))
    return out.where("pairs > 0")


def gaps(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes that no edge touches."""
    touched = edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()
    return nodes.join(touched, "id", "left_anti")


def communities(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components by smallest label with shortcuts; every round is written, and the one before it goes.

    ``edges(src, dst)`` to ``id, root``, with ids of any one type that orders; an edge with a
    null end is left out, a loop makes its node a component. The rounds grow with the
    logarithm of the longest path; components that haven't settled after ``max_rounds`` raise
    an error.
    """
    spark = edges.sparkSession
    ends = edges.where("src IS NOT NULL AND dst IS NOT NULL")
    both, at = written(ends.select(F.col("src").alias("a"), F.col("dst").alias("b")).union(ends.select("dst", "src")).distinct(), "edges")
    label, before, last = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("root")), None, None
    for _ in range(max_rounds):
        near = both.join(label.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("n"))
        step = label.join(near, "id").select("id", F.least("root", "n").alias("root"))
        jump = step.alias("x").join(step.alias("y"), F.col("x.root") == F.col("y.id")).select(F.col("x.id").alias("id"), F.least("x.root", "y.root").alias("root"))
        label, path = written(jump, "labels")
        if last:
            remove(spark, last)
        now, last = label.agg(F.sum(F.xxhash64("id", "root").cast("decimal(38,0)"))).first()[0], path
        if now == before:
            remove(spark, at)
            return label
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


# ---- retrieval ------------------------------------------------------------------------


def terms(text: Column | str) -> Column:
    """Lower-case ASCII words and numbers of a text."""
    return F.filter(F.split(F.lower(text), r"[^a-z0-9]+"), lambda x: x != "")


def bm25(df: DataFrame, query_terms: list[str], key: str, text: str = "text", k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """``key, score`` of the documents that hold a term of the query.

    Texts are read once, to their length and the counts of the query's terms, which are
    written; the totals of those are one row. No term is shuffled.
    """
    wanted = list(dict.fromkeys(query_terms))
    counted = df.select(key, terms(text).alias("_w")).where(F.size("_w") > 0)
    often = lambda t: F.size(F.filter("_w", lambda x: x == t))
    own = [often(t).alias(f"_t{i}") for i, t in enumerate(wanted)]
    narrow, _ = written(counted.select(key, F.size("_w").alias("_dl"), *own), "terms")
    stats = narrow.agg(F.count("*").alias("_n"), F.avg("_dl").alias("_avg"), *[F.count_if(F.col(f"_t{i}") > 0).alias(f"_d{i}") for i in range(len(wanted))])
    rows = narrow.where(F.greatest(F.lit(0), *[F.col(f"_t{i}") for i in range(len(wanted))]) > 0).crossJoin(F.broadcast(stats))  # one row
    norm = k1 * (1 - b + b * F.col("_dl") / F.col("_avg"))
    part = lambda i: F.log(1 + (F.col("_n") - F.col(f"_d{i}") + 0.5) / (F.col(f"_d{i}") + 0.5)) * F.col(f"_t{i}") * (k1 + 1) / (F.col(f"_t{i}") + norm)
    return rows.select(key, sum((part(i) for i in range(len(wanted))), F.lit(0.0)).alias("score"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def top_k(scores: DataFrame, k: int, order: list, group: str | None = None) -> DataFrame:
    """The k best rows by ``order``, with ``rank``; without a group as a bounded heap per task."""
    if group is None:
        best = scores.orderBy(*order).limit(k)
        return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))
    return scores.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long")).where(F.col("rank") <= k)


def fuse(a: DataFrame, b: DataFrame, key: str, constant: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of two rankings."""
    j = a.select(key, F.col("rank").alias("ra")).join(b.select(key, F.col("rank").alias("rb")), key, "full_outer")
    part = lambda r: F.coalesce(1.0 / (F.lit(constant) + F.col(r)), F.lit(0.0))
    return j.select(key, (part("ra") + part("rb")).alias("score"))


def chunks(df: DataFrame, key: str, text: str = "text", size: int = 1000) -> DataFrame:
    """Fixed chunks of characters: ``key, chunk, body``; a text's last chunk may be short."""
    n = F.ceil(F.length(text) / size).cast("int")
    return df.where(F.length(text) > 0).select(key, text, F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk")).select(key, F.col("chunk").cast("long").alias("chunk"), F.expr(f"substring({text}, chunk * {size} + 1, {size})").alias("body"))


# Headings of a paper's sections, as they stand alone in a line, and what they count as.
SECTIONS = {
    "abstract": "abstract|summary", "introduction": "introduction|background", "theory": "theory|literature review|theoretical framework|related work",
    "data": "data|data and methods|sample|materials", "methods": "methods?|methodology|analytic strategy|measures", "results": "results|findings|analysis",
    "discussion": "discussion|limitations", "conclusion": "conclusions?|concluding remarks", "references": "references|bibliography|works cited", "appendix": "appendix|supplementary materials?",
}
HEADING = rf"(?im)^[ \t]*(?:#{{1,4}}[ \t]+)?(?:[0-9]+(?:\.[0-9]+)*\.?[ \t]+)?({'|'.join(SECTIONS.values())})[ \t]*:?[ \t]*$"


def section_name(heading: Column) -> Column:
    """What a heading counts as; anything else is the front."""
    out = F.when(F.lit(False), "")
    for name, forms in SECTIONS.items():
        out = out.when(F.lower(heading).rlike(f"^({forms})$"), name)
    return out.otherwise("front")


def section_chunks(df: DataFrame, key: str, text: str = "text", size: int = 1000, only: list[str] | None = None, with_references: bool = False) -> DataFrame:
    """``key, section, part, chunk, body``: chunks that never cross a section's heading, in rows' own arrays.

    ``part`` numbers a document's sections from 0, the front; headings are no chunk. The list
    of references is left out unless asked for; ``only`` keeps sections by name.
    """
    names = F.concat(F.array(F.lit("")), F.regexp_extract_all(text, F.lit(HEADING), F.lit(1)))
    parts = F.arrays_zip(names.alias("name"), F.split(text, HEADING, -1).alias("body"))
    rows = df.select(key, F.posexplode(parts).alias("part", "p")).select(key, F.col("part").cast("long").alias("part"), section_name(F.col("p.name")).alias("section"), F.btrim("p.body", F.lit("\n")).alias("_b"))
    if not with_references:
        rows = rows.where("section <> 'references'")
    if only is not None:
        rows = rows.where(F.col("section").isin(only))
    return chunks(rows.withColumn("_k", F.struct(key, "section", "part")), "_k", "_b", size).select(F.col(f"_k.{key}").alias(key), "_k.section", "_k.part", "chunk", "body")


def eav_pivot(facts: DataFrame, item: str, field: str, value: str, fields: list[str]) -> DataFrame:
    """Entity-attribute-value rows as one row an item, in one aggregation."""
    return facts.groupBy(item).agg(*[F.max(F.when(F.col(field) == f, F.col(value))).alias(f) for f in fields])
