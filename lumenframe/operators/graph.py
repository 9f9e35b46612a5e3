"""Property-graph operators over an edge table (edge_idx, relationship_id, type, source_id, target_id, start_us, end_us).

Breadth-first search runs one join a level; the queue's order is kept as ranks, so that which edge and which parent
come first is the same for any number of partitions. A level's edges join the frontier by an equality on node ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .export import with_line_numbers
from .intervals import in_window
from .lineage import settled
from .search import relationship_class


def select_edges(edges: DataFrame, of_class: str | None = None, of_type: str | None = None, at_us: int | None = None, start_us: int | None = None, end_us: int | None = None) -> DataFrame:
    """Edges with both ends, of a class (all: any) and exact type, whose time matches; relationship_class is added."""
    df = edges.filter((F.coalesce("source_id", F.lit("")) != "") & (F.coalesce("target_id", F.lit("")) != ""))
    df = df.withColumn("relationship_class", relationship_class(F.col("type")))
    if of_class and of_class != "all":
        df = df.filter(F.col("relationship_class") == of_class)
    if of_type:
        df = df.filter(F.col("type") == of_type)
    return df.filter(in_window(F.col("start_us"), F.col("end_us"), at_us, start_us, end_us))


def _slots(edges: DataFrame, direction: str) -> DataFrame:
    """Adjacency slots: (node, dir 0 out or 1 in, edge_idx, relationship_id, next)."""
    cols = ["edge_idx", F.coalesce("relationship_id", F.lit("")).alias("relationship_id")]
    out = edges.select(F.col("source_id").alias("node"), F.lit(0).alias("dir"), *cols, F.col("target_id").alias("next"))
    into = edges.select(F.col("target_id").alias("node"), F.lit(1).alias("dir"), *cols, F.col("source_id").alias("next"))
    if direction not in ("outgoing", "incoming", "both"):
        raise ValueError("direction is outgoing, incoming or both")
    return out if direction == "outgoing" else into if direction == "incoming" else out.unionByName(into)


class Traversal:
    """nodes: (node, depth, node_rank); edges: (edge_idx, relationship_id, dir, depth, edge_rank); limit_applied."""

    def __init__(self, nodes: DataFrame, edges: DataFrame, limit_applied: bool):
        self.nodes, self.edges, self.limit_applied = nodes, edges, limit_applied


def traverse(edges: DataFrame, start: str, depth: int = 2, direction: str = "both", limit: int | None = None) -> Traversal:
    """Breadth-first from `start`: out-edges before in-edges, edges in edge_idx order; an edge with an id once.

    The limit is on edges and is met when a further slot is looked at after the last edge it allows. Nodes at the full
    depth are listed and not followed. Adjacency is settled once. A level's slots have the order (rank of their node,
    direction, edge), so only its new nodes are numbered, by ranges of that order; no task holds a level."""
    if not start:
        raise ValueError("a start id is needed")
    spark = edges.sparkSession
    slots = settled(_slots(edges, direction))
    order = ["node_rank", "dir", "edge_idx"]
    frontier = spark.createDataFrame([(start, 0, 0)], "node string, depth int, node_rank long")
    nodes, found = frontier, None
    count, rank, hit = 0, 1, False
    for level in range(depth):
        seen = slots.join(frontier.select("node", "node_rank"), "node")
        # The first slot of each id counts; slots without an id always do, and stand alone.
        alone = F.when(F.col("relationship_id") == "", F.struct("edge_idx", "dir", "node"))
        new = seen.withColumn("_first", F.row_number().over(Window.partitionBy("relationship_id", alone).orderBy(*order))).filter("_first = 1").drop("_first")
        if found is not None:
            new = new.join(found.filter("relationship_id <> ''").select("relationship_id").distinct(), "relationship_id", "left_anti")
        new = settled(new)
        total = new.count()
        room = total if limit is None else max(0, limit - count)
        emitted = new if total <= room else settled(new.orderBy(*order).limit(room))  # what the limit lets through
        if limit is not None and total >= room:
            last = emitted.agg(F.max(F.struct(*order)).alias("m")).first()["m"]
            after = seen if last is None else seen.filter(F.struct(*order) > F.struct(*[F.lit(last[c]).cast(seen.schema[c].dataType).alias(c) for c in order]))
            hit = bool(after.head(1))
        level_edges = emitted.select("edge_idx", "relationship_id", "dir", F.lit(level + 1).alias("depth"), "node_rank", "node", "next")
        found = level_edges if found is None else found.unionByName(level_edges)
        fresh = emitted.groupBy(F.col("next").alias("node")).agg(F.min(F.struct(*order)).alias("_slot")).join(nodes.select("node"), "node", "left_anti")
        frontier = settled(with_line_numbers(fresh, ["_slot"]).select("node", F.lit(level + 1).alias("depth"), (F.col("line_no") + rank - 1).alias("node_rank")))
        nodes = nodes.unionByName(frontier)
        count += min(total, room)
        size = frontier.count()
        rank += size
        if hit or not size:
            break
    if found is None:
        found = slots.limit(0).select("edge_idx", "relationship_id", "dir", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("edge_rank"), "node", "next")
    else:
        found = with_line_numbers(found, ["depth", *order]).select("edge_idx", "relationship_id", "dir", "depth", F.col("line_no").alias("edge_rank"), "node", "next")
    return Traversal(nodes, found, hit)


def shortest_path(edges: DataFrame, start: str, goal: str, depth: int = 2, direction: str = "both") -> list[dict] | None:
    """The path that the search finds first, as one dict for each step; [] from a node to itself, None if there is none.

    The way back reads one row a level from the settled levels."""
    if start == goal:
        return []
    t = traverse(edges, start, depth, direction)
    parent = t.edges.withColumn("_n", F.row_number().over(Window.partitionBy("next").orderBy("edge_rank"))).filter("_n = 1")
    steps, at = [], goal
    if not t.nodes.filter(F.col("node") == goal).head(1):
        return None
    while at != start:
        row = parent.filter(F.col("next") == at).first()
        steps.append({"edge_idx": row["edge_idx"], "source": row["node"], "target": at, "direction": "outgoing" if row["dir"] == 0 else "incoming"})
        at = row["node"]
    return steps[::-1]


def star(edges: DataFrame, node: str, limit: int | None = None) -> DataFrame:
    """One hop around a node in edge order: (edge_idx, relationship_id, type, direction, neighbor); neighbours repeat."""
    df = edges.filter((F.col("source_id") == node) | (F.col("target_id") == node)).select(
        "edge_idx", "relationship_id", "type", F.when(F.col("source_id") == node, "outgoing").otherwise("incoming").alias("direction"),
        F.when(F.col("source_id") == node, F.col("target_id")).otherwise(F.col("source_id")).alias("neighbor"),
    )
    return df if limit is None else df.orderBy("edge_idx").limit(max(limit, 1))


def context(edges: DataFrame, node: str, depth: int = 1, limit: int | None = None) -> Traversal:
    """Everything within `depth` hops in both directions; the start is not among the nodes."""
    t = traverse(edges, node, depth, "both", limit)
    return Traversal(t.nodes.filter("depth > 0"), t.edges, t.limit_applied)


def endpoints(edges: DataFrame) -> DataFrame:
    """(node): one row for each end of each edge."""
    return edges.select(F.explode(F.array("source_id", "target_id")).alias("node"))


def health(edges: DataFrame, objects: DataFrame) -> DataFrame:
    """One row: edges, distinct ends, ends (with repeats) without an object, objects without an edge, edges by class."""
    ends = endpoints(edges).groupBy("node").agg(F.count("*").alias("n"))
    known = objects.select(F.col("id").alias("object")).filter("object is not null").distinct()
    nodes = ends.join(known, F.col("node") == F.col("object"), "full_outer").agg(
        F.count_if(F.col("node").isNotNull()).alias("total_nodes"), F.coalesce(F.sum(F.when(F.col("object").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("unresolved_endpoints"),
        F.count_if(F.col("node").isNull()).alias("orphan_objects"), F.count_if(F.col("object").isNotNull()).alias("total_objects"), F.lit(1).alias("_one"),
    )
    of = edges.agg(F.count("*").alias("total_edges"), *[F.count_if(F.col("relationship_class") == c).alias(f"{c}_edges") for c in ("support", "semantic", "unknown")], F.lit(1).alias("_one"))
    return of.join(nodes, "_one").drop("_one")  # one row each


def orphans_by_layer(edges: DataFrame, objects: DataFrame) -> DataFrame:
    return objects.join(endpoints(edges).distinct(), F.col("id") == F.col("node"), "left_anti").groupBy("kind").agg(F.count("*").alias("orphans"))


def type_histogram(edges: DataFrame) -> DataFrame:
    return edges.groupBy("relationship_class", "type").agg(F.count("*").alias("edges"))


def node_degrees(edges: DataFrame) -> DataFrame:
    """(node, out_degree, in_degree)."""
    return (
        edges.select(F.explode(F.array(F.struct(F.col("source_id").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("target_id").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("e"))
        .groupBy("e.node").agg(F.sum("e.o").alias("out_degree"), F.sum("e.i").alias("in_degree"))
    )


def unknown_types(edges: DataFrame) -> DataFrame:
    """Edges of an unknown type, with how often each type occurs."""
    return edges.filter("relationship_class = 'unknown'").groupBy("type").agg(F.count("*").alias("edges"))
