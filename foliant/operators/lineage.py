"""Closures over typed edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.paths import stored, stored_at


def _paths(edges: DataFrame, start: DataFrame, source: str, target: str, edge: str, kind: str, most: int) -> DataFrame:
    """(path, edge_id, edge_type, first_edge, first_type): the nodes of each path from a start in under ``most`` steps, its
    last edge and its first one.

    Each step joins the last frontier to the edges, so a step reads edges once and never all reached rows. A node that
    is already on its own path isn't entered again, so cycles end. A step needs of a path its nodes alone.
    """
    hop = edges.select(F.col(source).alias("last_"), F.col(target).alias("next_id"), F.col(edge).alias("next_edge"), F.col(kind).alias("next_kind"))
    no_edge, no_kind = F.lit(None).cast(edges.schema[edge].dataType), F.lit(None).cast("string")
    front = start.select(F.array("id").alias("path"), no_edge.alias("edge_id"), no_kind.alias("edge_type"), no_edge.alias("first_edge"), no_kind.alias("first_type"))
    out = front
    for k in range(most - 1):
        firsts = ("next_edge", "next_kind") if k == 0 else ("first_edge", "first_type")
        front = (
            front.withColumn("last_", F.element_at("path", -1))
            .join(hop, "last_")
            .filter(~F.array_contains("path", F.col("next_id")))
            .select(F.concat("path", F.array("next_id")).alias("path"), F.col("next_edge").alias("edge_id"), F.col("next_kind").alias("edge_type"), F.col(firsts[0]).alias("first_edge"), F.col(firsts[1]).alias("first_type"))
        )
        out = out.unionByName(front)
    return out


def _ends(backwards: bool = False) -> list[Column]:
    """start, id, depth, edge_id, edge_type and parent of a path, or of the same path walked backwards."""
    depth = F.size("path") - 1
    first, last = F.get("path", F.lit(0)), F.element_at("path", -1)
    ends = (last, first, "first_edge", "first_type", F.lit(1)) if backwards else (first, last, "edge_id", "edge_type", depth - 1)
    return [ends[0].alias("start"), ends[1].alias("id"), depth.alias("depth"), F.col(ends[2]).alias("edge_id"), F.col(ends[3]).alias("edge_type"), F.get("path", ends[4]).alias("parent")]


def closure(edges: DataFrame, start: DataFrame, source: str = "from_id", target: str = "to_id", edge: str = "edge_id", kind: str = "edge_type", most: int = 10) -> DataFrame:
    """(start, id, depth, edge_id, edge_type, parent) of all that is reached in under ``most`` steps."""
    return _paths(edges, start, source, target, edge, kind, most).select(*_ends())


def both_ways(edges: DataFrame, start: DataFrame, most: int = 10, every: bool = False) -> DataFrame:
    """Descendants and ancestors, marked by ``direction``; equal rows once. Rows of a start are in one partition.

    If ``start`` has ``every`` node of the edges, they are walked once: a path to a node is, backwards, one from it.
    """
    if every:
        way = lambda cols, name: F.struct(*cols, F.lit(name).alias("direction"))
        both = F.array(way(_ends(), "descendant"), way(_ends(True), "ancestor"))
        rows = _paths(edges, start, "from_id", "to_id", "edge_id", "edge_type", most).select(F.explode(both).alias("r_")).select("r_.*")
    else:
        down = closure(edges, start, "from_id", "to_id", most=most).withColumn("direction", F.lit("descendant"))
        rows = down.unionByName(closure(edges, start, "to_id", "from_id", most=most).withColumn("direction", F.lit("ancestor")))
    # dealt out once, by start: neither what makes rows distinct nor what orders a start's rows shuffles them again
    n = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "start").distinct()


def reached(edges: DataFrame, start: DataFrame, source: str = "from_id", target: str = "to_id", most: int | None = None) -> DataFrame:
    """(start, id, depth): all nodes that a path of one step or more leads to, each with its least depth.

    A pair of start and node is entered once, so that many paths to a node cost no more than one; each round's new pairs
    are written, and the rounds end when there are none or after ``most`` steps. A start that lies on a cycle reaches
    itself.
    """
    spark = edges.sparkSession
    hop = stored(edges.select(F.col(source).alias("id"), F.col(target).alias("next_id")).distinct(), "hops")
    front = start.select(F.col("id").alias("start"), "id").distinct()
    paths, depth, schema = [], 0, None
    while most is None or depth < most:
        depth += 1
        new = front.join(hop, "id").select("start", F.col("next_id").alias("id")).distinct()
        if paths:
            new = new.join(spark.read.schema(schema).parquet(*paths), ["start", "id"], "left_anti")
        new, path = stored_at(new.withColumn("depth", F.lit(depth)), "reached")
        schema = new.schema
        if not new.take(1):
            break
        paths.append(path)
        front = new.select("start", "id")
    return spark.read.schema(schema).parquet(*paths) if paths else new


def cyclic(edges: DataFrame, start: DataFrame) -> DataFrame:
    """(start, cyclic): whether a path of any length from a start comes back to it."""
    home = reached(edges, start).filter("start = id").select("start", F.lit(True).alias("cyclic"))
    return start.select(F.col("id").alias("start")).join(home, "start", "left").fillna(False, ["cyclic"])
