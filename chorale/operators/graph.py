"""Property graph as two frames: vertices and edges with property maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.functions import render as rd
from chorale.functions import scores as sc

# The vertex types that are kept.
VERTEX_TYPES = ("airport", "country", "continent")


def _pairs(data: str) -> Column:
    return F.transform(
        F.coalesce(F.col(data), F.array().cast("array<struct<`@key`:string,`#VALUE`:string>>")),
        lambda d: F.struct(d["@key"].alias("key"), d["#VALUE"].alias("value")),
    )


def vertices_from_nodes(nodes: DataFrame) -> DataFrame:
    """GraphML node rows to (id, properties); later keys win."""
    return nodes.select(F.col("@id").alias("id"), sc.last_wins_map(_pairs("data")).alias("properties"))


def edges_from_rows(rows: DataFrame) -> DataFrame:
    """GraphML edge rows to (src, dst, properties); the edge id overrides a key ``id``."""
    own_id = F.array(
        F.struct(F.lit("id").alias("key"), F.col("@id").cast("string").alias("value"))
    )
    return rows.select(
        F.col("@source").alias("src"),
        F.col("@target").alias("dst"),
        sc.last_wins_map(F.concat(_pairs("data"), own_id)).alias("properties"),
    )


def typed_vertices(vertices: DataFrame, kinds: Sequence[str] = VERTEX_TYPES) -> DataFrame:
    """Vertices of a known type, as (id, node_type, properties), one row per id (FIL-12)."""
    kind = F.coalesce(F.try_element_at("properties", F.lit("type")), F.lit(""))
    known = vertices.select("id", kind.alias("node_type"), "properties").where(
        F.col("node_type").isin(list(kinds))
    )
    return once(known)


def once(vertices: DataFrame) -> DataFrame:
    """One row per id: of several the one whose properties, in order of keys, come first."""
    rest = [c for c in vertices.columns if c != "id"]
    first = F.min_by(F.struct(*rest), F.array_sort(F.map_entries("properties"))).alias("_v")
    return vertices.groupBy("id").agg(first).select("id", "_v.*")


def triplets(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with the properties of both ends (JOIN-3).

    Two equi-joins on vertex ids, made unique first; AQE splits the partitions of hub
    vertices. Edges with a missing end are left to :func:`dangling_edges`.
    """
    ends = once(vertices.select("id", "properties"))
    source = ends.select(F.col("id").alias("src"), F.col("properties").alias("src_properties"))
    target = ends.select(F.col("id").alias("dst"), F.col("properties").alias("dst_properties"))
    return edges.join(source, "src").join(target, "dst").select(
        "src", "dst", "properties", "src_properties", "dst_properties"
    )


def dangling_edges(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with an end that is no vertex, and which end it is (JOIN-6)."""
    ids = vertices.select("id").distinct()
    source = ids.select(F.col("id").alias("src"), F.lit(True).alias("_src"))
    target = ids.select(F.col("id").alias("dst"), F.lit(True).alias("_dst"))
    marked = edges.join(source, "src", "left").join(target, "dst", "left")
    return marked.where(F.col("_src").isNull() | F.col("_dst").isNull()).select(
        "src",
        "dst",
        "properties",
        F.col("_src").isNull().alias("src_missing"),
        F.col("_dst").isNull().alias("dst_missing"),
    )


def _ensure_vertex(name: str, vertex: Column, properties: Column) -> Column:
    # Fixed value: statement format of the graph store's script language.
    return F.concat(
        F.lit(f"{name}=graph.traversal().V("), vertex.cast("string"),
        F.lit(f").tryNext().orElse(null); if(!{name}) {name}=graph.addVertex(id, "),
        vertex.cast("string"), rd.property_arguments(properties), F.lit(");"),
    )


def vertex_statements(vertices: DataFrame) -> DataFrame:
    """One create-if-absent statement per vertex (GRF-5)."""
    return once(vertices).select("id", _ensure_vertex("v", F.col("id"), F.col("properties")).alias("value"))


def triplet_statements(triples: DataFrame) -> DataFrame:
    """One script per triplet: both ends if absent, then the edge (GRF-4)."""
    edge = F.concat(
        F.lit("v1.addEdge('edge', v2"), rd.property_arguments(F.col("properties")), F.lit(");")
    )
    return triples.select(
        "src",
        "dst",
        F.concat(
            _ensure_vertex("v1", F.col("src"), F.col("src_properties")),
            _ensure_vertex("v2", F.col("dst"), F.col("dst_properties")),
            edge,
        ).alias("value"),
    )
