"""Queries over the property graph of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.functions import render as rd
from chorale.operators import graph
from chorale.plans import views
from chorale.plans.registry import query
from chorale.plans.views import with_views
from chorale.session import scratch_path
from chorale.sources import tables


def _vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.typed_vertices(views.graph_vertices(spark, sf_dir))


def _as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("properties", rd.property_text(F.col("properties")))


_VERTICES = with_views("SELECT id, node_type, properties FROM vertices", "vertices")
_EDGES = with_views("SELECT src, dst, properties FROM edges", "edges")


@query(_VERTICES)
def graph_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(_vertices(spark, sf_dir))


@query(_EDGES)
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(views.graph_edges(spark, sf_dir))


@query(
    with_views(
        """SELECT e.src, e.dst, e.properties, s.properties AS src_properties, t.properties AS dst_properties
        FROM edges e JOIN vertices s ON e.src = s.id JOIN vertices t ON e.dst = t.id""",
        "vertices",
        "edges",
    )
)
def graph_triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    triples = graph.triplets(_vertices(spark, sf_dir), views.graph_edges(spark, sf_dir))
    return triples.select(
        "src",
        "dst",
        *[rd.property_text(F.col(c)).alias(c) for c in ("properties", "src_properties", "dst_properties")],
    )


@query(
    with_views(
        """SELECT src, dst, properties, src NOT IN (SELECT id FROM vertices) AS src_missing,
                  dst NOT IN (SELECT id FROM vertices) AS dst_missing
        FROM edges WHERE src NOT IN (SELECT id FROM vertices) OR dst NOT IN (SELECT id FROM vertices)""",
        "vertices",
        "edges",
    )
)
def dangling_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(
        graph.dangling_edges(_vertices(spark, sf_dir), views.graph_edges(spark, sf_dir))
    )


def _ensure_sql(name: str, alias: str) -> str:
    return (
        f"'{name}=graph.traversal().V(' || {alias}.id || ').tryNext().orElse(null); "
        f"if(!{name}) {name}=graph.addVertex(id, ' || {alias}.id || {alias}.args || ');'"
    )


@query(
    with_views(
        f"""SELECT e.src, e.dst, {_ensure_sql('v1', 's')} || {_ensure_sql('v2', 't')}
                  || 'v1.addEdge(''edge'', v2' || e.args || ');' AS value
        FROM edges e JOIN vertices s ON e.src = s.id JOIN vertices t ON e.dst = t.id""",
        "vertices",
        "edges",
    )
)
def triplet_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.triplet_statements(
        graph.triplets(_vertices(spark, sf_dir), views.graph_edges(spark, sf_dir))
    )


@query(with_views(f"SELECT id, {_ensure_sql('v', 'w')} AS value FROM vertices w", "vertices"))
def vertex_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.vertex_statements(_vertices(spark, sf_dir))


def _data(properties: str, *skip: str):
    kept = F.filter(F.map_entries(properties), lambda e: ~e["key"].isin(list(skip)))
    return F.transform(
        kept if skip else F.map_entries(properties),
        lambda e: F.struct(e["key"].alias("@key"), e["value"].alias("#VALUE")),
    )


def _write_xml(df: DataFrame, tag: str) -> str:
    """Rows as XML, written by Spark; the folder."""
    path = scratch_path(df.sparkSession, f"graph-{tag}")
    (
        df.write.format("xml")
        .option("rootTag", "graph")
        .option("rowTag", tag)
        .option("attributePrefix", "@")
        .option("valueTag", "#VALUE")
        .save(path)
    )
    return path


def write_nodes(spark: SparkSession, sf_dir: str) -> str:
    nodes = views.graph_vertices(spark, sf_dir).select(
        F.col("id").alias("@id"), _data("properties").alias("data")
    )
    return _write_xml(nodes, "node")


def write_edges(spark: SparkSession, sf_dir: str) -> str:
    edges = views.graph_edges(spark, sf_dir).select(
        F.element_at("properties", "id").cast("bigint").alias("@id"),
        F.col("src").alias("@source"),
        F.col("dst").alias("@target"),
        _data("properties", "id").alias("data"),
    )
    return _write_xml(edges, "edge")


@query(_VERTICES)
def xml_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = tables.read_graph_nodes(spark, write_nodes(spark, sf_dir))
    return _as_text(graph.typed_vertices(graph.vertices_from_nodes(nodes)))


@query(_EDGES)
def xml_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(
        graph.edges_from_rows(tables.read_graph_edges(spark, write_edges(spark, sf_dir)))
    )
