from pyspark.sql import functions as F

from chorale.operators import graph
from chorale.sources import tables

XML = """<?xml version='1.0'?>
<graphml><graph>
<node id="1"><data key="type">airport</data><data key="desc">O'Hare</data></node>
<node id="2"><data key="type">x</data><data key="type">country</data></node>
<node id="3"><data key="type">version</data></node>
<node id="4"><data key="desc">none</data></node>
<edge id="7" source="1" target="2"><data key="dist">12</data><data key="id">old</data></edge>
<edge id="8" source="1" target="3"><data key="dist">5</data></edge>
</graph></graphml>
"""


def _graph(spark, tmp_path):
    path = tmp_path / "g.graphml"
    path.write_text(XML)
    nodes, rows = tables.read_graph_nodes(spark, str(path)), tables.read_graph_edges(spark, str(path))
    return graph.typed_vertices(graph.vertices_from_nodes(nodes)), graph.edges_from_rows(rows)


def test_vertices_and_edges_from_xml(spark, tmp_path):
    vertices, edges = _graph(spark, tmp_path)
    assert {r.id: r.properties for r in vertices.collect()} == {
        1: {"type": "airport", "desc": "O'Hare"},
        2: {"type": "country"},
    }
    assert {(r.src, r.dst): r.properties for r in edges.collect()} == {
        (1, 2): {"dist": "12", "id": "7"},
        (1, 3): {"dist": "5", "id": "8"},
    }


def test_triplets_and_dangling(spark, tmp_path):
    vertices, edges = _graph(spark, tmp_path)
    triples = graph.triplets(vertices, edges)
    assert [(r.src, r.dst) for r in triples.collect()] == [(1, 2)]
    loose = graph.dangling_edges(vertices, edges).collect()
    assert [(r.src, r.dst, r.src_missing, r.dst_missing) for r in loose] == [(1, 3, False, True)]


def test_statements(spark, tmp_path):
    vertices, edges = _graph(spark, tmp_path)
    script = graph.triplet_statements(graph.triplets(vertices, edges)).first().value
    assert script == (
        "v1=graph.traversal().V(1).tryNext().orElse(null); if(!v1) v1=graph.addVertex(id, 1"
        ",'desc','O\\'Hare','type','airport');"
        "v2=graph.traversal().V(2).tryNext().orElse(null); if(!v2) v2=graph.addVertex(id, 2,'type','country');"
        "v1.addEdge('edge', v2,'dist','12','id','7');"
    )
    lines = graph.vertex_statements(vertices.unionByName(vertices)).select("value")
    out = str(tmp_path / "statements")
    lines.write.text(out)
    assert spark.read.text(out).where(F.col("value").startswith("v=graph")).count() == 2


def test_a_repeated_id_is_one_vertex(spark):
    rows = [(1, {"type": "airport", "desc": "b"}), (1, {"type": "airport", "desc": "a"}), (2, {"type": "country"})]
    vertices = spark.createDataFrame(rows, "id bigint, properties map<string,string>")
    edges = spark.createDataFrame([(1, 2, {"id": "9"})], "src bigint, dst bigint, properties map<string,string>")
    for given in (vertices, graph.typed_vertices(vertices)):
        triples = graph.triplets(given, edges).collect()
        assert [(r.src_properties["desc"], r.dst) for r in triples] == [("a", 2)]
    assert graph.dangling_edges(vertices, edges).count() == 0
    assert graph.vertex_statements(vertices).count() == 2
