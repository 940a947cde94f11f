import pytest

from ledgerweb.functions.lineage import stored
from ledgerweb.operators import components, features, graph, triangles
from ledgerweb.schema import FEATURES
from ledgerweb.sources.readers import sample_rows
from tests.helpers import brute_features, by_id, random_pairs, tx


def full(df):
    return by_id(features.extract(df), *FEATURES)


def test_sample_rows(spark):
    assert full(sample_rows(spark)) == {
        "C1001": (2, 1, 1, 800.0, 250.0, 5, 0),
        "C1002": (1, 0, 1, 0.0, 12500.0, 2, 0),
        "C1003": (2, 1, 1, 999.99, 800.0, 5, 0),
        "C1004": (1, 0, 1, 0.0, 50000.0, 5, 0),
        "C1005": (1, 0, 1, 0.0, 999.99, 5, 0),
        "M2001": (2, 2, 0, 50250.0, 0.0, 5, 0),
        "M2002": (1, 1, 0, 12500.0, 0.0, 2, 0),
    }


SHAPES = {
    "triangle": ([("a", "b"), ("b", "c"), ("c", "a")], {"a": (2, 3, 1), "b": (2, 3, 1), "c": (2, 3, 1)}),
    "reciprocal pair": ([("a", "b"), ("b", "a")], {"a": (2, 2, 0), "b": (2, 2, 0)}),
    "triangle with a reciprocal edge": (
        [("a", "b"), ("b", "a"), ("b", "c"), ("c", "a")], {"a": (3, 3, 1), "b": (3, 3, 1), "c": (2, 3, 1)}),
    "self-loop only": ([("a", "a"), ("a", "a")], {"a": (2, 1, 0)}),
    "two components": ([("a", "b"), ("c", "d")], {n: (1, 2, 0) for n in "abcd"}),
    "star": ([("hub", f"l{i}") for i in range(20)], {"hub": (20, 21, 0), **{f"l{i}": (1, 21, 0) for i in range(20)}}),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_shapes(spark, shape):
    pairs, expected = SHAPES[shape]
    df = tx(spark, pairs)
    assert by_id(features.extract(df), "degree", "cluster_size", "triangle_count") == expected
    if shape == "star":
        assert [r["id"] for r in graph.hubs(graph.edges(df), 10).collect()] == ["hub"]


def test_self_loop_counts_both_sides(spark):
    assert full(tx(spark, [("a", "a", 3), ("a", "a", 4)])) == {"a": (2, 2, 2, 7.0, 7.0, 1, 0)}


def test_long_path_settles(spark):
    path = [(f"p{i:02d}", f"p{i + 1:02d}") for i in range(1, 64)]
    labels = components.component_labels(graph.edges(tx(spark, path)))
    assert by_id(labels, "component", "cluster_size") == {f"p{i:02d}": ("p01", 64) for i in range(1, 65)}


def test_bound_on_rounds_is_reported(spark):
    path = [(f"p{i:02d}", f"p{i + 1:02d}") for i in range(1, 64)]
    with pytest.raises(components.NotConverged):
        components.contract(graph.index_links(graph.edges(tx(spark, path))).links, max_rounds=1)


def test_parallel_rows_collapse(spark):
    e = graph.edges(tx(spark, [("a", "b", 10), ("a", "b", 5)])).collect()
    assert [tuple(r) for r in e] == [("a", "b", 2, 15.0)]


def test_empty_input_keeps_the_schema(spark):
    result = features.extract(tx(spark, []))
    assert result.columns == ["id", *FEATURES] and result.count() == 0


def test_edges_and_links_are_read_from_files(spark, monkeypatch):
    """Columns that a step doesn't need aren't read, unordered pairs are found once, and the stars are only looked for after a round."""
    names, looked, plain_stars = [], [], components._are_stars
    for module in (graph, features, components):
        monkeypatch.setattr(module, "stored", lambda df, name: names.append(name) or stored(df, name))
    monkeypatch.setattr(components, "_are_stars", lambda links: looked.append(list(names)) or plain_stars(links))
    found = features.extract(tx(spark, [("a", "b"), ("b", "a"), ("b", "c"), ("d", "d")]))
    assert {r["id"]: (r["degree"], r["cluster_size"]) for r in found.collect()} == {"a": (2, 3), "b": (3, 3), "c": (1, 3), "d": (2, 1)}
    assert {"edges", "undirected"} <= set(names) and all("small" in n for n in looked)
    assert "ExistingRDD" not in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("seed,hub", [(1, 0.0), (2, 0.35)])
def test_against_brute_force(spark, seed, hub):
    pairs = random_pairs(40, 160, seed, hub)
    expected = brute_features(pairs)
    assert full(tx(spark, pairs)) == expected
    shuffled = tx(spark, list(reversed(pairs))).repartition(7, "receiver")
    assert full(shuffled) == expected


def test_against_brute_force_with_a_hub(spark):
    pairs = random_pairs(40, 160, 8, 0.4)
    assert full(tx(spark, pairs)) == brute_features(pairs)


@pytest.mark.parametrize("chunk", [1, 3])
def test_triangles_in_chunks(spark, chunk):
    pairs = random_pairs(30, 200, 12, 0.2)
    links = graph.index_links(graph.edges(tx(spark, pairs))).links
    found = {}
    for r in triangles.closing_corners(links, chunk).collect():
        found[r["lo"], r["hi"]] = found.get((r["lo"], r["hi"]), 0) + len(r["corners"])
    assert sum(found.values()) == sum(v[6] for v in brute_features(pairs).values()) // 3


def test_invariants(spark):
    pairs = random_pairs(60, 200, 5)
    df = tx(spark, pairs)
    e = graph.edges(df)
    rows = features.extract(df).collect()
    links = graph.index_links(e).links
    n_triangles = sum(len(r["corners"]) for r in triangles.closing_corners(links).collect())
    assert sum(r["tx_count_in"] for r in rows) == sum(r["tx_count_out"] for r in rows) == len(pairs)
    assert round(sum(r["amount_in"] for r in rows), 2) == round(sum(r["amount_out"] for r in rows), 2)
    assert sum(r["degree"] for r in rows) == 2 * e.count()
    assert sum(r["triangle_count"] for r in rows) == 3 * n_triangles
    assert sum(r["cluster_size"] for r in components.component_sizes(e).collect()) == len(rows)


def test_proxy_mode_equals_degree(spark):
    rows = features.extract(tx(spark, random_pairs(20, 60, 3)), "proxy").collect()
    assert all(r["degree"] == r["cluster_size"] == r["triangle_count"] for r in rows)
    with pytest.raises(ValueError):
        features.extract(tx(spark, [("a", "b")]), "other")


def test_labels(spark):
    df = tx(spark, [("a", "b", 1, 1), ("c", "d", 1, 0), ("d", "a", 1, 0)])
    labels = features.labels(df)
    assert by_id(labels, "label") == {"a": 1, "b": 1, "c": 0, "d": 0}
    some = features.with_labels(features.extract(df, "proxy"), labels.filter("id <> 'c'"))
    assert by_id(some, "label")["c"] == 0


def test_graph_tables(spark):
    e = graph.edges(tx(spark, [("a", "b", 2), ("b", "a", 3), ("a", "b", 1), ("b", "c", 1), ("c", "c", 1)]))
    assert [tuple(r) for r in graph.reciprocal_pairs(e).collect()] == [("a", "b", 2, 1)]
    assert by_id(graph.reciprocal_counts(e), "reciprocal_count") == {"a": 1, "b": 1}
    assert by_id(graph.neighbor_counts(e), "neighbor_count") == {"a": 1, "b": 2, "c": 1}
    assert sorted(tuple(r) for r in graph.undirected(e).collect()) == [("a", "b"), ("b", "c")]
    assert sorted(r["id"] for r in graph.nodes(e).collect()) == ["a", "b", "c"]
    kept = graph.induced(e, graph.nodes(e).filter("id <> 'c'"))
    assert sorted((r["src"], r["dst"]) for r in kept.collect()) == [("a", "b"), ("b", "a")]
    titles = {(r["src"], r["dst"]): (r["value"], r["title"]) for r in graph.viz_edges(e).collect()}
    assert titles["a", "b"] == (2, "Txns: 2, Amt: 3.00")
    assert by_id(graph.viz_nodes(e, 3), "color") == {"a": None, "b": None, "c": None}
    assert by_id(graph.viz_nodes(e, 2), "color") == {"a": None, "b": "red", "c": "red"}


def test_flow_signals(spark):
    f = features.extract(tx(spark, [("a", "b", 100), ("b", "c", 5), ("z", "z", 1)]))
    flags = {r["id"]: r for r in graph.flow_signals(f).collect()}
    assert flags["a"]["only_sends"] and flags["a"]["disproportionate"] and flags["a"]["out_in_ratio"] is None
    assert not flags["b"]["only_sends"] and not flags["b"]["disproportionate"]
    assert flags["z"]["isolated_cluster"] and not flags["a"]["isolated_cluster"]
