import datetime as dt
import itertools
import random

import pytest

from ledgerweb.functions.lineage import scratch_path
from ledgerweb.operators import graph, scoring, triangles
from ledgerweb.plans import queries
from ledgerweb.plans.queries import STREAM
from ledgerweb.schema import FEATURES, MODEL_FEATURES
from ledgerweb.streaming import live, replay, state
from pyspark.sql import functions as F
from tests.helpers import by_id, random_pairs, tx

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, s, r, a, START + dt.timedelta(minutes=7 * i), "P2P", 0)
            for i, (s, r, a) in enumerate(random_pairs(25, 90, 6))]
    return spark.createDataFrame(data, STREAM)


def play(spark, rows, start, parts=3):
    root = scratch_path(spark, "test")
    landing, out, state = f"{root}/landing", f"{root}/out", f"{root}/state"
    replay.drive(replay.ranked_slices(rows, [F.col("seq")], parts), landing,
                 lambda: start(replay.open_stream(spark, landing, STREAM), out, state))
    return out


def test_stream_equals_batch(spark, rows):
    out = play(spark, rows, lambda s, o, c: live.run(s, o, c, total_rows=90))
    batch = scoring.score_batch(rows)
    streamed = live.latest(spark, out, "scores").select(*batch.columns)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert streamed.count() == batch.count()
    edges = live.latest(spark, out, "edges").select("src", "dst", "transaction_count", "total_amount")
    assert sorted(map(tuple, edges.collect())) == sorted(map(tuple, graph.edges(rows).collect()))
    progress = live.history(spark, out, "progress").orderBy("batch_id").collect()
    assert [(r["batch_id"], r["rows_done"], r["rows_total"]) for r in progress] == [(0, 30, 90), (1, 60, 90), (2, 90, 90)]
    assert progress[-1]["pct"] == 1.0
    top = live.history(spark, out, "top").groupBy("batch_id").count().collect()
    assert all(r["count"] == 8 for r in top)


@pytest.mark.parametrize("parts,compact_every,rows_per_bucket", [(1, 10, 1000), (5, 2, 7)])
def test_every_batch_equals_a_batch_over_the_rows_so_far(spark, rows, parts, compact_every, rows_per_bucket):
    states, root = [], scratch_path(spark, "test")

    def start(stream):
        return live.run(stream, f"{root}/out", f"{root}/state", compact_every=compact_every, rows_per_bucket=rows_per_bucket)

    slices = [p.cache() for p in replay.ranked_slices(rows, [F.col("seq")], parts)]
    so_far, before = None, {}
    for part in slices:
        replay.drive([part], f"{root}/landing", lambda: start(replay.open_stream(spark, f"{root}/landing", STREAM)))
        so_far = part if so_far is None else so_far.unionByName(part)
        batch = scoring.score_batch(so_far)
        expected = {r["id"]: tuple(r) for r in batch.collect()}
        assert {r["id"]: tuple(r) for r in live.latest(spark, f"{root}/out", "scores").select(*batch.columns).collect()} == expected
        n = len(states)
        states.append({r["id"] for r in live.history(spark, f"{root}/out", "scores").filter(F.col("batch_id") == n).collect()})
        # Nothing that changed is missing from the batch's output, and nothing it has no part in is there.
        changed = {i for i, v in expected.items() if before.get(i) != v}
        ends = {x for r in part.collect() for x in (r["sender"], r["receiver"])}
        assert ends <= states[-1] and (changed <= states[-1])
        assert states[-1] <= changed | ends | {i for i in expected if i in before and before[i][1:6] == expected[i][1:6]}
        before = expected
    if parts > 4:  # the last whole tables are dealt out
        assert state.buckets_at(spark, f"{root}/out", "scores") > 1 and state.buckets_at(spark, f"{root}/out", "ends") > 4


def test_what_a_small_batch_reads_does_not_grow(spark):
    """Ten times the state in ten times the buckets: the rows read for a few accounts stay level, and what they say is right."""
    read = {}
    for size in (300, 3000):
        out = scratch_path(spark, "grown")
        pairs = [(f"n{i}", f"n{(i * 7 + 1) % size}", 1.0) for i in range(size)] + [("hub", f"n{i}", 2.0) for i in range(0, size, 3)]
        live.score_changes(spark, graph.edges(tx(spark, pairs)), 0, out, scoring.rule_score, None, scoring.DEFAULT_SCORE, 1, 40)
        ids = spark.createDataFrame([("n5",), ("n6",), ("new",)], "id string")
        touched = state.touched_buckets(ids)
        read[size] = {name: state.read(spark, out, name, None, touched).count() for name in ("ends", "scores")}
        whole = state.table(spark, out, "ends").count()
        assert whole == 2 * len(pairs) and read[size]["scores"] <= 3 * 80
        found = state.lookup(spark, out, "ends", ids)
        assert sorted(r["id"] for r in found.collect()) == sorted(x for p in pairs for x in p[:2] if x in ("n5", "n6"))
        more = tx(spark, [("new", "n5", 3.0)])
        live.score_changes(spark, graph.edges(more), 1, out, scoring.rule_score, None, scoring.DEFAULT_SCORE, 10, 40)
        batch = scoring.score_batch(tx(spark, [*pairs, ("new", "n5", 3.0)]))
        assert sorted(map(tuple, live.latest(spark, out, "scores").select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))
    # The hub's bucket is not among those asked for.
    assert read[3000]["scores"] <= 2 * read[300]["scores"] and read[3000]["ends"] <= 2 * read[300]["ends"]


def test_bucket_counts():
    assert [state.fitting(n, 10) for n in (0, 1, 10, 11, 20, 21, 40, 41, 10**9)] == [1, 1, 1, 2, 2, 4, 4, 8, state.MOST_BUCKETS]


def test_untouched_components_are_left_alone(spark, rows):
    data = [(0, "a", "b"), (1, "c", "d"), (2, "e", "e"), (3, "a", "x")]
    made = spark.createDataFrame([(i, s, r, 1.0, START, "P2P", 0) for i, s, r in data], STREAM)
    out = play(spark, made, lambda s, o, c: live.run(s, o, c), 4)
    by_batch = {}
    for r in live.history(spark, out, "scores").collect():
        by_batch.setdefault(r["batch_id"], set()).add(r["id"])
    assert by_batch == {0: {"a", "b"}, 1: {"c", "d"}, 2: {"e"}, 3: {"a", "b", "x"}}


def test_old_versions_go(spark, rows):
    root = play(spark, rows, lambda s, o, c: live.run(s, o, c, compact_every=2), 7)
    assert state.versions(spark, f"{root}/whole_ends") == [3, 5]
    assert all(state.versions(spark, f"{root}/{name}") == [4, 5, 6] for name in ("ends", "scores", "members", "summary"))
    assert live.latest(spark, root, "edges").agg(F.sum("transaction_count")).first()[0] == 90


def test_a_repeated_batch_replaces_its_output(spark, rows):
    out = play(spark, rows, lambda s, o, c: live.run(s, o, c), 3)
    expected = sorted(map(tuple, live.latest(spark, out, "scores").collect()))
    changed = spark.read.parquet(f"{out}/edges/batch_id=2")
    again = spark.createDataFrame(changed.collect(), changed.schema)
    live.score_changes(spark, again, 2, out, scoring.rule_score, 90, scoring.DEFAULT_SCORE)
    assert sorted(map(tuple, live.latest(spark, out, "scores").collect())) == expected


def test_velocity_stream(spark, rows):
    out = play(spark, rows, lambda s, o, c: live.to_versions(live.live_velocity(s), o, c))
    current = live.current_versions(spark, out, ["sender", "window_start", "window_end"])
    assert current.agg(F.sum("tx_count")).first()[0] == 90


def test_late_rows_are_dropped(spark, rows):
    late = rows.withColumn("seq", F.lit(89) - F.col("seq"))
    out = play(spark, late, lambda s, o, c: live.to_versions(live.live_velocity(s), o, c))
    current = live.current_versions(spark, out, ["sender", "window_start", "window_end"])
    assert 30 <= current.agg(F.sum("tx_count")).first()[0] < 90


def test_dedup_stream(spark, rows):
    out = play(spark, rows, lambda s, o, c: live.to_table(live.live_dedup(s.unionByName(s), ["seq"]), o, c))
    assert sorted(r["seq"] for r in spark.read.parquet(out).collect()) == list(range(90))


def test_sessions_stream(spark, rows):
    out = play(spark, rows, lambda s, o, c: live.to_table(live.live_sessions(s), o, c))
    closed = spark.read.parquet(out)
    assert 0 < closed.agg(F.sum("tx_count")).first()[0] <= 90


def test_files_per_trigger(spark, rows):
    root = scratch_path(spark, "files")
    rows.repartition(4).write.parquet(f"{root}/landing")
    query = live.to_versions(graph.edges(replay.open_stream(spark, f"{root}/landing", STREAM, max_files=1)),
                             f"{root}/out", f"{root}/state")
    query.awaitTermination()
    written = spark.read.parquet(f"{root}/out")
    assert written.select("batch_id").distinct().count() == 4
    current = live.current_versions(spark, f"{root}/out", ["src", "dst"])
    assert current.agg(F.sum("transaction_count")).first()[0] == 90


@pytest.mark.parametrize("first,gap", [(0, 1), (1, 1), (-5, 10)])
def test_slices_keep_every_row(spark, first, gap):
    df = spark.range(90).select((F.col("id") * gap + first).alias("seq"))
    parts = [p.count() for p in replay.ranked_slices(df, [F.col("seq")], 4)]
    assert sum(parts) == 90 and max(parts) - min(parts) <= 1


def test_a_row_without_slice_is_an_error(spark):
    with pytest.raises(ValueError):
        list(replay.slices(spark.range(10), F.col("id").cast("int"), range(9)))
    with pytest.raises(ValueError):
        list(replay.slices(spark.range(10), F.lit(None).cast("int"), range(9)))


def test_paths_to_new_triangles_are_spread(spark):
    """A few links make many paths: they are dealt to all tasks of a shuffle, whatever their bytes."""
    pairs = [(f"n{a}", f"n{b}") for a in range(12) for b in range(a)]
    now = live._both_ends(graph.edges(tx(spark, pairs)))
    links = graph.undirected(graph.edges(tx(spark, pairs[:5])))
    found = live._new_triangles(now, links)
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    whole = [set(c) for c in itertools.combinations(range(12), 3)]
    fresh = [c for c in whole if any({int(a[1:]), int(b[1:])} <= c for a, b in pairs[:5])]
    assert by_id(found, "more") == {f"n{i}": n for i in range(12) if (n := sum(i in c for c in fresh))}


@pytest.mark.parametrize("chunk", [4096, 2])
def test_triangles_with_a_fresh_link(spark, chunk):
    """Every triangle with one, two or three fresh links once, whichever they are, and none of old links alone."""
    rnd = random.Random(5)
    pairs = sorted({(a, b) if a < b else (b, a) for a, b in ((rnd.randrange(14), rnd.randrange(14)) for _ in range(70)) if a != b})
    marks = {p: rnd.random() < 0.5 for p in pairs}
    links = spark.createDataFrame([(*p, f) for p, f in marks.items()], "lo bigint, hi bigint, fresh boolean")
    found = [(r["lo"], r["hi"], c) for r in triangles.fresh_corners(links, chunk).collect() for c in r["corners"]]
    whole = [c for c in itertools.combinations(range(14), 3) if all(p in marks for p in itertools.combinations(c, 2))]
    fresh = [c for c in whole if any(marks[p] for p in itertools.combinations(c, 2))]
    assert sorted(found) == fresh and {sum(marks[p] for p in itertools.combinations(c, 2)) for c in whole} == {0, 1, 2, 3}


def test_neighbours_of_new_links_travel_as_lists(spark):
    """No row for each path to a new triangle: 40 accounts that pay each other have 780 links, but some 30,000 paths."""
    pairs = [(f"n{a}", f"n{b}") for a in range(40) for b in range(a)]
    e = graph.edges(tx(spark, pairs))
    found = live._new_triangles(live._both_ends(e), graph.undirected(e))
    metrics = _rows_shuffled(found)
    assert by_id(found, "more") == {f"n{i}": 39 * 38 // 2 for i in range(40)}
    assert max(metrics) <= 40 * 39


def _rows_shuffled(df):
    """Rows that each shuffle of the plan wrote, once it has run."""
    df.collect()
    plan, counts = [df._jdf.queryExecution().executedPlan()], []
    while plan:
        node = plan.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            plan.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            plan.append(node.plan())
        if name == "ShuffleExchangeExec":
            counts.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        plan += [children.apply(i) for i in range(children.size())]
    return counts


def test_the_training_table_is_read_by_column(spark, sf_dir, monkeypatch):
    """What the forest is trained on is Parquet, of which it reads its own columns: not rows that are stored whole, twice over."""
    plans = []
    train = queries.model.train

    def looked_at(df, *args, **options):
        plans.append(df.select(*MODEL_FEATURES)._jdf.queryExecution().executedPlan().toString())
        return train(df, *args, **options)

    monkeypatch.setattr(queries.model, "train", looked_at)
    monkeypatch.setattr(queries, "replay_transfers", lambda *args, **options: None)
    monkeypatch.setattr(queries.live, "latest", lambda spark, out, table: queries.scoring.band(
        queries.features.extract(queries.views.transfers(spark, sf_dir)).withColumn("fraud_score", F.lit(0.5))))
    assert set(queries.QUERIES["stream_model_scores"](spark, sf_dir).columns) == {"id", *FEATURES, "as_in_batch", "band_as_in_batch"}
    assert len(plans) == 1 and "FileScan parquet [degree" in plans[0] and "amount_in" not in plans[0]
