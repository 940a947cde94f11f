"""Strong components, long and timed rings, core numbers, peeling, risk walk, communities: against plain definitions."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from ledgerweb.functions.lineage import stored
from ledgerweb.operators import augment, cores, graph, influence, rings, strong
from ledgerweb.operators.components import NotConverged
from tests.helpers import brute_cycles, by_id, random_pairs, tx


def edges(spark, pairs):
    return graph.edges(tx(spark, pairs))


def neighbours(pairs):
    out = defaultdict(set)
    for a, b, *_ in pairs:
        out[a], out[b]
        if a != b:
            out[a].add(b)
            out[b].add(a)
    return out


def ahead(pairs):
    out = defaultdict(set)
    for a, b, *_ in pairs:
        out[a].add(b), out[b]
    reach = {}
    for start in out:
        seen, queue = {start}, [start]
        while queue:
            for other in out[queue.pop()] - seen:
                seen.add(other)
                queue.append(other)
        reach[start] = seen
    return reach


def ring(names):
    return list(zip(names, names[1:] + names[:1]))


GRAPHS = {
    "one ring": ring([f"r{i}" for i in range(12)]),
    "rings in a chain": ring(list("abc")) + ring(list("def")) + [("c", "d"), ("f", "g"), ("g", "h"), ("h", "h")] + ring(list("xyz")) + [("z", "a")],
    "rings that share an account": ring(["m", "a", "b"]) + ring(["m", "c", "d", "e"]) + [("e", "out")],
    "path": [(f"p{i:02d}", f"p{i + 1:02d}") for i in range(30)],
    "loops alone": [("a", "a"), ("b", "b")],
    "sparse": random_pairs(60, 70, 1),
    "dense": random_pairs(25, 120, 2),
    "hub": random_pairs(60, 200, 3, hub_share=0.34),
    "two ways": [("a", "b"), ("b", "a"), ("b", "c")],
}

# All of them side by side, so that one run takes in every shape.
ALL = [(f"{name}/{a}", f"{name}/{b}") for name, pairs in GRAPHS.items() for a, b, *_ in pairs]


def test_strong_components(spark):
    pairs = ALL
    reach = ahead(pairs)
    want = {a: sorted(b for b in reach[a] if a in reach[b]) for a in reach}
    got = by_id(strong.strong_components(edges(spark, pairs)), "component", "component_size")
    assert got == {a: (own[0], len(own)) for a, own in want.items()}


def test_bounds_on_rounds_are_reported(spark):
    with pytest.raises(NotConverged):
        strong.strong_index(edges(spark, GRAPHS["one ring"]), max_rounds=2)
    with pytest.raises(NotConverged):
        cores.core_numbers(edges(spark, GRAPHS["path"]), max_rounds=2)
    with pytest.raises(NotConverged):
        influence.risk_walk(edges(spark, GRAPHS["dense"]), spark.createDataFrame([("n1",)], "id string"), max_rounds=2)


def several(*graphs):
    return [(f"{i}/{a}", f"{i}/{b}") for i, pairs in enumerate(graphs) for a, b, *_ in pairs]


@pytest.mark.parametrize("pairs,lengths", [
    (several(random_pairs(30, 55, 4), random_pairs(14, 28, 6), ring(list("abcdefghij")), ring(list("abcdef")), GRAPHS["path"], GRAPHS["loops alone"]), (3, 4, 5, 6, 7, 8, 9, 10)),
    (random_pairs(12, 30, 5), (6, 7)), (random_pairs(30, 60, 7, hub_share=0.3), (9,)), (GRAPHS["path"], (6,))])
def test_long_cycles(spark, pairs, lengths):
    found = rings.long_cycles(edges(spark, pairs), lengths).collect()
    assert sorted(r["ring"] for r in found) == sorted(brute_cycles(pairs, lengths))
    assert all(r["length"] == len(r["members"]) == r["ring"].count(">") + 1 for r in found)


def test_rings_by_account(spark):
    pairs = random_pairs(20, 45, 8)
    want = defaultdict(int)
    for name in brute_cycles(pairs, (4, 6)):
        for member in name.split(">"):
            want[member, name.count(">") + 1] += 1
    got = rings.by_account(rings.long_cycles(edges(spark, pairs), (4, 6))).collect()
    assert {(r["id"], r["length"]): r["rings"] for r in got} == want
    with pytest.raises(ValueError):
        rings.long_cycles(edges(spark, pairs), (2, 6))


def test_unbroken_drawn_rings_are_found(spark):
    """The reference's ring sizes: every drawn ring that no rewiring broke is found by the search."""
    base = tx(spark, random_pairs(400, 500, 9))
    drawn = augment.ring_rows(base, n_rings=40, size=(5, 10), rewire=0.05, noise=(2, 3)).persist()
    e = graph.edges(drawn.select("sender", "receiver", "amount"))
    found = rings.long_cycles(e, (5, 6, 7, 8, 9, 10)).persist()
    searched = {r["ring_size"]: r for r in rings.searched_recall(drawn, found).collect()}
    looked_up = {r["ring_size"]: r for r in rings.ring_recall(drawn, e).collect()}
    assert searched == looked_up and sum(r["rings"] for r in searched.values()) == 40
    assert all(r["found"] >= r["whole"] for r in searched.values()) and sum(r["whole"] for r in searched.values()) > 15


START = datetime(2024, 1, 1)


def timed(spark, rows):
    return spark.createDataFrame(
        [(i, a, b, float(amount), None if at is None else START + timedelta(seconds=at)) for i, (a, b, amount, at) in enumerate(rows)],
        "seq long, sender string, receiver string, amount double, ts timestamp")


def brute_timed(rows, lengths, gap):
    found = []

    def walk(path):
        a, b, amount, at = rows[path[-1]]
        members = [rows[p][0] for p in path]
        for i, (s, r, _, when) in enumerate(rows):
            if s == b and s != r and when is not None and 0 < when - at <= gap:
                if r == members[0] and len(path) + 1 in lengths:
                    found.append((len(path) + 1, ">".join([*members, s]), [*path, i], round(sum(rows[p][2] for p in [*path, i]), 4)))
                elif r not in members and r != s and len(path) + 1 < max(lengths):
                    walk([*path, i])

    for i, (s, r, _, when) in enumerate(rows):
        if s != r and when is not None:
            walk([i])
    return sorted(found, key=repr)


@pytest.mark.parametrize("seed,hub,gap,lengths", [(1, 0, 100, (3, 4, 5)), (2, 0.4, 60, (2, 3, 4)), (5, 0, 3600, (5,))])
def test_timed_rings(spark, seed, hub, gap, lengths):
    rnd = random.Random(seed)
    names = [f"n{i}" for i in range(7)]
    rows = [("hub" if rnd.random() < hub else rnd.choice(names), rnd.choice(names + ["hub"] * bool(hub)), rnd.randint(1, 900) / 8, rnd.randint(0, 900)) for _ in range(70)]
    rows += [rows[0], ("n1", "n2", 1, None), ("n1", "n1", 1, 5), (None, "n1", 1, 6), ("n1", None, 1, 6)]
    found = rings.timed_rings(timed(spark, rows), lengths, gap) if gap else rings.timed_rings(timed(spark, rows), lengths, 1)
    got = sorted(((r["length"], r["ring"], r["payments"], r["amount"]) for r in found.collect()), key=repr)
    assert got == brute_timed([r if None not in r[:2] else ("x", "x", 1, 1) for r in rows], lengths, gap or 1)
    for r in found.collect():
        assert START + timedelta(seconds=rows[r["payments"][0]][3]) == r["first_ts"] and START + timedelta(seconds=rows[r["payments"][-1]][3]) == r["last_ts"]


def test_timed_ring_borders(spark):
    """Exactly the gap counts, a moment more doesn't, and equal times don't follow each other."""
    rows = [("a", "b", 1, 0), ("b", "c", 1, 3600), ("c", "a", 1, 7200), ("c", "a", 1, 7201), ("x", "y", 1, 5), ("y", "z", 1, 5), ("z", "x", 1, 6)]
    assert [r["payments"] for r in rings.timed_rings(timed(spark, rows)).collect()] == [[0, 1, 2]]


def test_timed_rings_walk_only_what_can_close(spark, monkeypatch):
    """Payers nobody pays and payees who pay nobody take no part in steps and paths."""
    kept = {}

    def spy(df, name):
        kept.setdefault(name, []).append(out := stored(df, name))
        return out

    monkeypatch.setattr(rings, "stored", spy)
    rows = [("a", "b", 1, 0), ("b", "c", 1, 10), ("c", "a", 1, 20), *((f"x{i}", "a", 1, i) for i in range(30)), *(("b", f"y{i}", 1, i) for i in range(30))]
    assert [r["payments"] for r in rings.timed_rings(timed(spark, rows)).collect()] == [[0, 1, 2]]
    assert kept["payments"][0].count() == 3 and kept["steps"][0].count() == 2


def brute_cores(pairs):
    left, core, k = {a: set(b) for a, b in neighbours(pairs).items()}, {}, 0
    while left:
        a = min(left, key=lambda x: (len(left[x]), x))
        k = max(k, len(left[a]))
        core[a] = k
        for b in left.pop(a):
            left[b].discard(a)
    return core


def test_core_numbers(spark):
    clique = [(f"q{i}", f"q{j}") for i in range(9) for j in range(i)]
    assert by_id(cores.core_numbers(edges(spark, ALL + clique)), "core") == brute_cores(ALL + clique)


def brute_peeling(pairs, slack):
    alive, gone, rounds, turn = {a for a, b in neighbours(pairs).items() if b}, {}, [], 0
    all_of = neighbours(pairs)
    while alive:
        degree = {a: len(all_of[a] & alive) for a in alive}
        links = sum(degree.values()) // 2
        rounds.append((turn, len(alive), links))
        out = {a for a in alive if degree[a] <= 2 * (1 + slack) * links / len(alive)}
        gone |= dict.fromkeys(out, turn)
        alive -= out
        turn += 1
    return gone, rounds


@pytest.mark.parametrize("name", ["sparse", "hub", "loops alone"])
def test_peeling(spark, name):
    clique = [(f"q{i}", f"q{j}") for i in range(9) for j in range(i)]
    pairs = GRAPHS[name] + (clique if name != "loops alone" else [])
    gone, rounds = brute_peeling(pairs, 0.1)
    table, found = cores.peeled(edges(spark, pairs), 0.1)
    assert by_id(table, "round") == gone
    assert [(r["round"], r["accounts"], r["links"]) for r in found.orderBy("round").collect()] == rounds
    dense = by_id(cores.dense_subgraph(edges(spark, pairs)), "density")
    if name == "loops alone":
        assert dense == {}
    else:
        best = max(rounds, key=lambda r: (r[2] / r[1], -r[0]))
        assert dense == {a: best[2] / best[1] for a, turn in gone.items() if turn >= best[0]}
        assert 2 * (1 + 0.1) * best[2] / best[1] >= max(36 / 9, max(n for _, n in brute_cores(pairs).items()) / 2)


def brute_walk(pairs, risky, damping, rounds=400):
    weight = defaultdict(float)
    names = sorted({n for a, b, *_ in pairs for n in (a, b)})
    for a, b, *_ in pairs:
        weight[a, b] += 1
    paid = defaultdict(float)
    for (a, _), w in weight.items():
        paid[a] += w
    seed = {n: (1 / len(risky & set(names)) if n in risky else 0.0) for n in names}
    now = dict(seed)
    for _ in range(rounds):
        come = defaultdict(float)
        for (a, b), w in weight.items():
            come[b] += now[a] * w / paid[a]
        lost = 1 - damping * sum(now[n] for n in names if paid[n])
        now = {n: seed[n] * lost + damping * come[n] for n in names}
    return now


@pytest.mark.parametrize("name,damping", [("hub", 0.6), ("rings in a chain", 0.4)])
def test_risk_walk(spark, name, damping):
    pairs = GRAPHS[name]
    names = sorted({n for a, b, *_ in pairs for n in (a, b)})
    risky = {names[0], names[len(names) // 2], "not in the graph"}
    frame = spark.createDataFrame([(n,) for n in [*risky, names[0], None]], "id string")
    got = by_id(influence.risk_walk(edges(spark, pairs), frame, damping=damping, tolerance=1e-6), "risk")
    want = brute_walk(pairs, risky, damping)
    assert got.keys() == want.keys() and all(abs(got[n] - want[n]) < 1e-5 for n in want) and abs(sum(got.values()) - 1) < 1e-9
    none = influence.risk_walk(edges(spark, pairs), frame.filter("id = 'not in the graph'"))
    assert set(by_id(none, "risk").values()) == {0.0}


def brute_communities(pairs, rounds):
    weight = defaultdict(int)
    names = {n for a, b, *_ in pairs for n in (a, b)}
    for a, b, *_ in pairs:
        if a != b:
            weight[a, b] += 1
            weight[b, a] += 1
    label = {n: n for n in names}
    for _ in range(rounds):
        heard = defaultdict(lambda: defaultdict(int))
        for (a, b), w in weight.items():
            heard[a][label[b]] += w
        for a in names:
            own = [w for (x, _), w in weight.items() if x == a]
            if own:
                heard[a][label[a]] += max(own)
        label = {a: min(heard[a], key=lambda x: (-heard[a][x], x)) if heard[a] else label[a] for a in names}
    return label


def test_communities_repeat_only_accounts_with_several_neighbours(spark, monkeypatch):
    """Accounts with one neighbour are followed through it, numbers above and below it alike; pairs on their own stay in the rounds."""
    rnd = random.Random(5)
    pairs = [(f"{rnd.choice('akz')}{i}", f"m{rnd.randrange(12)}") for i in range(200) for _ in range(rnd.randint(1, 3))]
    pairs += [(a, b) for a, b, *_ in random_pairs(8, 20, 30)] + [("m1", "m2"), ("m2", "m3"), ("m3", "m1"), ("p", "q"), ("q", "p"), ("s", "r"), ("alone", "alone")]
    several = {n for n, o in neighbours(pairs).items() if len(o) > 1}
    rows = []

    def counted(df, name):
        df = stored(df, name)
        if name == "labels":
            rows.append(df.count())
        return df

    monkeypatch.setattr(influence, "stored", counted)
    for rounds in (1, 2, 5):
        assert by_id(influence.communities(edges(spark, pairs), rounds=rounds), "community") == brute_communities(pairs, rounds)
    assert set(rows) == {len(several) + 4}


def test_risk_walk_repeats_only_payments_of_accounts_that_are_paid(spark, monkeypatch):
    """Payers that nobody pays, and payees that pay nobody, are followed by two numbers a round; risks are as by the plain walk."""
    pairs = [(f"o{i}", f"c{i % 40}") for i in range(400)] + [("a", "b"), ("b", "a"), ("b", "c1"), ("o1", "a"), ("a", "a")]
    risky = ["o1", "o2", "c2", "c5", "b", "gone"]
    rows = {}

    def counted(df, name):
        df = stored(df, name)
        if name in ("risk", "arcs"):
            rows.setdefault(name, []).append(df.count())
        return df

    monkeypatch.setattr(influence, "stored", counted)
    found = influence.risk_walk(edges(spark, pairs), spark.createDataFrame([(r,) for r in risky], "id string"), tolerance=1e-6)
    got = by_id(found, "risk")
    wanted = brute_walk(pairs, set(risky), 0.85)
    assert set(got) == set(wanted) and all(abs(got[i] - wanted[i]) < 1e-5 for i in wanted)
    assert max(rows["risk"]) == 3 and rows["arcs"] == [4]


@pytest.mark.parametrize("name,rounds", [("all", 10), ("dense", 1), ("loops alone", 2)])
def test_communities(spark, name, rounds):
    pairs = ALL if name == "all" else GRAPHS[name]
    found = influence.communities(edges(spark, pairs), rounds=rounds).persist()
    want = brute_communities(pairs, rounds)
    assert by_id(found, "community") == want
    ends, inner = defaultdict(float), 0
    for a, b, *_ in pairs:
        if a != b:
            ends[want[a]] += 1
            ends[want[b]] += 1
            inner += 2 * (want[a] == want[b])
    row = influence.modularity(edges(spark, pairs), found).first()
    assert row["communities"] == len(set(want.values()))
    total = sum(ends.values())
    assert row["modularity"] is None if not total else abs(row["modularity"] - (inner / total - sum(e * e for e in ends.values()) / total ** 2)) < 1e-12


def test_no_payments(spark):
    none = edges(spark, [("a", "b")]).filter("false")
    assert strong.strong_components(none).count() == cores.core_numbers(none).count() == cores.dense_subgraph(none).count() == 0
    assert rings.long_cycles(none).count() == influence.communities(none).count() == 0
    assert influence.risk_walk(none, spark.createDataFrame([("a",)], "id string")).count() == 0
