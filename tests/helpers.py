from __future__ import annotations

import random
from collections import defaultdict
from itertools import combinations

from ledgerweb.sources.readers import transactions_from_rows


def tx(spark, pairs, **extra):
    """Transactions from (sender, receiver[, amount[, is_fraud]]) tuples."""
    rows = []
    for p in pairs:
        s, r, *rest = p
        rows.append({"sender": s, "receiver": r, "amount": float(rest[0]) if rest else 1.0,
                     "is_fraud": rest[1] if len(rest) > 1 else 0, **extra})
    return transactions_from_rows(spark, rows)


def by_id(df, *columns):
    return {row["id"]: tuple(row[c] for c in columns) if len(columns) > 1 else row[columns[0]] for row in df.collect()}


def random_pairs(n_nodes, n_rows, seed, hub_share=0.0):
    rnd = random.Random(seed)
    names = [f"n{i}" for i in range(n_nodes)]
    rows = []
    for _ in range(n_rows):
        a = "hub" if rnd.random() < hub_share else rnd.choice(names)
        rows.append((a, rnd.choice(names), round(rnd.uniform(1, 100), 2)))
    return rows


def brute_features(pairs):
    """The seven features by plain definition."""
    edges = defaultdict(lambda: [0, 0.0])
    for s, r, a in pairs:
        edges[s, r][0] += 1
        edges[s, r][1] += a
    nbrs = defaultdict(set)
    f = defaultdict(lambda: [0, 0, 0, 0.0, 0.0, 0, 0])
    for (s, r), (n, a) in edges.items():
        for node in (s, r):
            nbrs[node]
        if s != r:
            nbrs[s].add(r)
            nbrs[r].add(s)
        f[s][0] += 1
        f[r][0] += 1
        f[r][1] += n
        f[s][2] += n
        f[r][3] += a
        f[s][4] += a
    seen = set()
    for node in nbrs:
        f[node][6] = sum(1 for a, b in combinations(nbrs[node], 2) if b in nbrs[a])
        if node in seen:
            continue
        group, todo = {node}, [node]
        while todo:
            for other in nbrs[todo.pop()] - group:
                group.add(other)
                todo.append(other)
        seen |= group
        for member in group:
            f[member][5] = len(group)
    return {k: (v[0], v[1], v[2], round(v[3], 4), round(v[4], 4), v[5], v[6]) for k, v in f.items()}


def brute_cycles(pairs, lengths):
    out = defaultdict(set)
    for s, r, *_ in pairs:
        if s != r:
            out[s].add(r)
    found = set()

    def walk(path):
        for nxt in out[path[-1]]:
            if nxt == path[0] and len(path) in lengths:
                found.add(">".join(path))
            elif nxt > path[0] and nxt not in path and len(path) < max(lengths):
                walk(path + [nxt])

    for start in list(out):
        walk([start])
    return found
