"""The prefix trie against a dictionary of all prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerweb.llm import prefix_trie
from ledgerweb.llm.prefix_trie import numbered, trie, with_openings
from ledgerweb.llm.queries import QUERIES
from tests.llm.conftest import as_rows

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def paths_of(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    return {c: [t for _, t in sorted(v)] for c, v in turns.items()}


def rebuilt(paths, every=20, most=4):
    out = {}
    for c, own in paths.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (abs(c) % every) * (1 if c >= 0 else -1)
        out[c] = paths.get(base, [])[:h] + own[h:]
    return out


def plain(paths):
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    rows, below = [], {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        kids = children[p]
        leaves = sum(below[k][0] for k in kids) if kids else 1
        saved = (len(members[p]) - 1) * words + sum(below[k][1] for k in kids)
        below[p] = leaves, saved
        ends = sorted(c for c in members[p] if len(paths[c]) == len(p))
        rows.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids), leaves, saved,
                     hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(rows, key=repr)


def messy(seed=5):
    """Shared openings, copies, long conversations, ties, repeated rows, nulls and negative ids."""
    rnd = random.Random(seed)
    texts = ["", None, "one", "two words", " a\x0bb\tc ", "x" * 50, "é\u0085è", "a,b", *(" ".join("w" * rnd.randint(1, 5) for _ in range(rnd.randint(1, 9))) for _ in range(12))]
    rows = []
    for c in [*range(-45, 120), 10**12, 10**12 + 1, 2**62]:
        size = rnd.choice([1, 1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 18, 40])
        few = rnd.random() < 0.5
        rows += [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(texts[:3] if few else texts)) for t in range(size)]
    base = [r for r in rows if r[0] == 7]
    long = [(500, t, "user", texts[t % 9]) for t in range(60)]
    rows += [(600 + i, *r[1:]) for i in range(40) for r in base] + long + [(501, *r[1:]) for r in long] + [(502, *r[1:]) for r in long[:33]] + [(503, *r[1:]) for r in long[:32]]
    rows += [(700, None, "user", "null turn"), (700, 0, "user", "b"), (700, 0, "user", "a"), (700, 0, "bot", "a"), (700, 0, "bot", "a"), (700, -3, None, None)]
    rows += [(10**13 + i, 0, "user", "alone") for i in range(1, 9)]
    rows += [(None, 1, "user", "of no conversation"), (None, None, None, None)]
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(messy(), SCHEMA).repartition(5)


def test_plain_trie(frame):
    assert as_rows(trie(numbered(frame)), *COLUMNS) == plain(paths_of(messy()))


def test_rebuilt_trie(frame):
    paths = rebuilt(paths_of(messy()))
    assert any(not p for p in paths.values()) and any(len(p) > 2 * prefix_trie.WIDTH for p in paths.values())
    assert as_rows(trie(with_openings(numbered(frame), 20, 4)), *COLUMNS) == plain(paths)


def test_clashing_names(spark, frame):
    names = [*COLUMNS, "pos", "id", "words", "t0", "w0", "key", "block", "level", "name", "parent", "since", "leaf", "digest", "heads", "_part"]
    clashing = frame.select("*", *[F.lit("own").alias(n) for n in names if n not in frame.columns])
    assert as_rows(trie(numbered(clashing)), *COLUMNS) == plain(paths_of(messy()))


def test_ends_in_pieces(frame, monkeypatch):
    """Ids of one node in many pieces."""
    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 20)
    assert as_rows(trie(numbered(frame)), *COLUMNS) == plain(paths_of(messy()))


def test_one_long_conversation(spark):
    rows = [(1, t, "user", f"turn {t % 7}") for t in range(3000)] + [(2, t, "user", f"turn {t % 7}") for t in range(2990)]
    got = trie(numbered(spark.createDataFrame(rows, SCHEMA).repartition(6)))
    assert as_rows(got, *COLUMNS) == plain(paths_of(rows))


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert trie(numbered(none)).collect() == [] and trie(with_openings(numbered(none), 20, 4)).collect() == []
    only_null = spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)
    assert trie(numbered(only_null)).collect() == []


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_rows(QUERIES["op12_prefix_trie"](spark, sf_dir), *COLUMNS) == plain(rebuilt(paths_of(rows)))
