"""The url filter, top-k search, components, and the pipeline."""

import math
import random
from collections import defaultdict
from urllib.parse import urljoin

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerweb.llm import connected, suffix_dedup, uniform_topk, url_filter
from ledgerweb.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import DOCUMENTS, as_rows, messy_rows, prose

# --- url filter --------------------------------------------------------------------------------

PAGES = [
    (0, "https://a.example.org/es/x#frag", None),
    (1, "HTTP://WWW.EXAMPLE.ORG/en/1?q=1", ""),
    (2, "http://example.org/de/1", "<p>"),
    (3, "http://example.org", "no path"),
    (4, "http://notexample.org/es/", ""),
    (5, "http://b.net/1", '<link rel="canonical" href="http://c.net/2">'),
    (6, "http://c.net/2", "<META http-equiv='Refresh' content='0; url=https://x.com/de/9'>"),
    (7, "http://d.net/3#top", '<link href=/4 rel=canonical>'),
    (8, "http://d.net/4", '<link rel="canonical" href="//example.org/es/5">'),
    (9, "http://org.com/fr/1", '<link rel="canonical" href="http://c.net/2">'),
    (10, None, '<link rel="canonical" href="http://c.net/2">'),
    (11, "no scheme", '<link rel="canonical" href="http://c.net/2">'),
    (12, "http://c.net/2#other", None),
    (None, "http://e.net/a/b?x", '<link rel="canonical" href="c?y">'),
    (14, "http://e.net/a/c?y", '<link rel="canonical" href="">'),
    (14, "http://e.net/a/c?y", '<link rel="stylesheet" href="http://c.net/2" title="canonical">'),
]
EXPECTED = {
    0: ("a.example.org", "/es/x", "example.org/es/", "block"), 1: ("www.example.org", "/en/1", "example.org/en/1", "block"),
    2: ("example.org", "/de/1", "org/", "allow"), 3: ("example.org", "", None, "allow"), 4: ("notexample.org", "/es/", "org/", "allow"),
    5: ("b.net", "/1", None, "block"), 6: ("c.net", "/2", None, "block"), 7: ("d.net", "/3", None, "block"),
    8: ("d.net", "/4", None, "block"), 9: ("org.com", "/fr/1", "com/fr/", "allow"), 10: ("", "", None, "allow"),
    11: ("", "", None, "allow"), 12: ("c.net", "/2", None, "block"), None: ("e.net", "/a/b", None, "allow"),
    14: ("e.net", "/a/c", None, "allow"),
}


def test_urls(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("rule", F.lit("x")).withColumn("node", F.lit(1))
    got = url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict").collect()
    assert len(got) == len(PAGES)
    for r in got:
        assert tuple(r)[1:] == EXPECTED[r["page_id"]], r


@pytest.mark.parametrize("base", ["http://h.net", "http://h.net/", "http://h.net/a", "http://h.net/a/b/c?d=/../e#f", "http://h.net/a/b/"])
def test_links_with_dot_segments(spark, base):
    targets = ["../x", "./x", "x", ".", "..", "./", "../", "../../../x", "a/./b/../c", "../x?q=/../y", "/p/../x", "/p/.", "/p/..", "/..", ".x", "..x/y", "x.", "...", "?/../"]
    frame = spark.createDataFrame([(base, t) for t in targets], "base string, target string")
    got = {r["target"]: r["whole"] for r in frame.select("target", url_filter.resolved(F.col("base"), F.col("target")).alias("whole")).collect()}
    assert got == {t: urljoin(base, t) for t in targets}


def test_blocks_reach_over_dot_segments(spark):
    rules = (url_filter.Rule("block", "h.net/es/"),)
    pages = spark.createDataFrame([
        (0, "http://h.net/a/b", '<link rel="canonical" href="../es/1">'),
        (1, "http://h.net/c/d/e", "<meta http-equiv=refresh content='0; url=./x'>"),
        (2, "http://h.net/c/d/x", '<link rel="canonical" href="../../es/2">'),
        (3, "http://h.net/q/./r/../s?t=/../u", None),
        (4, "http://h.net/q/s?t=/../u", '<link rel="canonical" href="http://H.net/t/../es/3">'),
        (5, "http://h.net/es/..", '<link rel="canonical" href="http://h.net/v">'),
        (6, "http://h.net/v", None), (7, None, None), (8, "a/../b", None),
    ], "page_id long, url string, html string")
    got = {r["page_id"]: (r["verdict"], r["path"]) for r in url_filter.judge(pages, rules).collect()}
    assert got == {0: ("block", "/a/b"), 1: ("block", "/c/d/e"), 2: ("block", "/c/d/x"), 3: ("block", "/q/./r/../s"), 4: ("block", "/q/s"),
                   5: ("block", "/es/.."), 6: ("allow", "/v"), 7: ("allow", ""), 8: ("allow", "")}


def test_redirect_table_and_rules(spark):
    pages = spark.createDataFrame([(i, f"http://h.net/{i}", None) for i in range(6)], "page_id long, url string, html string")
    hops = spark.createDataFrame([(f"http://h.net/{i}", f"http://h.net/{i + 1}") for i in (0, 1, 3)] + [(None, "x"), ("y", None)], "url string, target string")
    rules = (url_filter.Rule("block", "h.net/2"), url_filter.Rule("allow", "h.net/1"))
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, rules, hops).collect()}
    assert got == {0: "block", 1: "allow", 2: "block", 3: "allow", 4: "allow", 5: "allow"}


def test_no_pages(spark):
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- components --------------------------------------------------------------------------------

@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(5, 2), (2, 5), (7, 8)], [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 100)],
    [(i % 17, i % 23 + 100) for i in range(40)], [(None, 3), (3, None), (3, 4)],
])
def test_roots(spark, links):
    got = {r["node"]: r["root"] for r in connected.roots(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    names = sorted({x for pair in real for x in pair})
    both = set(real) | {(b, a) for a, b in real}
    group = brute.components(names, lambda a, b: (a, b) in both)
    least = defaultdict(lambda: math.inf)
    for n, g in zip(names, group):
        least[g] = min(least[g], n)
    assert got == {n: least[g] for n, g in zip(names, group) if n != least[g]}


# --- top-k -------------------------------------------------------------------------------------

def vectors(seed, n=120, width=6):
    rnd = np.random.default_rng(seed)
    rows = [(int(i), [float(np.float32(x)) for x in rnd.normal(size=width)]) for i in range(n)]
    rows[7] = (7, rows[0][1])
    rows[8] = (8, rows[0][1])
    return rows + [(200, None), (210, [1.0, None, 0.0]), (220, [float("nan")] * width), (230, [float("inf")] * width), (None, rows[3][1])]


@pytest.mark.parametrize("nodes,cell_queries,cell_candidates", [(2, 512, 4096), (3, 2, 13), (1, 1, 1000)])
def test_top_k(spark, nodes, cell_queries, cell_candidates):
    rows = vectors(1)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("vec", F.lit(1)).withColumn("uid", F.lit("x"))
    got = uniform_topk.top_k(frame, F.col("vec_id") % 10 == 0, 5, nodes, 256, cell_queries, cell_candidates)
    assert as_rows(got, "query_id", "rank", "vec_id", "score") == sorted(brute.top_k(rows, 5, 10), key=repr)


def test_few_candidates_and_repeated_rows(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (0, [1.0, 0.0]), (3, [0.5])], "vec_id long, embedding array<float>")
    got = as_rows(uniform_topk.top_k(frame, F.col("vec_id") == 0, 5), "query_id", "rank", "vec_id", "score")
    assert got == sorted([(0, 1, 0, 65536), (0, 2, 3, 32768)] * 2, key=repr)


@pytest.mark.parametrize("scale,kind", [(256, "smallint"), (1 << 20, "int"), (3, "bigint")])
def test_vectors_take_little_room(spark, scale, kind):
    """Scores are the same whatever whole numbers the vectors are held as, also at the ends of a type's range."""
    rows = [(i, [math.cos(i), math.sin(i), -1.0, 127.0 if kind == "smallint" else 2.0]) for i in range(40)]
    rows[5] = (5, [-128.0 if kind == "smallint" else -2.0, 0.0, 0.0, 0.0])
    if kind == "bigint":
        rows[6] = (6, [2.0 ** 33, 0.0, 0.0, 1.0])
    whole = [[math.floor(scale * x) for x in v] for _, v in rows]
    assert uniform_topk._narrowest(min(map(min, whole)), max(map(max, whole))) == kind
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = as_rows(uniform_topk.top_k(frame, F.col("vec_id") % 5 == 0, 3, scale=scale, cell_queries=3, cell_candidates=7), "query_id", "rank", "vec_id", "score")
    plain = []
    for q in range(0, 40, 5):
        best = sorted((-sum(a * b for a, b in zip(whole[q], whole[c])), c) for c in range(40) if c != q)[:3]
        plain += [(q, r, c, -score) for r, (score, c) in enumerate(best, 1)]
    assert got == sorted(plain, key=repr)


def test_copies_are_searched_once(spark, monkeypatch):
    rnd = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rnd.normal(size=4)]) for i in range(60)]
    hot = [float(x) for x in (3, 3, 3, 3)]
    rows += [(60 + i, hot) for i in range(150)] + [(300 + i, rows[5][1]) for i in range(3)] + [(400, hot + [0.0]), (None, hot)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    stores, plain = {}, uniform_topk.stored

    def stored(df, name, *rest):
        stores[name] = plain(df, name, *rest)
        return stores[name]

    monkeypatch.setattr(uniform_topk, "stored", stored)
    got = uniform_topk.top_k(frame, F.lit(True), 5, cell_queries=16, cell_candidates=50)
    padded = [(i, [*v, *[0.0] * (5 - len(v))]) for i, v in rows]
    expected = brute.top_k(padded, 5, 1)
    # The row without an id asks too, and has the copies of the smallest ids.
    score = 4 * (3 * 256) ** 2
    expected += [(None, rank, 59 + rank, score) for rank in range(1, 6)]
    assert as_rows(got, "query_id", "rank", "vec_id", "score") == sorted(expected, key=repr)
    # 61 different vectors on two nodes; the 152 equal ones would send 152 * 151 entries a node among themselves.
    assert stores["reaching"].count() <= 2 * 61 * 61


def test_no_vectors(spark):
    assert uniform_topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(i, [1e9 + i, 3e8 - i]) for i in range(10)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = as_rows(uniform_topk.top_k(frame, F.col("vec_id") == 0, 3, scale=1), "query_id", "rank", "vec_id", "score")
    exact = sorted(((sum(int(x) * int(y) for x, y in zip(rows[0][1], v)), -i) for i, v in rows[1:]), reverse=True)[:3]
    assert got == sorted([(0, r, -i, s) for r, (s, i) in enumerate(exact, 1)], key=repr)


# --- pipeline ----------------------------------------------------------------------------------

def plain_pipeline(rows):
    """The stages by definition, for documents that are all long enough to have a language."""
    kept = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    flags = defaultdict(int)
    for doc_id, _, _, stays, sha in brute.exact([(r[0], r[1]) for r in kept]):
        if stays:
            flags[doc_id, sha] += 1
    import hashlib

    first = {}
    for r in kept:
        key = r[0], hashlib.sha256(brute.BLANK.sub("", r[1]).encode()).hexdigest()
        if flags.get(key) and key not in first:
            first[key] = r
    kept = list(first.values())
    near = brute.near_duplicates([(r[0], r[1]) for r in kept])
    kept = [r for r, (doc_id, _, least) in zip(kept, near) if doc_id == least]
    return kept


def test_pipeline_stages(spark, tmp_path):
    rows = [r for r in messy_rows() if r[0] is not None]
    folder = tmp_path / "sf"
    spark.createDataFrame(rows, DOCUMENTS).withColumn("kept", F.lit("own")).withColumn("fp", F.lit(1)).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        found = stage(spark, docs, str(folder))
        assert found.columns == docs.columns
        found.write.parquet(f"{folder}/{i}")
        before, docs = docs, spark.read.parquet(f"{folder}/{i}")
        if i == 2:
            expected = plain_pipeline(rows)
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(r[0] for r in expected)
    by_id = {r["doc_id"]: r["text"] for r in before.collect()}
    rest = {r["doc_id"]: r for r in docs.collect()}
    removed = dict(zip(by_id, brute.repeats(list(by_id.values()), suffix_dedup.PASSAGE)))
    for doc_id, row in rest.items():
        size, gone, _, _ = removed[doc_id]
        assert size - gone - 6 <= len(row["text"].encode()) <= size - gone
        assert row["n_chars"] == len(row["text"]) and row["kept"] == "own"
    whole = corpus_pipeline.run(spark, str(folder))
    tokens = dict(zip(rest, brute.word_ids([r["text"] for r in rest.values()])))
    total = defaultdict(int)
    for r in whole.collect():
        total[r["doc_id"]] += r["length"]
        own = tokens[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == brute.crc_of(own)
    assert total == {d: len(t) for d, t in tokens.items()}


@pytest.mark.parametrize("words", [51, 55, 60])
def test_short_passages(spark, tmp_path, words):
    """Passages of just over 50 short words go, whole, from all documents that share one; the others stay as they are."""
    rnd = random.Random(words)
    pool = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 7))) for _ in range(4000)]
    passages = [prose(rnd, words, [w for w in pool if 4 <= len(w) <= 6]) for _ in range(5)]
    assert all(suffix_dedup.PASSAGE <= len(p) < suffix_dedup.LENGTH for p in passages)
    ends = [(prose(rnd, 80, pool), prose(rnd, 80, pool)) for _ in range(30)]
    texts = [f"{a} {passages[i % 5]} {b}" if i < 20 else f"{a} {b}" for i, (a, b) in enumerate(ends)]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {r["doc_id"]: r["text"] for r in dict(corpus_pipeline.STAGES)["repeat_removal"](spark, docs, str(tmp_path)).collect()}
    for i, (a, b) in enumerate(ends):
        if i < 20:  # where two of its documents go on alike by chance, a letter more goes
            assert a.startswith(kept[i][:70]) and b.endswith(kept[i][-70:]) and len(a + b) - 8 <= len(kept[i]) <= len(a + b)
        else:
            assert kept[i] == texts[i]
    found = {r["doc_id"]: r for r in QUERIES["op8_suffix_dedup"](spark, str(tmp_path)).collect()}
    assert all((found[i]["n_repeated"] > 0) == (i < 20) and found[i]["n_removed"] == 0 for i in found)


def test_pipeline_without_documents(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


# --- registered queries against SQL ------------------------------------------------------------

@pytest.mark.parametrize("name", ["op1_url_filter", "op3_block_names", "op5_uniform_topk"])
def test_against_duckdb(spark, sf_dir, name):
    from ledgerweb.llm.oracle import ORACLE
    from tests.oracle_check import difference, duck

    assert difference(QUERIES[name](spark, sf_dir).toPandas(), duck(sf_dir).execute(ORACLE[name]).df()) is None
