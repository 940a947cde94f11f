"""Fill-in-middle: cuts and texts against plain slicing, the rank index against the boundaries themselves."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerweb.llm import fill_middle
from ledgerweb.llm.fill_middle import RankIndex, boundaries, cone, fill_in_middle, restored
from ledgerweb.llm.queries import QUERIES
from tests.llm.conftest import as_rows

COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]


def plain(doc_id, text, seed=1, plain_from=90, spm_below=20, marks=("<P>", "<S>", "<M>")):
    text, n = text or "", len(text or "")
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in marks) or h[2] % 100 >= plain_from:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, s, m = marks
    if h[3] % 100 < spm_below:
        return doc_id, n, "spm", a, b - a, s + text[b:] + p + text[:a] + m + text[a:b]
    return doc_id, n, "psm", a, b - a, p + text[:a] + s + text[b:] + m + text[a:b]


def with_marks(rows):
    extra = ["a<P>b", "x <S> y", "<M>", "<P", "<S<P", "< P>", "<<<>>>", "é<P" * 50]
    return rows + [(1000 + i, t, None, None, None) for i, t in enumerate(extra * 4)]


def test_against_slicing(spark, messy, messy_docs, clashing_docs):
    rows = with_marks(messy)
    docs = spark.createDataFrame(rows, messy_docs.schema)
    assert as_rows(fill_in_middle(docs), *COLUMNS) == sorted((plain(r[0], r[1]) for r in rows), key=repr)
    assert as_rows(fill_in_middle(clashing_docs), *COLUMNS) == sorted((plain(r[0], r[1]) for r in messy), key=repr)


@pytest.mark.parametrize("seed,plain_from,spm_below,marks", [
    (7, 101, 101, ("<P>", "<S>", "<M>")), (8, 101, 0, ("[pre]", "<suf>", "(mid)")), (9, 0, 50, ("<P>", "<S>", "<M>"))])
def test_settings_and_restoring(spark, messy, messy_docs, seed, plain_from, spm_below, marks):
    rows = with_marks(messy)
    made = fill_in_middle(spark.createDataFrame(rows, messy_docs.schema), seed, plain_from, spm_below, marks)
    assert as_rows(made, *COLUMNS) == sorted((plain(r[0], r[1], seed, plain_from, spm_below, marks) for r in rows), key=repr)
    back = made.select("doc_id", restored(F.col("output"), F.col("form"), marks).alias("text"))
    assert as_rows(back) == sorted(((r[0], r[1] or "") for r in rows), key=repr)


def test_no_documents(no_docs):
    assert fill_in_middle(no_docs).collect() == []


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("a", "a", "b"), ("", "<S>", "<M>"), ("<P>", "<S><P>", "<M>"), ("aba", "<S>", "<M>"), ("<P<", "<S>", "<M>")])
def test_marks_that_cannot_be_told_apart(no_docs, marks):
    with pytest.raises(ValueError):
        fill_in_middle(no_docs, sentinels=marks)


def mixed(rnd, n):
    """Stretches of one to four bytes a code point, and mixtures."""
    out = []
    while sum(map(len, out)) < n:
        pool = rnd.choice(["abc ", "é", "日本", "\U0001f600", "aé日\U0001f600", "aaaaaaaé"])
        out.append("".join(rnd.choice(pool) for _ in range(rnd.randint(1, 3000))))
    return "".join(out)


@pytest.mark.parametrize("error", [1, 10, 127])
def test_rank_index(error):
    rnd = random.Random(error)
    for n in (0, 1, 2, 100, 30_000):
        text = mixed(rnd, n)[:n]
        index, raw = RankIndex(text.encode(), error=error), text.encode()
        want = np.cumsum([0, *(len(c.encode()) for c in text)])
        assert index.units == len(text) and [index.offset(r) for r in range(len(text) + 1)] == want.tolist()
        offsets = want[:-1]
        covered = 0
        for first, end, slope in cone(offsets, error):
            assert first == covered and np.abs(offsets[first] + slope * np.arange(end - first) - offsets[first:end]).max() <= error + 1e-6
            covered = end
        assert covered == len(offsets) and len(raw) == index.size
    assert len(RankIndex(b"a" * 100_000).lines) == 1


def test_long_text_in_slices(spark, monkeypatch):
    text = mixed(random.Random(3), 5_000_000)
    raw = text.encode()
    assert len(raw) > 4 * fill_middle.SLICE
    parts = list(boundaries(raw))
    assert len(parts) > 4 and max(map(len, parts)) <= fill_middle.SLICE
    rows = [(i, text + str(i)) for i in range(3)]
    got = fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256))
    want = [(*plain(*r)[:5], hashlib.sha256(plain(*r)[5].encode()).hexdigest()) for r in rows]
    assert as_rows(got) == sorted(want, key=repr)


def test_other_units(spark, monkeypatch):
    """Words with the blanks after them: cuts lie between words."""
    texts = ["", "  lead and trail  ", "one", "é è  ê\nñ", "   ", "a b " * 5000]
    for text in texts:
        units = re.findall(r"^\s+|\S+\s*", text)
        want = np.cumsum([0, *(len(u.encode()) for u in units)])
        for size in (2, 7, 1 << 20):
            monkeypatch.setattr(fill_middle, "SLICE", size)
            index = RankIndex(text.encode(), re.compile(rb"[^ \t\n]+"))
            assert index.units == len(units) and [index.offset(r) for r in range(len(units) + 1)] == want.tolist()
    monkeypatch.undo()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in fill_in_middle(docs, plain_from=101, spm_below=0, unit=r"[^ \t\n]+").collect():
        units = re.findall(r"^\s+|\S+\s*", texts[r["doc_id"]])
        assert r["n"] == len(units)
        if r["form"] == "psm":
            a, b = r["prefix_chars"], r["prefix_chars"] + r["middle_chars"]
            assert r["output"] == "<P>" + "".join(units[:a]) + "<S>" + "".join(units[b:]) + "<M>" + "".join(units[a:b])


def test_query(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op11_fill_middle"](spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        want = plain(r["doc_id"], docs[r["doc_id"]])
        assert tuple(r)[:5] == want[:5]
        assert r["output_sha256"] == hashlib.sha256(want[5].encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256((docs[r["doc_id"]] or "").encode()).hexdigest()
