"""Operators on documents against plain definitions, on input with every odd case."""

import math
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerweb.functions.lineage import scratch_path
from ledgerweb.llm import (
    backoff_lm, block_names, blocks, byte_bpe, lang_profiles, packing, simhash_bk, suffix_dedup, token_store,
)
from ledgerweb.llm.common import ROW, remainder
from ledgerweb.llm.queries import BYTE_BPE, WORD_BPE
from tests.llm import brute
from tests.llm.conftest import as_rows


def pairs(messy):
    return [(r[0], r[1]) for r in messy]


def same(got, expected):
    assert Counter(got) == Counter(expected)


# --- token store -------------------------------------------------------------------------------

@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    for n in (0, 1, 7, 8, 1000):
        ids = np.random.default_rng(n).integers(0, 2 ** 32, n, dtype=np.uint32)
        assert (token_store.from_planes(token_store.to_planes(ids, kind), n, kind) == ids).all()


def test_crc_of_joined_strings():
    import zlib

    a, b = b"first part", b"and the second one" * 99
    assert token_store.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert token_store.crc32_joined(zlib.crc32(a), 0, 0) == zlib.crc32(a)


@pytest.mark.parametrize("kind,chunk_ids", [("byte", 1 << 16), ("bit", 100)])
def test_stored_ids(spark, clashing_docs, messy, kind, chunk_ids):
    path = scratch_path(spark, "ids")
    token_store.write_ids(clashing_docs, path, WORD_BPE, 2, chunk_ids, kind)
    rows = sorted(pairs(messy), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    expected, start = [], 0
    for (doc_id, _), ids in zip(rows, brute.word_ids([t for _, t in rows])):
        expected.append((doc_id, start, len(ids), brute.crc_of(ids)))
        start += len(ids)
    same(as_rows(token_store.document_crcs(spark, path)), expected)
    got = {r["start"]: np.frombuffer(r["ids"], "<u4").tolist() for r in token_store.read_ids(spark, path).collect()}
    assert [got[s] for _, s, _, _ in expected] == brute.word_ids([t for _, t in rows])


def test_encoder_equals_the_library():
    import random

    from ledgerweb.llm.token_ids import WordEncoder

    rnd = random.Random(11)
    parts = ["a", "Ab", "été", "É", "İ", "Σ", "ΟΔΟΣ", "ος", "5", "½", "Ⅷ", "_", "'s", "it's,", ",", ".", ",,", "..", ", ", ". ", " ", "  ", "\n", "\t",
             "\u00a0", "\u0301", "\u200d", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "日本", "。", "\"x\",", "(y).", "z.,", "\U0001f600", "-", "e\u0301,"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(6000)]
    texts += [" ".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    encode = WordEncoder(WORD_BPE).encode
    for at in range(0, len(texts), 500):
        own = texts[at:at + 500]
        for text, got, ids in zip(own, encode(own), brute.word_ids(own)):
            assert got.tolist() == ids[:-1], repr(text)


def test_no_ids(spark, no_docs):
    path = scratch_path(spark, "ids")
    token_store.write_ids(no_docs, path, WORD_BPE)
    assert token_store.document_crcs(spark, path).count() == 0


# --- block naming ------------------------------------------------------------------------------

@pytest.mark.parametrize("size", [4096, 5])
def test_exact_duplicates(clashing_docs, messy, size):
    found = block_names.exact_duplicates(clashing_docs, size)
    got = as_rows(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    same(got, brute.exact(pairs(messy)))


def test_names_tell_lengths_apart(spark):
    docs = spark.createDataFrame([(0, "aaaa"), (1, "aaaaaaaa"), (2, "aaaaaaaaaaaa"), (3, "aaaa" * 4), (4, "aaaa" * 3), (5, "")], "doc_id long, text string")
    found = {r["doc_id"]: r["group_size"] for r in block_names.exact_duplicates(docs, 4).collect()}
    assert found == {0: 1, 1: 1, 2: 2, 3: 1, 4: 2, 5: 1}


def test_no_duplicates_of_nothing(no_docs):
    assert block_names.exact_duplicates(no_docs).count() == 0


# --- language ----------------------------------------------------------------------------------

def test_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/../sf0.01/documents.parquet").withColumn("held", remainder("doc_id", 5) == 0)
    profiles = lang_profiles.learn(docs.filter("not held"))
    found = lang_profiles.identify(docs.filter("held"), profiles)
    right = found.filter("lang = lang_pred").count() / found.count()
    assert right >= 0.95
    assert found.filter("score < 0 or score > 1").count() == 0


def test_learned_profiles(spark):
    """Against a plain version: ties, gaps of several characters, capitals, letters beyond ASCII, rows without text, letters or language."""
    rnd = np.random.default_rng(11)
    parts = ["Der", "die", "das", "Ärger", "the", "THE", "an", "\u4e2d\u6587", "x1y", "--", "  ", "\n", "a.b", "\U0001d49c"]
    rows = [(i, " ".join(rnd.choice(parts, 30)), ["de", "en", "zh", None][i % 4]) for i in range(80)]
    rows += [(100, None, "de"), (101, "", "en"), (102, "12 34 --", "xx"), (103, rows[1][1], "en"), (1, rows[1][1], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    for size in (5, 40, 300):
        learned = {lang: codes.tolist() for lang, codes in lang_profiles.learn(docs, size).items()}
        plain = brute.language_profiles([r[1:] for r in rows], size)
        assert learned == {lang: [sum(m << lang_profiles.BITS * i for i, m in enumerate(reversed(g))) for g in found] for lang, found in plain.items()}


def test_language_of_odd_texts(clashing_docs, messy):
    profiles = {"en": np.array([5, 6], dtype=np.int64), "de": np.array([7], dtype=np.int64)}
    found = lang_profiles.identify(clashing_docs, profiles)
    assert found.count() == len(messy)
    for row in found.select("text", "lang_pred", "score").collect():
        has_letters = any(c.isalpha() for c in row["text"] or "")
        assert (row["lang_pred"] != "und") == has_letters
        assert 0 <= row["score"] <= 1
    assert set(clashing_docs.columns) - {"lang_pred", "score"} <= set(found.columns)


def test_nothing_learned(messy_docs, no_docs):
    assert lang_profiles.learn(no_docs) == {}
    assert {r["lang_pred"] for r in lang_profiles.identify(messy_docs, {}).collect()} == {"und"}


def test_more_than_a_thousand_languages(spark):
    # Each language has one letter of its own; the rare ones come last by number of documents and by name.
    rows = [(2 * i + j, f"{chr(0x4E00 + i)} a", f"l{i:04}") for i in range(1003) for j in range(2 if i < 1000 else 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = lang_profiles.learn(docs)
    assert len(profiles) == 1003
    found = lang_profiles.identify(docs, profiles).filter("lang != lang_pred").count()
    assert found == 0
    with pytest.raises(ValueError, match="more than 1002 languages"):
        lang_profiles.learn(docs, languages=1002)


def test_profile_is_by_count_then_code():
    points = lang_profiles.letters("ab ab b", lang_profiles.letter_table())
    codes, counts = lang_profiles.grams(points)
    expected = Counter()
    text = "".join(chr(p) if p else " " for p in points.tolist())
    assert text == " ab ab b "
    for n in (1, 2, 3):
        expected.update(text[i:i + n] for i in range(len(text) - n + 1) if n > 1 or text[i] != " ")
    assert sorted(counts.tolist()) == sorted(expected.values())
    assert len(lang_profiles.profile(points, 3)) == 3


def test_rank_order_distance_by_definition():
    own = lang_profiles.profile(lang_profiles.letters("the cat sat on the mat", lang_profiles.letter_table()), 300)
    other = lang_profiles.profile(lang_profiles.letters("der hund lief um das haus", lang_profiles.letter_table()), 300)
    name, score = lang_profiles.Identifier({"a": own, "b": other}, 300).best("the cat sat on the mat")
    assert (name, score) == ("a", 1.0)
    places = {g: i for i, g in enumerate(other.tolist())}
    distance = sum(abs(places[g] - i) if g in places else 300 for i, g in enumerate(own.tolist()))
    assert lang_profiles.Identifier({"b": other}, 300).best("the cat sat on the mat")[1] == pytest.approx(1 - distance / (300 * len(own)))


# --- packing -----------------------------------------------------------------------------------

def plain_best_fit(lengths, capacity):
    rooms, places = [], []
    for n in lengths:
        fits = [r for r in rooms if r >= n]
        if not fits:
            rooms.append(capacity - n)
            places.append(capacity)
        else:
            tight = min(fits)
            rooms[rooms.index(tight)] -= n
            places.append(tight)
    return places


@pytest.mark.parametrize("capacity", [1, 7, 64, 100])
def test_segment_tree_finds_tightest(capacity):
    rnd = np.random.default_rng(capacity)
    lengths = sorted(rnd.integers(1, capacity + 1, 400).tolist(), reverse=True)
    assert [capacity - o for _, o in packing.best_fit(lengths, capacity)] == plain_best_fit(lengths, capacity)


@pytest.mark.parametrize("shard_pieces", [1 << 15, 10])
def test_packing(clashing_docs, messy, shard_pieces):
    window = 512
    pieces = packing.stored(packing.cut_documents(clashing_docs, WORD_BPE, 2, window, keep_ids=True), "pieces")
    placed = packing.stored(packing.place(pieces, window, shard_pieces), "placed")
    by_window, by_doc = defaultdict(list), Counter()
    for r in placed.collect():
        by_window[r["sequence_id"]].append((r["offset"], r["length"], r["ids"]))
        by_doc[r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]] += 1
        assert brute.crc_of(np.frombuffer(r["ids"], "<u4")) == r["ids_crc32"]
    assert sorted(by_window) == list(range(len(by_window)))
    for held in by_window.values():
        at = 0
        for offset, length, _ in sorted(held):
            assert offset == at
            at += length
        assert at <= window
    expected = Counter()
    for (doc_id, _), ids in zip(pairs(messy), brute.word_ids([t for _, t in pairs(messy)])):
        for s in range(0, len(ids), window):
            own = ids[s:s + window]
            expected[doc_id, s, len(own), brute.crc_of(own), len(ids)] += 1
    assert by_doc == expected
    total = sum(r[2] * n for r, n in expected.items())
    if shard_pieces > 10:
        assert len(by_window) <= 1.1 * total / window + 1
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(placed, 9, window).collect()}
    for i, held in by_window.items():
        raw = b"".join(x for _, _, x in sorted(held))
        assert whole[i] == raw + b"\x09\0\0\0" * (window - len(raw) // 4)


def test_nothing_to_pack(no_docs):
    assert packing.pack(no_docs, WORD_BPE).count() == 0


# --- language model ----------------------------------------------------------------------------

def rounded(rows):
    return [(*r[:5], round(r[5], 7), round(r[6], 7)) for r in rows]


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_backoff_scores(clashing_docs, messy, order):
    import zlib

    held = [zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 10 < 3 for r in messy]
    docs = clashing_docs.withColumn("held_out", remainder("doc_id", 10) < 3)
    expected = brute.language_model([(r[0], r[1], h) for r, h in zip(messy, held)], backoff_lm.PRIOR, order)
    same(rounded(as_rows(backoff_lm.score(docs, order=order))), rounded(expected))


def test_segments_of_a_text_take_up_its_state():
    rnd = np.random.default_rng(5)
    texts = [" ".join(rnd.choice(list("abcdef"), n)) for n in (0, 1, 40, 700)]
    body, _, _ = backoff_lm.list_block(texts, np.array([True, True, False, True]))
    answers = []
    for _ in range(4):
        lists = backoff_lm.count_block(body, tuple(answers), 3)
        answers.append({b: backoff_lm.merge_counts([data])[0] for b, data in lists.items()})
    own, levels = backoff_lm.known(body, tuple(answers), 4)
    model = backoff_lm.automaton(levels, 745, 7, backoff_lm.PRIOR)
    whole = backoff_lm.traverse(model, own.stream, own.lengths, 1000)
    assert len(whole) == own.lengths.sum() and np.isfinite(whole).all()
    for segment in (1, 7, 64):
        assert (backoff_lm.traverse(model, own.stream, own.lengths, segment) == whole).all()


def test_model_without_training(messy_docs, messy, no_docs):
    for r in backoff_lm.score(messy_docs.withColumn("held_out", F.lit(None).cast("boolean"))).collect():
        assert r["held_out"] and r["n_known"] == 0 and r["train_tokens"] == 0 and r["score"] == r["base_score"]
    assert backoff_lm.score(no_docs.withColumn("held_out", F.lit(True))).count() == 0


def test_probabilities_sum_to_one():
    rows = [(0, "a b a c", False), (1, "a b", False)]
    vocabulary = ["a", "b", "c", "\n"]
    uni = Counter("abac\n") + Counter("ab\n")
    total = sum(uni.values())
    p = {w: (uni[w] + 0.1) / (total + 0.1 * 5) for w in vocabulary}
    after_a = Counter({"b": 2, "c": 1})
    seen = sum((after_a[w] + backoff_lm.PRIOR * p[w]) / (3 + backoff_lm.PRIOR) for w in vocabulary)
    unknown = 1 - sum(p.values())
    assert math.isclose(seen + backoff_lm.PRIOR / (3 + backoff_lm.PRIOR) * unknown, 1)
    assert brute.language_model(rows, backoff_lm.PRIOR, 3)[0][3] == 5


# --- long repeats ------------------------------------------------------------------------------

@pytest.mark.parametrize("length,hot", [(400, 20_000), (64, 20_000), (64, 1), (400, 1), (128, 2)])
def test_repeats(clashing_docs, messy, length, hot):
    found = suffix_dedup.remove_repeats(clashing_docs, length, "kept_sha256", hot)
    got = as_rows(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    same(got, [(r[0], *b) for r, b in zip(messy, brute.repeats([r[1] for r in messy], length))])


def test_no_repeats_of_nothing(no_docs):
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_repeats_carry_columns(spark, messy_docs):
    """Carried columns stay with their rows, whatever their types, and change nothing else."""
    docs = messy_docs.withColumn("n_removed", F.struct("doc_id", F.array("lang", F.col("source")).alias("both")))
    carried = [F.col("n_removed").alias("more"), F.lit(1).cast("decimal(9,2)").alias("odd name"), F.current_date().alias("day")]
    found = suffix_dedup.remove_repeats(docs, 64, "kept_sha256", carried=carried)
    assert found.columns[-3:] == ["more", "odd name", "day"]
    assert found.filter(~F.col("more.doc_id").eqNullSafe(F.col("doc_id"))).count() == 0
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert as_rows(found, *columns) == as_rows(suffix_dedup.remove_repeats(docs, 64, "kept_sha256"), *columns)


def test_open_borders_are_long_common_prefixes():
    rnd = np.random.default_rng(3)
    for n, symbols, depth in ((300, 2, 5), (500, 3, 8), (64, 40, 3)):
        text = np.concatenate([rnd.integers(0, symbols, n), np.arange(symbols, symbols + 1)])
        order = suffix_dedup.suffix_order(text, depth)
        suffixes = [text[i:i + depth].tolist() for i in order]
        assert suffixes == sorted(suffixes)
        expected = [False] + [a == b and len(a) == depth for a, b in zip(suffixes, suffixes[1:])]
        assert suffix_dedup.open_borders(text, order, depth).tolist() == expected


# --- byte-level BPE ----------------------------------------------------------------------------

def test_byte_bpe(clashing_docs, messy):
    digests = byte_bpe.encode(clashing_docs, BYTE_BPE, public_tokenizers.PATTERN, digest=True)
    same(as_rows(digests), [(r[0], *b) for r, b in zip(messy, brute.byte_bpe([r[1] for r in messy]))])
    back = byte_bpe.decode(byte_bpe.encode(clashing_docs, BYTE_BPE, public_tokenizers.PATTERN), BYTE_BPE)
    same([(r["doc_id"], bytes(r["data"]).decode()) for r in back.collect()], [(i, t or "") for i, t in pairs(messy)])


def test_no_bpe(no_docs):
    assert byte_bpe.encode(no_docs, BYTE_BPE, public_tokenizers.PATTERN).count() == 0


# --- SimHash -----------------------------------------------------------------------------------

@pytest.mark.parametrize("limit", [20_000, 3])
def test_near_duplicates(clashing_docs, messy, limit):
    found = simhash_bk.near_duplicates(clashing_docs, limit=limit)
    got = as_rows(found, "doc_id", simhash_bk.hexadecimal().alias("fingerprint"), "component_id")
    same(got, brute.near_duplicates(pairs(messy)))
    parts = defaultdict(int)
    for r in found.select("component_id", "keep").collect():
        parts[r["component_id"]] += r["keep"]
    assert set(parts.values()) == {1}


@pytest.mark.parametrize("radius,agree,limit", [(4, 2, 20_000), (4, 1, 20_000), (3, 3, 20_000), (4, 2, 10)])
def test_links_connect_all_near_fingerprints(spark, radius, agree, limit):
    rnd = np.random.default_rng(5)
    values = set()
    for center in rnd.integers(0, 2 ** 63, 12).tolist():
        for _ in range(12):
            v = center
            for bit in rnd.integers(0, 64, rnd.integers(0, 8)).tolist():
                v ^= 1 << bit
            values.add(v)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash_bk.links(spark.createDataFrame([(v,) for v in signed], "fp long"), radius, agree, limit).collect()
    near = {(a, b) for a in values for b in values if (a ^ b).bit_count() <= radius}
    mask = (1 << 64) - 1
    joined = defaultdict(set)
    for r in found:
        joined[r["a"] & mask].add(r["b"] & mask)
        joined[r["b"] & mask].add(r["a"] & mask)
    group = brute.components(values, lambda a, b: b in joined[a])
    assert len(found) < len(near)
    assert group_sets(values, group) == group_sets(values, brute.components(values, lambda a, b: (a, b) in near))


def group_sets(values, group):
    sets = defaultdict(set)
    for v, g in zip(values, group):
        sets[g].add(v)
    return {frozenset(s) for s in sets.values()}


def test_a_dense_cluster_gives_few_links():
    values = [0] + [(1 << i) | (1 << j) for i in range(64) for j in range(i)]
    found = list(simhash_bk.clusters(values, 4))
    assert len(found) == len(values) - 1


def test_no_near_duplicates_of_nothing(no_docs):
    assert simhash_bk.near_duplicates(no_docs).count() == 0


# --- helpers -----------------------------------------------------------------------------------

def test_buckets_follow_the_texts(spark, monkeypatch):
    """With small buckets there are many of them, and the counts and encodings stay what they were."""
    docs = spark.createDataFrame([(i, f"some words here {i % 7} " * 40, False) for i in range(60)], "doc_id long, text string, held_out boolean")
    size = sum(len(f"some words here {i % 7} " * 40) for i in range(60))
    assert blocks.bucket_count(docs) == 4 and blocks.bucket_count(docs.filter("false")) == 4
    before = as_rows(backoff_lm.score(docs)), as_rows(suffix_dedup.remove_repeats(docs, 64, "kept_sha256").drop(*ROW))
    monkeypatch.setattr(blocks, "BUCKET_TEXT", 1000)
    assert blocks.bucket_count(docs) == -(-size // 1000)
    assert (as_rows(backoff_lm.score(docs)), as_rows(suffix_dedup.remove_repeats(docs, 64, "kept_sha256").drop(*ROW))) == before


def test_rows_behind_a_shuffle_keep_their_keys(spark, messy, messy_docs):
    """A frame without files, dealt anew with every run, gives one consistent answer."""
    dealt = messy_docs.repartition(5).withColumn("x", F.rand()).orderBy("x").drop("x")
    found = block_names.exact_duplicates(dealt).collect()
    assert len(found) == len(messy) and sum(r["kept"] for r in found) == len({r["text_sha256"] for r in found})
