"""The contracts of the corpus operators by plain definition, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import xxhash

BLANK = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def word_ids(texts, end_id=2):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [t.encode(x or "", add_special_tokens=False).ids + [end_id] for x in texts]


def crc_of(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def stored_ids(rows):
    """rows: (doc_id, text), ids not null."""
    out, start = [], 0
    rows = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or ""))
    for (doc_id, _), ids in zip(rows, word_ids([t for _, t in rows])):
        out.append((doc_id, start, len(ids), crc_of(ids)))
        start += len(ids)
    return out


def exact(rows):
    groups = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        groups[BLANK.sub("", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, i))
    out = []
    for norm, members in groups.items():
        head = min(members)
        for _, null, doc_id, i in members:
            out.append((rows[i][0], rows[head[3]][0], len(members), i == head[3], hashlib.sha256(norm.encode()).hexdigest()))
    return out


def top_k(rows, k, every):
    """rows: (vec_id, vector), ids different."""
    fine = [(v, [math.floor(256 * float(x)) for x in vec]) for v, vec in rows
            if vec is not None and all(x is not None and math.isfinite(x) for x in vec)]
    out = []
    for q, a in fine:
        if q is not None and q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), c is None, c or 0, c) for c, b in fine if c != q)
            out += [(q, rank, c, -s) for rank, (s, _, _, c) in enumerate(scores[:k], 1)]
    return out


def language_profiles(rows, size):
    """rows: (text, lang) -> for each language its most frequent n-grams as tuples of code points plus one, a gap being 1."""
    seen = {}
    for text, lang in rows:
        spaced = "".join(c if c.isalpha() else " " for c in (text or "").lower())
        if lang is not None and spaced.strip():
            marks = [1 if c == " " else ord(c) + 1 for c in f" {' '.join(spaced.split())} "]
            found = seen.setdefault(lang, Counter())
            found.update(tuple(marks[i:i + n]) for n in (1, 2, 3) for i in range(len(marks) - n + 1) if marks[i:i + n] != [1])
    return {lang: sorted(found, key=lambda g: (-found[g], len(g), g))[:size] for lang, found in seen.items()}


def language_model(rows, prior, order):
    """rows: (doc_id, text, held_out) -> doc_id, held_out, n_tokens, n_known, N, base, score."""
    seen = Counter()
    for _, text, held in rows:
        if not held:
            tokens = ["", *words(text), "\n"]
            seen.update(tuple(tokens[i:i + n]) for n in range(1, order + 1) for i in range(len(tokens) - n + 1))
    uni = {g[0]: c for g, c in seen.items() if len(g) == 1 and g != ("",)}
    total, distinct = sum(uni.values()), len(uni)

    def p(word, history):
        if not history:
            return (uni.get(word, 0) + 0.1) / (total + 0.1 * (distinct + 1))
        return (seen[(*history, word)] + prior * p(word, history[1:])) / (seen[history] + prior)

    out = []
    for doc_id, text, held in rows:
        tokens = ["", *words(text), "\n"]
        places = range(1, len(tokens))
        base = sum(math.log10(p(tokens[i], ())) for i in places)
        score = sum(math.log10(p(tokens[i], tuple(tokens[max(0, i - order + 1):i]))) for i in places)
        out.append((doc_id, held, len(places), sum(tokens[i] in uni for i in places), total, base, score))
    return out


def repeats(texts, length):
    """For each text: n_bytes, n_removed, n_spans, sha256 of the rest."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(r), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return out


def byte_bpe(texts):
    import base64

    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for t in texts:
        ids = enc.encode_ordinary(t or "")
        out.append((len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                    hashlib.sha256((t or "").encode()).hexdigest()))
    return out


def simhash(text, shingle=4):
    w = words(text)
    if not w:
        return 0
    n = min(shingle, len(w))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + n]).encode(), 42) for i in range(len(w) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, linked):
    """Component number of each value, by breadth-first search."""
    group, todo = [None] * len(values), set(range(len(values)))
    while todo:
        first = todo.pop()
        group[first], queue = first, [first]
        while queue:
            at = queue.pop()
            near = [i for i in todo if linked(values[at], values[i])]
            for i in near:
                group[i] = first
            todo.difference_update(near)
            queue += near
    return group


def near_duplicates(rows, radius=4):
    prints = [simhash(t) for _, t in rows]
    distinct = sorted(set(prints))
    group = dict(zip(distinct, components(distinct, lambda a, b: (a ^ b).bit_count() <= radius)))
    least = defaultdict(list)
    for (doc_id, _), p in zip(rows, prints):
        if doc_id is not None:
            least[group[p]].append(doc_id)
    return [(doc_id, f"{p:016x}", min(least[group[p]], default=None)) for (doc_id, _), p in zip(rows, prints)]
