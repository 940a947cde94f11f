"""Removal of long repeated byte strings, found on a Burrows-Wheeler transform.

A string of `length` bytes that starts at two places is found like this:

1. Anchors. Of every `length` bytes the 32-byte gram with the smallest hash is the anchor (winnowing). Equal strings have
   equal anchors at equal offsets, so two of them meet under the hash of their anchor. An anchor's context is all
   the strings it stands for, taken together.
2. Buckets count the contexts of each anchor hash; a context goes by 128 bits, the hash of its anchor and its own. An anchor that occurs once is done. A context that occurs more than once
   is repeated as a whole. What is left are contexts that occur once while their anchor occurs elsewhere.
3. Those contexts, and one copy of each repeated one, meet in the bucket of their anchor. They are read as symbols
   of 16 bytes on a grid fixed by the anchor, and joined to one text. Its Burrows-Wheeler transform is searched
   breadth first, backwards, from the empty string: each interval is extended by every symbol before it, and the end
   of an interval not met before has the common prefix of the present depth (Beller et al., 2013). Common prefixes come
   out by increasing value; at length - 16 bytes the search stops. Borders that are still open then have longer ones.
4. Strings that share those symbols are compared by the 16 bytes that remain, some before and some after them, which are fewer than
   a symbol. That gives the repeated starts exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweb.llm import blocks
from ledgerweb.llm.common import ROW, dump, keyed, load, ranges, stored

LENGTH = 400
PASSAGE = 256           # bytes; passages of over 50 words are seldom shorter, but often shorter than LENGTH
GRAM = 32
SYMBOL = 16
HOT = 20_000            # contexts of one anchor hash; more are dealt by their cores
BLOCK_BYTES = 4 << 20   # of texts; a block's arrays take several times as much
TEXT_BYTES = 4 << 20    # of one transform
HASHED_BYTES = 1 << 19  # of documents whose anchors are found together
RESULTS = {"kept": ("binary", bytes), "kept_sha256": ("string", lambda b: hashlib.sha256(b).hexdigest()),
           "kept_text": ("string", lambda b: b.decode("utf-8", "ignore"))}
DEAD, REPEATED, SINGLE, PARTNER = 0, 1, 2, 3
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
BYTE_VALUES = np.array([int.from_bytes(hashlib.sha256(bytes([b])).digest()[:8], "little") for b in range(256)], dtype=np.uint64)


def scrambled(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 32 bytes that start at each place."""
    with np.errstate(over="ignore"):
        h, by, span = BYTE_VALUES[data], MULTIPLIER, 1
        while span < GRAM:
            h = h[:-span] * by + h[span:]
            by, span = by * by, 2 * span
    return scrambled(h)


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchor place, hash, and the first and last string start it stands for. Strings lie within a document."""
    empty = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return empty, empty.astype(np.uint64), empty, empty
    hashes = gram_hashes(data)
    window, bits = length - GRAM + 1, np.uint64(max(1, int(len(hashes)).bit_length()))
    # The place in the low bits makes the leftmost of equal hashes the smallest.
    least = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while 2 * span <= window:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    if span < window:
        least = np.minimum(least[:len(least) - (window - span)], least[window - span:])
    begin = ranges(starts, np.maximum(ends - starts - length + 1, 0))
    at = (least[begin] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    if not len(at):
        return empty, empty.astype(np.uint64), empty, empty
    fresh = np.concatenate([[True], (at[1:] != at[:-1]) | (begin[1:] != begin[:-1] + 1)])
    first = np.flatnonzero(fresh)
    last = np.concatenate([first[1:], [len(at)]]) - 1
    return at[first], hashes[at[first]], begin[first], begin[last]


def block_anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> list[np.ndarray]:
    """Anchors of many documents, found for some documents at a time; a hash of each byte takes eight."""
    found, done = [], 0
    while done < len(ends):
        begin = int(starts[done])
        to = max(done + 1, int(np.searchsorted(ends, begin + HASHED_BYTES, side="right")))
        place, hashes, first, last = anchors(data[begin:ends[to - 1]], starts[done:to] - begin, ends[done:to] - begin, length)
        found.append((place + begin, hashes, first + begin, last + begin))
        done = to
    return [np.concatenate(column) for column in zip(*found, strict=True)]


def context_digests(raw: bytes, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(raw[a:b + length]) for a, b in zip(first.tolist(), last.tolist(), strict=True)), np.uint64, len(first))


def buckets_of(hashes: np.ndarray, count: int) -> np.ndarray:
    """Buckets of equal size; anchors' hashes are the smallest of many and therefore scrambled once more."""
    return ((scrambled(hashes * MULTIPLIER) >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)


def find_block(texts: list[bytes], length: int, buckets: int) -> tuple[bytes, dict[int, bytes], int]:
    """Body: the texts, and the anchors with the number of their context. By bucket: hash, digest and count of contexts."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    raw = b"".join(texts)
    place, hashes, first, last = block_anchors(np.frombuffer(raw, np.uint8), ends - sizes, ends, length)
    digests = context_digests(raw, first, last, length)
    bucket = buckets_of(hashes, buckets)
    order = np.lexsort((digests, hashes, bucket))
    h, d = hashes[order], digests[order]
    fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])]) if len(h) else np.zeros(0, bool)
    number = np.empty(len(h), dtype=np.int64)
    number[order] = np.cumsum(fresh) - 1
    h, d, counts = h[fresh], d[fresh], np.bincount(number, minlength=int(fresh.sum()))
    at = np.searchsorted(bucket[order][fresh], np.arange(buckets + 1))
    parts = {b: dump(h[at[b]:at[b + 1]], d[at[b]:at[b + 1]], counts[at[b]:at[b + 1]].astype("<u4")) for b in range(buckets) if at[b] < at[b + 1]}
    body = dump(sizes, np.frombuffer(raw, np.uint8), place.astype("<u4"), first.astype("<u4"), (last - first).astype("<u2"),
                number.astype("<u4"), h, level=3)
    return body, parts, int(sizes.sum())


def classify(lists: list[bytes], hot: int) -> list[bytes]:
    """For each context of each list: what becomes of it, and whether its anchor hash is hot."""
    asked = [load(data) for data in lists]
    h, d, n = (np.concatenate([a[i] for a in asked]) for i in range(3))
    order = np.lexsort((d, h))  # stable: the first list of a context comes first
    hs, ds = h[order], d[order]
    new_h = np.concatenate([[True], hs[1:] != hs[:-1]])
    new_d = new_h | np.concatenate([[True], ds[1:] != ds[:-1]])
    group_h, group_d = np.cumsum(new_h) - 1, np.cumsum(new_d) - 1
    count_d = np.bincount(group_d, weights=n[order]).astype(np.int64)
    contexts_h = np.bincount(group_h[new_d])
    alone = contexts_h[group_h] == 1
    many = count_d[group_d] > 1
    state = np.where(many, np.where(~alone & new_d, PARTNER, REPEATED), np.where(alone, DEAD, SINGLE))
    both = np.empty(len(h), dtype=np.uint8)
    both[order] = state + 4 * (contexts_h[group_h] > hot)
    at = np.cumsum([0] + [len(a[0]) for a in asked])
    return [dump(both[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)]


def _states(count: int, answers: dict[int, bytes]) -> np.ndarray:
    found = [load(answers[b])[0] for b in sorted(answers)]
    return np.concatenate([*found, np.zeros(0, np.uint8)]) if count else np.zeros(0, np.uint8)


def _representatives(number: np.ndarray, count: int) -> np.ndarray:
    """The first anchor of each context of a block."""
    first = np.zeros(count, dtype=np.int64)
    first[number[::-1]] = np.arange(len(number))[::-1]
    return first


def send_contexts(body: bytes, answers: dict[int, bytes], length: int, buckets: int) -> dict[int, bytes]:
    """By bucket the contexts to compare: whole ones by anchor hash; those of a hot hash by each of their cores."""
    sizes, data, place, first, spread, number, h = load(body)
    states = _states(len(h), answers)
    chosen = np.flatnonzero((states & 3) >= SINGLE)
    one = _representatives(number.astype(np.int64), len(h))[chosen]
    begin, starts, anchor = first[one].astype(np.int64), spread[one].astype(np.int64) + 1, place[one].astype(np.int64)
    hot, weight = states[chosen] >= 4, np.where((states[chosen] & 3) == PARTNER, 2, 1)
    parts: dict[int, bytes] = {}
    bucket = buckets_of(h[chosen], buckets)
    whole: dict[int, list] = {}
    for b in np.unique(bucket[~hot]).tolist():
        own = np.flatnonzero(~hot & (bucket == b))
        text = data[ranges(begin[own], starts[own] + length - 1)]
        whole[b] = [chosen[own].astype("<u4"), (anchor - begin)[own].astype("<u2"), starts[own].astype("<u2"),
                    weight[own].astype(np.uint8), text]
    cores: dict[int, list] = {}
    own = np.flatnonzero(hot)
    if len(own):
        context, core = _core_places(anchor[own] - begin[own], starts[own])
        at = begin[own][context] + core
        key = _core_keys(h[chosen][own][context], core - (anchor - begin)[own][context], data, at, length)
        padded = np.concatenate([np.zeros(SYMBOL, np.uint8), data, np.zeros(SYMBOL, np.uint8)])
        around = np.arange(SYMBOL)
        left, right = padded[at[:, None] + around], padded[(at + length)[:, None] + around]
        to = buckets_of(key[:, 0], buckets)
        for b in np.unique(to).tolist():
            x = np.flatnonzero(to == b)
            c = own[context[x]]
            cores[b] = [chosen[c].astype("<u4"), core[x].astype("<i4"), starts[c].astype("<u2"), weight[c].astype(np.uint8),
                        key[x].reshape(-1), left[x].reshape(-1), right[x].reshape(-1)]
    nothing = [np.zeros(0, np.uint8)]
    for b in whole.keys() | cores.keys():
        parts[b] = dump(np.array([b in whole, b in cores]), *whole.get(b, 5 * nothing), *cores.get(b, 7 * nothing), level=3)
    return parts


def _core_places(anchor: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each context the places, from its begin, of the cores of its strings: the grid places from a start up to the next."""
    low = anchor % SYMBOL
    last = starts - 1 + (low - (starts - 1)) % SYMBOL  # the first grid place at or after the last start
    count = (last - low) // SYMBOL + 1
    context = np.repeat(np.arange(len(anchor)), count)
    return context, ranges(np.zeros_like(count), count) * SYMBOL + low[context]


def _core_keys(hashes: np.ndarray, offset: np.ndarray, data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """128 bits that stand for anchor hash, offset and the bytes of the core."""
    raw = data.tobytes()
    size = length - SYMBOL
    digests = (hashlib.blake2b(raw[a:a + size], digest_size=16, key=int(h).to_bytes(8, "little"), salt=int(o).to_bytes(8, "little", signed=True)).digest()
               for a, h, o in zip(at.tolist(), hashes.tolist(), offset.tolist(), strict=True))
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)


def _named(rows: np.ndarray) -> np.ndarray:
    """Equal rows of 64-bit words get equal numbers, from 0."""
    key = rows[:, 0].copy()
    with np.errstate(over="ignore"):
        for i in range(1, rows.shape[1]):
            key = scrambled(key * MULTIPLIER + rows[:, i])
    order = np.argsort(key)
    new = np.any(rows[order[1:]] != rows[order[:-1]], axis=1)
    if np.any(new & (key[order[1:]] == key[order[:-1]])):  # different rows under one key
        order = np.lexsort(rows.T)
        new = np.any(rows[order[1:]] != rows[order[:-1]], axis=1)
    names = np.empty(len(rows), dtype=np.int64)
    names[order] = np.concatenate([[0], np.cumsum(new)]) if len(rows) else np.zeros(0, np.int64)
    return names


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first `depth` symbols, by doubling; a shorter suffix counts as ending with a smallest symbol."""
    ranks, known = {1: np.unique(text, return_inverse=True)[1] + 1}, 1

    def joined(left: np.ndarray, right: np.ndarray, by: int) -> np.ndarray:
        after = np.concatenate([right[by:], np.zeros(min(by, len(right)), dtype=np.int64)])
        return left * np.int64(len(text) + 1) + after

    while 2 * known <= depth:
        ranks[2 * known] = np.unique(joined(ranks[known], ranks[known], known), return_inverse=True)[1] + 1
        known *= 2
    key, have = ranks[known], known
    while have < depth:
        step = min(known, 1 << (depth - have).bit_length() - 1)
        key = np.unique(joined(key, ranks[step], have), return_inverse=True)[1] + 1
        have += step
    return np.argsort(key, kind="stable")


def open_borders(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """True where a suffix shares at least `depth` symbols with the one before it in `order`.

    Backward extension over the Burrows-Wheeler transform, breadth first, for the strings of length 1, 2, ..., `depth`.
    """
    n = len(text)
    first = text[order]
    transform = text[order - 1]  # before place 0 stands the last symbol
    to_first = np.empty(n, dtype=np.int64)
    to_first[np.argsort(transform, kind="stable")] = np.arange(n)
    prefix = np.full(n + 1, -1, dtype=np.int32)  # of the suffix and the one before it
    prefix[0] = 0
    low, high = np.zeros(1, dtype=np.int64), np.full(1, n - 1, dtype=np.int64)
    for found in range(depth):
        sizes = high - low + 1
        rows = ranges(low, sizes)
        owner = np.repeat(np.arange(len(low)), sizes)
        moved = to_first[rows]
        by_place = np.argsort(moved)
        moved, owner = moved[by_place], owner[by_place]
        symbol = first[moved]
        cut = np.flatnonzero((moved[1:] != moved[:-1] + 1) | (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])) + 1
        low, high = moved[np.concatenate([[0], cut])], moved[np.concatenate([cut, [len(moved)]]) - 1]
        unmet = prefix[high + 1] < 0
        low, high = low[unmet], high[unmet]
        prefix[high + 1] = found
        if not len(low):
            break
    return prefix[:n] < 0


def core_classes(data: np.ndarray, begin: np.ndarray, anchor: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Context, place from its begin, and class of each core; cores of one class have equal bytes."""
    size = starts + length - 1
    low = anchor % SYMBOL
    count = (size - low) // SYMBOL
    context = np.repeat(np.arange(len(begin)), count)
    place = ranges(np.zeros_like(count), count) * SYMBOL + low[context]
    names = _named(data[(begin[context] + place)[:, None] + np.arange(SYMBOL)].view("<u8").reshape(-1, 2))
    # Contexts one after another, each ended by a symbol of its own.
    text = np.empty(len(names) + len(begin), dtype=np.int64)
    at = np.arange(len(names)) + context
    text[at] = names
    ends = np.cumsum(count + 1) - 1
    text[ends] = len(names) + np.arange(len(begin))
    depth = length // SYMBOL - 1
    order = suffix_order(text, depth)
    classes = np.empty(len(text), dtype=np.int64)
    classes[order] = np.cumsum(~open_borders(text, order, depth))
    is_core = place <= starts[context] - 1 + SYMBOL - 1
    return context[is_core], place[is_core], classes[at[is_core]]


def repeated_starts(context: np.ndarray, core: np.ndarray, classes: np.ndarray, left: np.ndarray, right: np.ndarray,
                    starts: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Context and start of the strings that occur more than once, from their cores' classes and the bytes around them."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for before in range(SYMBOL):
        start = core - before
        own = np.flatnonzero((start >= 0) & (start < starts[context]))
        if not len(own):
            continue
        rest = np.concatenate([left[own, SYMBOL - before:], right[own, :SYMBOL - before]], axis=1)
        rows = np.column_stack([classes[own].astype(np.uint64), np.ascontiguousarray(rest).view("<u8")])
        names = _named(rows)
        total = np.bincount(names, weights=weight[context[own]])
        again = total[names] > 1
        found.append((context[own[again]], start[own[again]]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _shared(classes: np.ndarray) -> np.ndarray:
    """Which entries' class has others."""
    return np.bincount(classes)[classes] > 1


def compare(lists: list[bytes], length: int) -> list[bytes]:
    """For each list: context number and start of the strings that occur again, for its contexts that occur once."""
    hits: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in lists]
    asked = [load(data) for data in lists]
    _compare_whole([a[1:6] for a in asked], [bool(a[0][0]) for a in asked], hits, length)
    _compare_cores([a[6:13] for a in asked], [bool(a[0][1]) for a in asked], hits)
    answers = []
    for own in hits:
        number = np.concatenate([*(h[0] for h in own), np.zeros(0, np.int64)]).astype("<u4")
        start = np.concatenate([*(h[1] for h in own), np.zeros(0, np.int64)]).astype("<u4")
        order = np.lexsort((start, number))
        answers.append(dump(number[order], start[order]))
    return answers


def _return(context: np.ndarray, start: np.ndarray, source: np.ndarray, number: np.ndarray, weight: np.ndarray, hits: list) -> None:
    single = weight[context] == 1
    context, start = context[single], start[single]
    for s in np.unique(source[context]).tolist():
        own = source[context] == s
        hits[s].append((number[context[own]].astype(np.int64), start[own]))


def _compare_whole(lists: list, present: list[bool], hits: list, length: int) -> None:
    """Groups of one anchor are kept together; transforms are made of as many groups as fit."""
    lists = [(s, x) for s, x in enumerate(lists) if present[s]]
    if not lists:
        return
    number, anchor, starts, weight = (np.concatenate([x[i] for _, x in lists]).astype(np.int64) for i in range(4))
    source = np.repeat([s for s, _ in lists], [len(x[0]) for _, x in lists])
    data = np.concatenate([x[4] for _, x in lists])
    size = starts + length - 1
    begin = np.cumsum(size) - size
    hashes = gram_values(data, begin + anchor)
    order = np.argsort(hashes, kind="stable")
    group = np.concatenate([[0], np.flatnonzero(hashes[order[1:]] != hashes[order[:-1]]) + 1, [len(order)]])
    done, ends = 0, np.cumsum(size[order])
    padded = np.concatenate([np.zeros(SYMBOL, np.uint8), data, np.zeros(SYMBOL, np.uint8)])
    while done < len(order):
        before = ends[done - 1] if done else 0
        fit = np.searchsorted(ends, before + TEXT_BYTES, side="right")
        to = int(group[max(np.searchsorted(group, fit, side="right") - 1, np.searchsorted(group, done, side="right"))])
        own = order[done:to]
        done = to
        if len(own) < 2:
            continue
        context, core, classes = core_classes(data, begin[own], anchor[own], starts[own], length)
        shared = _shared(classes)
        context, core, classes = context[shared], core[shared], classes[shared]
        at = (begin[own][context] + core)[:, None] + np.arange(SYMBOL)
        found, start = repeated_starts(context, core, classes, padded[at], padded[at + length], starts[own], weight[own])
        _return(own[found], start, source, number, weight, hits)


def gram_values(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The anchors' own bytes as a hash; equal anchors have equal ones."""
    with np.errstate(over="ignore"):
        h = np.zeros(len(at), dtype=np.uint64)
        for i in range(GRAM):
            h = h * MULTIPLIER + BYTE_VALUES[data[at + i]]
    return h


def _compare_cores(lists: list, present: list[bool], hits: list) -> None:
    lists = [(s, x) for s, x in enumerate(lists) if present[s]]
    if not lists:
        return
    number, core, starts, weight = (np.concatenate([x[i] for _, x in lists]).astype(np.int64) for i in range(4))
    source = np.repeat([s for s, _ in lists], [len(x[0]) for _, x in lists])
    key = np.concatenate([x[4] for _, x in lists]).reshape(-1, 2)
    left, right = (np.concatenate([x[i] for _, x in lists]).reshape(-1, SYMBOL) for i in (5, 6))
    classes = _named(key)
    shared = np.flatnonzero(_shared(classes))
    found, start = repeated_starts(np.arange(len(shared)), core[shared], classes[shared], left[shared], right[shared], starts[shared], weight[shared])
    _return(shared[found], start, source, number, weight, hits)


def removed_spans(body: bytes, states: dict[int, bytes], hits: dict[int, bytes], length: int) -> tuple[list[bytes], list[np.ndarray]]:
    """The texts of a block, and for each its maximal removed runs as rows (from, to)."""
    sizes, data, place, first, spread, number, h = load(body)
    state = _states(len(h), states) & 3
    whole = (state[number] == REPEATED) | (state[number] == PARTNER)
    begin = first.astype(np.int64)
    runs = [np.column_stack([begin[whole], begin[whole] + spread[whole] + length])]
    one = _representatives(number.astype(np.int64), len(h))
    for data_back in hits.values():
        context, start = load(data_back)
        at = begin[one[context]] + start
        runs.append(np.column_stack([at, at + length]))
    covered = np.zeros(len(data) + 1, dtype=np.int32)
    every = np.concatenate(runs)
    np.add.at(covered, every[:, 0], 1)
    np.add.at(covered, every[:, 1], -1)
    gone = np.cumsum(covered, dtype=np.int32)[:-1] > 0
    ends = np.cumsum(sizes)
    raw, texts, spans = data.tobytes(), [], []
    for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone[a:b], [False]]).astype(np.int8)))
        texts.append(raw[a:b])
        spans.append(edges.reshape(-1, 2))
    return texts, spans


def without(text: bytes, spans: np.ndarray) -> bytes:
    kept, at = [], 0
    for a, b in spans.tolist():
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]])


def remove_repeats(docs: DataFrame, length: int = LENGTH, result: str = "kept", hot: int = HOT, carried: Sequence[Column] = ()) -> DataFrame:
    """Every row of `docs(doc_id, text)` without the bytes of strings of `length` bytes that start anywhere else too.

    The row's key, `doc_id, n_bytes, n_removed, n_spans`, and by `result` the remaining bytes (`kept`), their sha256 (`kept_sha256`) or the text
    they make (`kept_text`, without characters of which a cut left a part). Texts count as UTF-8, null as empty; matches never cross texts, and every one is judged on the input: all copies go, overlapping
    ones too. Repeated ids and rows are texts of their own. Texts shorter than `length` stay as they are. Columns of `docs`
    given as `carried`, under names of their own, follow at the end; others are ignored. No documents give no rows. `length` is a multiple of 16, of 64 at least.
    """
    if length % SYMBOL or length < 2 * GRAM:
        raise ValueError("length has to be a multiple of 16 and 64 at least")
    buckets = blocks.bucket_count(docs)
    wanted = keyed(docs, F.col("doc_id").cast("long").alias("doc_id"), "text", *carried)
    more = docs.select(*carried).dtypes if carried else []

    def make(batch):
        return find_block([(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()], length, buckets)

    held = blocks.build(wanted, make, "passages", BLOCK_BYTES)
    body = held.select("block", "keys", "body")
    states = stored(blocks.exchange(blocks.sent(held), lambda lists, _: classify(lists, hot)), "states", "uncompressed")

    asked = blocks.ask(blocks.answered(body, states), lambda own, answers: send_contexts(own, answers, length, buckets))
    hits = blocks.exchange(asked, lambda lists, _: compare(lists, length))

    def each(keys: pa.Table, body: bytes, states: dict, hits: dict) -> pa.Table:
        texts, spans = removed_spans(body, states, hits, length)
        kept = [without(t, s) for t, s in zip(texts, spans, strict=True)]
        last = [RESULTS[result][1](k) for k in kept]
        return pa.table({
            **{c: keys.column(c).combine_chunks() for c in (*ROW, "doc_id")},
            "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "n_removed": pa.array([int((s[:, 1] - s[:, 0]).sum()) for s in spans], pa.int64()),
            "n_spans": pa.array([len(s) for s in spans], pa.int64()),
            result: pa.array(last, pa.binary() if result == "kept" else pa.string()),
            **{c: keys.column(c).combine_chunks() for c, _ in more},
        })

    schema = f"{ROW[0]} long, {ROW[1]} long, doc_id long, n_bytes long, n_removed long, n_spans long, "
    ends = "".join(f", `{c}` {t}" for c, t in more)
    return blocks.finish(blocks.answered(body, states, hits), each, f"{schema}{result} {RESULTS[result][0]}{ends}")
