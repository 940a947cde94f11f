"""Language-model scores from a weighted backoff automaton.

States are the empty history and the sequences of up to `order - 1` tokens that training has. From the state of history h an arc
leads to every word w that followed h, with the smoothed log10 probability of w after h, and on to the longest state that ends the text so
far. For other words a failure arc leads, at the log10 of the mass it is left, to the state of h without its first token, and from there on, at the end to the
empty state, whose arcs carry the unigram probabilities. Counts are smoothed with a Dirichlet prior on the shorter history,
which makes the failure weight the same for all words:

    p(w | h) = (c(hw) + m p(w | h')) / (c(h) + m),   failure weight of h = m / (c(h) + m),   h' = h without its first token

A text is read once from left to right, the state being carried along, and the weights of the arcs taken are added up.

The automaton of the corpus is never in one place: a block of documents asks for the counts of its own n-grams
and holds just the states and arcs that its texts can reach. Orders are asked for one after another. An n-gram whose first or last n - 1
tokens occur once in all documents occurs once itself: its count is known without asking, so only those are sent whose both
parts occur again somewhere.

N-grams are told apart by 64-bit keys, as is usual for large language models: among n distinct ones about
n * n / 2**65 share a key and so their counts.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweb.llm import blocks
from ledgerweb.llm.byte_bpe import planes, unplaned
from ledgerweb.llm.common import dump, load, ranges, texts_of

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
PRIOR = 20.0
ORDER = 3
BLOCK_BYTES = 4 << 20  # of texts; a block's streams, n-grams and keys take some thirty times as much
ADDED = 0.1
START, END = 0, 1  # the first two entries of every word list


def words_of(text: str) -> list[bytes]:
    """Words of a text: A-Z lowered, cut at space, tab, line feed, vertical tab, form feed and carriage return."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split()


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit key of two keys in order."""
    with np.errstate(over="ignore"):
        k = a * np.uint64(0x9E3779B97F4A7C15) ^ (b + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xC2B2AE3D27D4EB4F)
        k ^= k >> np.uint64(29)
        k *= np.uint64(0xBF58476D1CE4E5B9)
        return k ^ (k >> np.uint64(32))


@dataclass
class Listed:
    """A block's texts as places in its list of words: one stream of START, the words and END for each document."""

    words: list[bytes]
    stream: np.ndarray
    lengths: np.ndarray  # tokens with the end


def listed(texts: list[str]) -> Listed:
    numbers: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
    numbers[b""], numbers[b"\n"]  # START and END; neither can be a word
    streams, lengths = [], []
    for text in texts:
        words = words_of(text)
        own = np.empty(len(words) + 2, dtype=np.int64)
        own[0], own[-1] = START, END
        own[1:-1] = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
        streams.append(own)
        lengths.append(len(words) + 1)
    return Listed(list(numbers), np.concatenate(streams), np.array(lengths, dtype=np.int64))


def word_keys(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))


@dataclass
class Grams:
    """The distinct n-grams of one length in a block, by number."""

    at: np.ndarray  # for each place of the stream the n-gram that ends there, -1 where it would begin before its document
    prefix: np.ndarray  # the n-gram one shorter without the last token
    suffix: np.ndarray  # and the one without the first
    word: np.ndarray  # the last token
    keys: np.ndarray
    learned: np.ndarray  # occurrences in the block's training texts
    total: np.ndarray  # occurrences in all of its texts
    counts: np.ndarray  # occurrences in the corpus' training texts, once known
    again: np.ndarray  # whether it occurs twice or more in the corpus, once known


def _grams(at, prefix, suffix, word, keys, learns) -> Grams:
    ends = at >= 0
    learned = np.bincount(at[ends & learns], minlength=len(word))
    return Grams(at, prefix, suffix, word, keys, learned, np.bincount(at[ends], minlength=len(word)), learned, np.zeros(len(word), dtype=bool))


def single(own: Listed, learns: np.ndarray) -> Grams:
    none, size = np.zeros(len(own.words), dtype=np.int64), len(own.words)
    return _grams(own.stream, none, none, np.arange(size), word_keys(own.words), learns)


def longer(short: Grams, words: Grams, learns: np.ndarray) -> Grams:
    """The n-grams of one token more than `short`."""
    stream, size = words.at, len(words.word)
    ends = np.flatnonzero((short.at[:-1] >= 0) & (stream[1:] != START)) + 1
    found, first, number = np.unique(short.at[ends - 1] * size + stream[ends], return_index=True, return_inverse=True)
    at = np.full(len(stream), -1, dtype=np.int64)
    at[ends] = number
    prefix, word = found // size, found % size
    return _grams(at, prefix, short.at[ends[first]], word, mixed(short.keys[prefix], words.keys[word]), learns)


def asked(grams: Grams, short: Grams | None) -> np.ndarray:
    """Numbers of the n-grams whose count isn't known from the shorter ones, by rising key."""
    unknown = np.arange(len(grams.word)) if short is None else np.flatnonzero(short.again[grams.prefix] & short.again[grams.suffix])
    return unknown[np.argsort(grams.keys[unknown])]


def known(body: bytes, answers: tuple[dict[int, bytes], ...], order: int) -> tuple[Listed, list[Grams]]:
    """The block's n-grams up to `order`, those answered with their counts."""
    own, trained = unlisted(body)
    learns = np.repeat(trained, own.lengths + 1)
    levels: list[Grams] = []
    for n in range(order):
        grams = single(own, learns) if n == 0 else longer(levels[-1], levels[0], learns)
        if n < len(answers):
            unknown = asked(grams, levels[-1] if levels else None)
            told = [_unoctets(load(answers[n][bucket])[1:]) for bucket in sorted(answers[n])]
            values = np.concatenate(told).astype(np.int64) if told else np.empty(0, dtype=np.int64)
            grams.counts = grams.learned.copy()
            grams.counts[unknown], grams.again[unknown] = values >> 1, (values & 1).astype(bool)
        levels.append(grams)
    return own, levels


def steps(keys: np.ndarray) -> np.ndarray:
    """Differences of rising keys, which have fewer bytes than the keys."""
    return np.diff(keys, prepend=np.uint64(0))


def list_block(texts: list[str], trained: np.ndarray) -> tuple[bytes, dict[int, bytes], int]:
    """Body: lengths, which documents train, words and stream. Nothing by bucket yet. Number of training tokens."""
    own = listed(texts)
    body = dump(own.lengths, trained.astype(np.uint8), np.frombuffer(b" ".join(own.words[2:]), np.uint8), *planes(own.stream), level=3)
    return body, {}, int(own.lengths[trained].sum())


def unlisted(body: bytes) -> tuple[Listed, np.ndarray]:
    lengths, trained, joined, *rows = load(body)
    words = [b"", b"\n", *joined.tobytes().split()]
    return Listed(words, unplaned(rows).astype(np.int64), lengths), trained.astype(bool)


def count_block(body: bytes, answers: tuple[dict[int, bytes], ...], buckets: int) -> dict[int, bytes]:
    """By bucket, the keys' highest part: keys and counts of the n-grams one longer than those answered."""
    _, levels = known(body, answers, len(answers) + 1)
    grams = levels[-1]
    unknown = asked(grams, levels[-2] if len(levels) > 1 else None)
    keys, learned, others = grams.keys[unknown], grams.learned[unknown], (grams.total - grams.learned)[unknown]
    bucket = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    first = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    return {b: dump(*_octets(steps(keys[at:to])), *planes(learned[at:to]), *planes(others[at:to]))
            for b, (at, to) in enumerate(itertools.pairwise(first.tolist())) if at < to}


def _octets(numbers: np.ndarray) -> list[np.ndarray]:
    """The eight byte planes of 64-bit numbers."""
    return [np.ascontiguousarray(row) for row in np.ascontiguousarray(numbers, dtype="<u8").view(np.uint8).reshape(-1, 8).T]


def _unoctets(rows: list[np.ndarray]) -> np.ndarray:
    return np.ascontiguousarray(np.stack(rows).T).view("<u8").reshape(-1)


def merge_counts(lists: list[bytes]) -> list[bytes]:
    """For each list its n-grams' corpus counts in training, doubled, plus one where the corpus has it twice; also how many words of this bucket training has."""
    start = word_keys([b""])[0]
    lines = [load(data) for data in lists]
    keys = [np.cumsum(_unoctets(own[:8]), dtype=np.uint64) for own in lines]
    found, where = np.unique(np.concatenate(keys), return_inverse=True)
    learned, others = (np.bincount(where, weights=np.concatenate([unplaned(own[i:i + 4]) for own in lines]), minlength=len(found)).astype(np.int64)
                       for i in (8, 12))
    told = learned * 2 + (learned + others > 1)
    words = np.array([((learned > 0) & (found != start)).sum()])
    ends = np.cumsum([len(own) for own in keys])
    return [dump(words, *_octets(told[where[end - len(own):end]])) for own, end in zip(keys, ends, strict=True)]


@dataclass
class Automaton:
    """What a block's texts can reach. A state is named by the place where its tokens end and their number; 0 is the empty history."""

    weight: np.ndarray  # by state length and place: the arc from the state before that place on the place's token, nan without one
    failure: np.ndarray  # by state length and place: the failure arc of the state that ends there
    known: np.ndarray  # by place: whether its token is a state itself
    longest: int


def automaton(levels: list[Grams], total: int, distinct: int, prior: float) -> Automaton:
    order, places = len(levels), len(levels[0].at)
    weight, failure = np.full((order, places), np.nan), np.zeros((order, places))
    shorter = (levels[0].counts + ADDED) / (total + ADDED * (distinct + 1))
    for n, grams in enumerate(levels):
        if n:
            shorter = (grams.counts + prior * shorter[grams.suffix]) / (levels[n - 1].counts[grams.prefix] + prior)
        there = grams.at >= 0
        weight[n, there] = np.log10(np.where((grams.counts > 0) | (n == 0), shorter, np.nan))[grams.at[there]]
        if n < order - 1:
            failure[n + 1, there] = np.log10(prior / (grams.counts + prior))[grams.at[there]]
    return Automaton(weight, failure, levels[0].counts[levels[0].at] > 0, order - 1)


SEGMENT = 512  # tokens that are read one after another; a text's segments are read side by side


def traverse(model: Automaton, stream: np.ndarray, lengths: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """The log10 probability of every token but START. Texts are read from left to right, a token of each at a time.

    A segment within a text starts from the empty state, as many tokens earlier as a state can have: it then has the text's own.
    """
    segment = max(segment, model.longest + 1)
    begins = np.cumsum(lengths + 1) - lengths - 1  # places of START
    pieces = -(-lengths // segment)
    text = np.repeat(np.arange(len(lengths)), pieces)
    cut = ranges(np.zeros(len(lengths), dtype=np.int64), pieces) * segment
    at = begins[text] + cut + 1 - np.where(cut > 0, model.longest, 0)
    end = begins[text] + 1 + np.minimum(cut + segment, lengths[text])
    state = np.where(cut > 0, 0, model.known[at - 1] & (model.longest > 0)).astype(np.int64)
    counted = begins[text] + cut + 1
    order = np.argsort(at - end, kind="stable")  # the longest first, so that those still read are the first ones
    at, end, state, counted = at[order], end[order], state[order], counted[order]
    left = end - at
    out = np.empty(len(stream))
    for _ in range(int(left[0]) if len(left) else 0):
        reading = int(np.searchsorted(-left, 0))
        at, state, counted, left = at[:reading], state[:reading], counted[:reading], left[:reading]
        cost = np.zeros(reading)
        for n in range(model.longest, 0, -1):
            fails = np.flatnonzero((state == n) & np.isnan(model.weight[n, at]))
            cost[fails] += model.failure[n, at[fails] - 1]
            state[fails] = n - 1
        cost += model.weight[state, at]
        own = at >= counted
        out[at[own]] = cost[own]
        state = np.where(model.known[at], np.minimum(state + 1, model.longest), 0)
        at, left = at + 1, left - 1
    return out[stream != START]


def score_block(keys: pa.Table, body: bytes, answers: tuple[dict[int, bytes], ...], total: int, distinct: int, prior: float) -> pa.Table:
    own, levels = known(body, answers, len(answers))
    stream, lengths, counts = own.stream, own.lengths, levels[0].counts
    step = traverse(automaton(levels, total, distinct, prior), stream, lengths)
    read = stream[stream != START]
    base = np.log10((counts + ADDED) / (total + ADDED * (distinct + 1)))
    first = np.cumsum(lengths) - lengths
    return pa.table({
        "doc_id": keys.column("doc_id").combine_chunks(), "held_out": keys.column("held_out").combine_chunks(),
        "n_tokens": pa.array(lengths, pa.int64()),
        "n_known": pa.array(np.add.reduceat((counts[read] > 0).astype(np.int64), first), pa.int64()),
        "train_tokens": pa.array(np.full(len(lengths), total), pa.int64()),
        "base_score": pa.array(np.add.reduceat(base[read], first)),
        "score": pa.array(np.add.reduceat(step, first)),
    })


def score(docs: DataFrame, held_out: str = "held_out", prior: float = PRIOR, order: int = ORDER) -> DataFrame:
    """Learn from the rows of `docs(doc_id, text, held_out)` where `held_out` is false, and score all by n-grams up to `order`.

    `doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`, log10 probabilities of whole texts with their
    end token. Null texts count as empty: one token, the end. Rows with null in `held_out` count as held out. Repeated ids and rows
    give a row each and count each in training; other columns are ignored. No documents give no rows; without
    training documents, or with an order of 1, every state is the empty one and score equals base_score.
    """
    if order < 1:
        raise ValueError("the order is 1 or more")
    buckets = 2 * blocks.bucket_count(docs)  # n-grams are many; a bucket's are sorted in one task
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                         F.coalesce(F.col(held_out), F.lit(True)).alias("held_out"))

    def make(batch):
        trained = ~batch.column("held_out").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
        return list_block(texts_of(batch), trained)

    held = blocks.build(wanted, make, "tokens", BLOCK_BYTES)
    total = held.agg(F.sum("n")).first()[0] or 0
    held, distinct = held.select("block", "keys", "body"), 0
    for n in range(order):
        # The lists are larger than the blocks, so they are made on their way and not stored.
        lists = blocks.ask(held, lambda body, *answers: count_block(body, answers, buckets))
        replies = blocks.replies(blocks.exchange(lists, lambda data, _: merge_counts(data)), f"answers_{n}")
        if n == 0:
            distinct = _distinct(replies)
        held = held.join(replies, "block", "left")
    return blocks.finish(
        held, lambda keys, body, *answers: score_block(keys, body, answers, total, distinct, prior),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def _distinct(replies: DataFrame) -> int:
    """Distinct training tokens: every answer of a bucket names the bucket's own number."""
    def run(batches):
        for batch in batches:
            words = [int(load(d)[0][0]) for d in batch.column("data").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("bucket"), pa.array(words, pa.int64())], names=["bucket", "words"])

    told = replies.select(F.inline("answers_0")).mapInArrow(run, "bucket int, words long")
    return told.distinct().agg(F.sum("words")).first()[0] or 0
