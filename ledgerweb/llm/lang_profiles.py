"""Language identification by rank-order n-gram profiles (Cavnar and Trenkle, 1994).

A profile lists the most frequent n-grams of one to three letters, most frequent first. A document's profile is compared
with each language's: an n-gram counts by how far it is out of its place there, and as the profile's length
where it is missing. The language with the smallest sum wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerweb.llm.common import ranges, text_batches, texts_of

PROFILE = 300
SAMPLE = 4000   # labelled documents a language is learned from, about; all where there are fewer
LANGUAGES = 10_000  # languages that may be learned: the driver and every worker hold their profiles
UNDETERMINED = "und"
BATCH_BYTES = 4 << 20
SPACE = 0
BITS = 21  # of a code point


def letter_table() -> np.ndarray:
    """What is known of each code point: 0 not seen yet, 1 a letter, 2 another character."""
    return np.zeros(0x110000, dtype=np.int8)


def letters(text: str, table: np.ndarray) -> np.ndarray:
    """Lower-case code points with every run of other characters as one 0, also at both ends; empty without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if len(points) == 0:
        return points
    kind = table[points]
    if not kind.all():
        for point in np.unique(points[kind == 0]).tolist():
            table[point] = 1 if chr(point).isalpha() else 2
        kind = table[points]
    padded = np.concatenate([[SPACE], np.where(kind == 1, points, SPACE), [SPACE]])
    if not padded.any():
        return padded[:0]
    return padded[np.concatenate([[True], (padded[1:] != SPACE) | (padded[:-1] != SPACE)])]


def grams(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of 1 to 3 characters, packed into 63 bits, and their counts; none of spaces alone."""
    p = points.astype(np.int64) + 1
    shift = np.int64(1 << BITS)
    two = p[:-1] * shift + p[1:]
    three = two[:-1] * shift + p[2:]
    found, counts = np.unique(np.concatenate([p[p > 1], two, three]), return_counts=True)
    return found, counts


def profile(points: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, by falling count, then by rising code."""
    found, counts = grams(points)
    if len(found) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        kept = counts >= least
        found, counts = found[kept], counts[kept]
    return found[np.lexsort((found, -counts))][:size]


def learn(docs: DataFrame, profile_size: int = PROFILE, sample: int = SAMPLE, languages: int = LANGUAGES) -> dict[str, np.ndarray]:
    """Profiles of the languages in `docs(doc_id, text, lang)`; rows without language are left out.

    Fitted on about `sample` documents of each language, chosen by a hash of their id and text (a documented bound:
    the profile is a list of 300 entries). Every language is learned; as the driver and each worker
    hold all profiles, more than `languages` of them raise an error. N-gram counts are summed before they are shuffled.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(languages + 1).collect()
    if len(counts) > languages:
        raise ValueError(f"more than {languages} languages: raise `languages` if the driver and the workers can hold their profiles")
    share = {row["lang"]: min(1.0, sample / row["n"]) for row in counts}
    if not share:
        return {}
    spark = docs.sparkSession
    # One row a language: far fewer than the profiles' entries, which all go to every worker.
    shares = F.broadcast(spark.createDataFrame(list(share.items()), "lang string, share double"))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    chosen = labelled.join(shares, "lang").filter((F.col("share") >= 1) | (draw < F.col("share"))).select("lang", "text")
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letter_table()
        for batch in text_batches(batches, BATCH_BYTES):
            by_lang: dict[str, list] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch), strict=True):
                if len(points := letters(text, table)):
                    by_lang.setdefault(lang, []).append(grams(points))
            for lang, found in by_lang.items():
                codes, where = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                sums = np.bincount(where, weights=np.concatenate([n for _, n in found])).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes)), pa.array(codes), pa.array(sums)], schema=schema)

    counted = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    ranked = counted.withColumn("place", rank).filter(F.col("place") <= profile_size)
    rows = ranked.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "gram")))["gram"].alias("grams")).collect()
    return {row["lang"]: np.array(row["grams"], dtype=np.int64) for row in rows}


class Identifier:
    """Compares documents with all profiles at once."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int):
        self.size, self.names, self.table = size, sorted(profiles), letter_table()
        self.codes = np.unique(np.concatenate([*profiles.values(), np.zeros(0, np.int64)]))
        # The languages that have an n-gram, and its places there, lie side by side: memory follows the profiles' lengths.
        lists = [profiles[name] for name in self.names]
        codes = np.searchsorted(self.codes, np.concatenate([*lists, np.zeros(0, np.int64)]))
        order = np.argsort(codes, kind="stable")
        self.languages = np.repeat(np.arange(len(lists)), [len(a) for a in lists])[order]
        self.places = np.concatenate([*map(np.arange, map(len, lists)), np.zeros(0, np.int64)]).astype(np.int64)[order]
        self.first = np.searchsorted(codes[order], np.arange(len(self.codes) + 1))

    def best(self, text: str | None) -> tuple[str, float]:
        points = letters(text or "", self.table)
        if len(points) == 0 or not self.names:
            return UNDETERMINED, 0.0
        own = profile(points, self.size)
        at = np.searchsorted(self.codes, own)
        rank = np.flatnonzero(np.append(self.codes, -1)[at] == own)
        start = self.first[at[rank]]
        found = self.first[at[rank] + 1] - start
        held = ranges(start, found)
        out_of_place = np.abs(self.places[held] - np.repeat(rank, found))
        # What is missing counts as the profile's length; whole numbers below 2**53 are summed without rounding.
        saved = np.bincount(self.languages[held], weights=self.size - out_of_place, minlength=len(self.names))
        distance = self.size * len(own) - saved.astype(np.int64)
        winner = int(np.argmin(distance))
        return self.names[winner], float(1 - distance[winner] / (self.size * len(own)))


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], columns: list[str] | None = None, profile_size: int = PROFILE) -> DataFrame:
    """`docs`, or some of its `columns`, with `lang_pred` and `score` appended, from the whole of each text and nothing else.

    `score` is 1 minus the distance's share of the largest possible distance. A null text, or one without letters
    (Unicode category L), gives `und` and 0, as does every text where nothing was learned. Languages at equal
    distance: the name that sorts first. Columns of these two names are replaced; all others stay.
    """
    added = ("lang_pred", "score")
    columns = [c for c in columns or docs.columns if c.lower() not in added]
    at = columns.index("text") if "text" in columns else len(columns)
    kept = docs.select(*[F.col(f"`{c}`") for c in columns], *([] if at < len(columns) else ["text"]))
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes if n in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier, last = Identifier(profiles, profile_size), len(columns)
        for batch in text_batches(batches, BATCH_BYTES):
            found = [identifier.best(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:last], pa.array([n for n, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=[*columns, *added])

    return kept.mapInArrow(run, f"{schema}, lang_pred string, score double")

