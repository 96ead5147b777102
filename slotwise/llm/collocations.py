"""Phrase collocations: n-grams counted in the distinct chunks of a prefix-free parse, scored by their weakest cut."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.llm.staging import staged

LONGEST = 4  # words of a phrase
MIN_COUNT = 30
TOP = 2000
#: A longer candidate with this many per cent of a candidate's count takes its place.
COVER_PERCENT = 80
#: Tokens that two chunks share; one in TRIGGER runs of that many ends a chunk, and MAX_CHUNK tokens do without one.
OVERLAP, TRIGGER, MAX_CHUNK = LONGEST - 1, 32, 1024
#: Stands between two pieces; no word holds it.
BREAK = b"."
#: Bytes of text parsed at once, chunks or runs a task holds before it hands them on, bits of the filters.
SLICE, HELD, FILTER_BITS = 1 << 20, 1_000_000, 1 << 27
TOP_ROWS = 100_000

#: A-Z become a-z; what parts pieces becomes a break, what parts words a space.
PIECES = bytes(c + 32 if 65 <= c <= 90 else BREAK[0] if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c in (9, 32) else c for c in range(256))
#: An odd base of polynomial hashes modulo 2^64, its inverse, and a multiplier that mixes them.
_BASE = 0x9E3779B97F4A7C15
_INVERSE, _MIX = pow(_BASE, -1, 1 << 64), np.uint64(0xBF58476D1CE4E5B9)


class Tokens:
    """Tokens joined by single spaces: where each starts and ends, and a hash of any run of them."""

    def __init__(self, data: bytes):
        raw = np.frombuffer(data, np.uint8)
        gaps = np.flatnonzero(raw == 32)
        self.starts = np.concatenate([[0], gaps + 1]) if len(data) else np.zeros(0, np.int64)
        self.ends = np.concatenate([gaps, [len(data)]]) if len(data) else np.zeros(0, np.int64)
        self.breaks = (self.ends - self.starts == 1) & (raw[self.starts] == BREAK[0])
        self._raw = raw

    def run_hashes(self, n: int, seeds: np.ndarray | int = 0) -> np.ndarray:
        """A hash of the bytes of each run of ``n`` tokens, and of a seed each."""
        count = max(0, len(self.starts) - n + 1)
        with np.errstate(over="ignore"):
            sums = np.concatenate([[np.uint64(0)], np.cumsum((self._raw + np.uint64(1)) * _powers(_BASE, len(self._raw)))])
            first, end = self.starts[:count], self.ends[n - 1 :][:count]
            total = (sums[end] - sums[first]) * _powers(_INVERSE, len(self._raw))[first]
            total ^= seeds[:count] if isinstance(seeds, np.ndarray) else np.uint64(seeds)
            for shift in (32, 29):
                total = (total ^ (total >> np.uint64(shift))) * _MIX
        return total ^ (total >> np.uint64(31))


_KNOWN_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2^64."""
    known = _KNOWN_POWERS.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, SLICE), base, np.uint64)
        steps[0] = 1
        known = _KNOWN_POWERS[base] = np.cumprod(steps)
    return known[:n]


def tokens_of(text: bytes | None, size: int = SLICE) -> Iterator[list[bytes]]:
    """Lower-cased words and ``BREAK`` between pieces, in lists of about ``size`` bytes of text."""
    low, start = (text or b"").translate(PIECES), 0
    while start < len(low):
        stop = min((at for at in (low.find(b" ", start + size), low.find(BREAK, start + size)) if at >= 0), default=len(low))
        yield low[start:stop].replace(BREAK, b" " + BREAK + b" ").split()
        start = stop


def chunks(text: bytes | None, size: int = SLICE) -> Iterator[tuple[bytes, int]]:
    """The prefix-free parse of a text: (tokens joined by spaces, how many of them it owns).

    A run of ``OVERLAP`` tokens whose hash is divided by ``TRIGGER`` begins a
    chunk, and the chunk before ends with that run. So equal passages are parsed
    into equal chunks wherever they stand. A chunk owns its tokens up to the
    run that the next one begins with: an n-gram of up to ``OVERLAP`` + 1 tokens
    lies whole in the one chunk that owns its first token.
    """
    held = b""
    for new in tokens_of(text, size):
        held = b" ".join([held, *new] if held else new)
        tokens = Tokens(held)
        starts, ends, first = tokens.starts.tolist(), tokens.ends.tolist(), 0
        for at in [*np.flatnonzero(tokens.run_hashes(OVERLAP) % np.uint64(TRIGGER) == 0).tolist(), None]:
            # without a trigger in reach a chunk ends after MAX_CHUNK tokens
            while (len(starts) - OVERLAP if at is None else at) - first > MAX_CHUNK:
                yield held[starts[first] : ends[first + MAX_CHUNK + OVERLAP - 1]], MAX_CHUNK
                first += MAX_CHUNK
            if at is not None and at > first:
                yield held[starts[first] : ends[at + OVERLAP - 1]], at - first
                first = at
        held = held[starts[first] :] if starts else b""
    if held:
        yield held, held.count(b" ") + 1


class _Counter(dict):
    """Counts by key, handed on as (columns of the keys, counts) when many are held."""

    def __missing__(self, key) -> int:
        return 0

    def batch(self, names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
        columns = [pa.array(x, kind) for x, kind in zip(zip(*self, strict=True), kinds, strict=True)]
        out = pa.RecordBatch.from_arrays([*columns, pa.array(self.values(), pa.int64())], [*names, "n"])
        self.clear()
        return out


def parse(docs: DataFrame) -> DataFrame:
    """(lang, chunk, owned, n): the dictionary of distinct chunks of ``docs`` (text, lang) and how often each is used, staged."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held = _Counter()
        form = ["lang", "chunk", "owned"], [pa.string(), pa.binary(), pa.int32()]
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                for chunk, owned in chunks(text.as_py()):
                    held[lang, chunk, owned] += 1
                    if len(held) >= HELD // 10:
                        yield held.batch(*form)
        if held:
            yield held.batch(*form)

    columns = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    used = columns.mapInArrow(of_batches, "lang string, chunk binary, owned int, n bigint")
    return staged(used.groupBy("lang", "chunk", "owned").agg(F.sum("n").alias("n")))


def _count(dictionary: DataFrame, lengths: tuple[int, ...], known: np.ndarray | None) -> DataFrame:
    """(lang, phrase, f): how often each run of ``lengths`` words occurs in the texts of the ``dictionary``.

    ``known`` is a filter over the runs of one word less than the first of
    ``lengths`` that reach the least count. Runs that contain another are not counted, as
    they cannot reach it.
    """
    sent = dictionary.sparkSession.sparkContext.broadcast(known)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held += _runs(batch, lengths, sent.value)
                rows = sum(x.num_rows for x in held)
            if rows >= HELD:
                yield from _summed(held)
                held, rows = [], 0
        if held:
            yield from _summed(held)

    found = dictionary.mapInArrow(of_batches, "lang string, phrase binary, n bigint")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def _summed(parts: list[pa.Table]) -> list[pa.RecordBatch]:
    found = pa.concat_tables(parts).group_by(["lang", "phrase"]).aggregate([("n", "sum")])
    return found.select(["lang", "phrase", "n_sum"]).rename_columns(["lang", "phrase", "n"]).to_batches(max_chunksize=100_000)


def _runs(batch: pa.RecordBatch, lengths: tuple[int, ...], known: np.ndarray | None) -> list[pa.Table]:
    """(lang, phrase, n) for the runs that the chunks of a batch own; of those that have all their shorter runs in ``known``."""
    parts = batch.column("chunk").to_pylist()
    data = (b" " + BREAK + b" ").join(parts)  # so that no run spans two chunks
    tokens = Tokens(data)
    sizes = np.fromiter((x.count(b" ") + 2 for x in parts), np.int64, len(parts))
    row = np.repeat(np.arange(len(parts)), sizes)[: len(tokens.starts)]
    owned = np.arange(len(row)) < (np.cumsum(sizes) - sizes + batch.column("owned").to_numpy())[row]
    if known is not None:
        langs = batch.column("lang").dictionary_encode()
        seeds = np.array([_seed(x) for x in langs.dictionary.to_pylist()], np.uint64)[langs.indices.to_numpy()]
        seen = _has(known, tokens.run_hashes(lengths[0] - 1, seeds[row]))
    out = []
    for n in lengths:
        last = max(0, len(row) - n + 1)
        wanted = owned[:last].copy()
        for k in range(n):
            wanted &= ~tokens.breaks[k : k + last]
        if known is not None:
            for k in range(n - lengths[0] + 2):
                wanted &= seen[k : k + last]
        at = np.flatnonzero(wanted)
        phrases = [data[a:b] for a, b in zip(tokens.starts[at].tolist(), tokens.ends[at + n - 1].tolist(), strict=True)]
        of = pa.array(row[at])
        out.append(pa.table([batch.column("lang").take(of), pa.array(phrases, pa.binary()), batch.column("n").take(of)], ["lang", "phrase", "n"]))
    return out


def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "big")


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(FILTER_BITS)).astype(np.int64)


def _has(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = _slots(hashes)
    return (known[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _filter(frequent: DataFrame) -> np.ndarray:
    """A bit for the hash of every phrase of ``frequent`` (lang, phrase), all of one length; ``FILTER_BITS`` whatever their number.

    Without false negatives; a full one only lets more runs be counted. The
    bits are put together on the executors, and the driver gets the pages.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            phrases, langs = batch.column("phrase").to_pylist(), batch.column("lang").dictionary_encode()
            if phrases:
                n = phrases[0].count(b" ") + 1
                seeds = np.array([_seed(x) for x in langs.dictionary.to_pylist()], np.uint64)[langs.indices.to_numpy()]
                tokens = Tokens((b" " + BREAK + b" ").join(phrases))
                found = tokens.run_hashes(n, np.repeat(seeds, n + 1))[:: n + 1]
                # Spark's pages have 32768 bits and begin with slot 1
                yield pa.RecordBatch.from_arrays([pa.array(_slots(found) + 1)], ["slot"])

    slots = frequent.select("lang", "phrase").mapInArrow(of_batches, "slot bigint")
    pages = slots.groupBy(F.bitmap_bucket_number("slot").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in pages.collect():  # FILTER_BITS / 32768 rows at most
        start = (row["page"] - 1) * 4096
        out[start : start + 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return out


def frequencies(dictionary: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all runs that occur ``min_count`` times, and (lang, n) with all words, both staged.

    Words are counted first, then the pairs of frequent words, then all longer
    runs of frequent pairs: three passes over the dictionary.
    """
    single = staged(_count(dictionary, (1,), None))
    totals = staged(single.groupBy("lang").agg(F.sum("f").alias("n")))
    level = single.where(F.col("f") >= min_count)
    out = level
    for lengths in [(2,), tuple(range(3, longest + 1))]:
        if lengths:
            level = staged(_count(dictionary, lengths, _filter(level)).where(F.col("f") >= min_count))
            out = out.unionByName(level)
    phrase = F.col("phrase").cast("string")
    return out.select("lang", phrase.alias("phrase"), F.size(F.split(phrase, " ")).alias("words"), "f"), totals


def _part(first: Column | int, count: Column | int) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, count), " ")


def _scored(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of the candidates, by their lowest cut, the first among equals."""
    candidates = frequent.where("words > 1").withColumnRenamed("f", "a")
    cuts = candidates.withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
    cuts = cuts.withColumns({"left": _part(F.lit(1), F.col("k")), "right": _part(F.col("k") + 1, F.col("words") - F.col("k"))})
    known = frequent.select(F.col("lang").alias("of"), F.col("phrase").alias("part"), "f")
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known, (F.col("lang") == F.col("of")) & (F.col(side) == F.col("part"))).withColumnRenamed("f", name).drop("of", "part", side)
    # counts of 19 digits times 2000000 pass 64 bits
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + r)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    best = cuts.groupBy("lang", "phrase", "words", "a").agg(lowest)
    return best.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def _uncovered(scored: DataFrame, frequent: DataFrame, percent: int) -> DataFrame:
    """The candidates that no longer candidate with ``percent`` of their count contains."""
    inner = frequent.where("words > 2").withColumn("size", F.explode(F.expr("sequence(2, words - 1)")))
    inner = inner.withColumn("at", F.explode(F.expr("sequence(1, words - size + 1)")))
    largest = inner.groupBy("lang", _part(F.col("at"), F.col("size")).alias("phrase")).agg(F.max("f").alias("longer"))
    both = scored.join(largest, ["lang", "phrase"], "left")
    exact = lambda name, factor: F.col(name).cast("decimal(20,0)") * factor
    covered = exact("longer", 100) >= exact("a", percent)
    return both.where(~F.coalesce(covered, F.lit(False))).drop("longer")


def collocations(
    docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, top: int = TOP, cover_percent: int = COVER_PERCENT
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the strongest phrases of each language of ``docs`` (text, lang).

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and
    those into words at spaces and tabs. A candidate is a run of 2 to ``longest``
    words within a piece that occurs ``min_count`` times; ``a`` is its count, ``l``
    and ``r`` are those of the two parts of the cut with the lowest
    score, floor(2000000 a / (l + r)), and ``n`` counts all words of the language.
    Candidates within a longer one that has ``cover_percent`` of their count are
    dropped, whether that one is or not. The ``top`` of the rest by score, count and phrase are
    ranked from 1. A null text is empty, a null language is "und". Rows are
    texts: repeated ones count again, ids are not read, nor are other columns.
    An empty table gives an empty one.

    Counts are exact. Copies of a passage are parsed into the same chunks and
    counted once, with a weight; a frequent phrase or language is one row a task
    in each aggregate.
    """
    if not 2 <= longest <= OVERLAP + 1:
        raise ValueError(f"phrases may have 2 to {OVERLAP + 1} words")
    dictionary = parse(docs)
    frequent, totals = frequencies(dictionary, longest, min_count)
    frequent = staged(frequent)
    left = staged(_uncovered(_scored(frequent), frequent, cover_percent))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salts = left.count() // TOP_ROWS + 1
    salt = F.pmod(F.xxhash64("phrase"), F.lit(salts))
    first = left.withColumn("salt", salt).withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order)))
    best = first.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)))
    best = best.where(F.col("rank") <= top).join(totals, "lang")
    return best.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
