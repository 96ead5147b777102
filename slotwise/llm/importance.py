"""Importance resampling towards a target: gains of hashed n-gram buckets, summed and drawn with Gumbel noise."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from tokenizers import PreTokenizedString, Regex, pre_tokenizers

from slotwise.llm.simhash import LOWER
from slotwise.llm.staging import staged

#: What is a word after A-Z are lower-cased, and the ASCII characters that part words.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
LONGEST = 3  # words of a feature
BUCKETS = 10_000
MIN_WORDS = 20
SEED = 42
#: Bytes of text that are pre-tokenised at once, features of a batch of rows, rows of a task that ranks.
SLICE, BATCH_FEATURES, RANK_ROWS = 4096, 1 << 20, 1_000_000


def slices(low: bytes, size: int = SLICE) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of parts of about ``size`` bytes that end behind a character between words, or at the end."""
    start = 0
    while start < len(low):
        gap = GAP.search(low, start + size)
        stop = gap.end() if gap else len(low)
        yield start, low[start:stop]
        start = stop


class Words:
    """The untrained pre-tokeniser: words of lower-cased text with their byte offsets."""

    def __init__(self) -> None:
        self._split = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)

    def __call__(self, low: bytes) -> Iterator[tuple[int, list[str], list[tuple[int, int]]]]:
        """(start, words, offsets) slice by slice; the offset pairs are first and end byte from ``start`` in ``low``."""
        for start, part in slices(low):
            text = PreTokenizedString(part.decode("utf-8", "replace"))
            self._split.pre_tokenize(text)
            found = text.get_splits(offset_referential="original", offset_type="byte")
            if found:
                yield start, [word for word, _, _ in found], [pair for _, pair, _ in found]


def windows(offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of ``n`` words begin and end, from the offset pairs of the words."""
    count = max(0, len(offsets) - n + 1)
    return offsets[:count, 0], offsets[n - 1 :, 1][:count]


def _checksums(words: list[str], longest: int) -> Iterator[list[int]]:
    """The CRC of every run of 1, 2 ... ``longest`` words, joined by one space; a run's goes on from that of one word less."""
    joined = " ".join(words).encode()
    ends = np.cumsum([len(w) + 1 for w in joined.split(b" ")]) - 1
    pairs = np.stack([np.concatenate([[0], ends[:-1] + 1]), ends], 1)
    first, end = (x.tolist() for x in windows(pairs, 1))
    sums = [zlib.crc32(joined[a:b]) for a, b in zip(first, end, strict=True)]
    yield sums
    last = [joined[a:b] for a, b in zip(end[:-1], end[1:], strict=True)]  # a space and the word
    for length in range(2, longest + 1):
        sums = list(map(zlib.crc32, last[length - 2 :], sums))
        yield sums


def bucket_runs(text: bytes | None, words: Words, longest: int = LONGEST, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of every run of 1 to ``longest`` words of the whole text."""
    n, found, before = 0, [], []
    for _, new, _ in words((text or b"").translate(LOWER)):
        n += len(new)
        run = before + new
        for length, sums in enumerate(_checksums(run, longest), 1):
            # runs within the words carried over were counted with the slice before
            found += sums[max(0, len(before) - length + 1) :]
        before = run[len(run) - min(len(run), longest - 1) :]
    return n, (np.array(found, np.int64) % buckets).astype(np.int32)


def bucketed(docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, features array<int>, counts array<bigint>), staged.

    A row for each row of ``docs`` with the bucket of every feature, and a row a
    task that holds nothing but the counts of its buckets. So texts are
    pre-tokenised once and the histogram needs no second pass over the features.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words bigint, features array<int>, counts array<bigint>"

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        words, counts, ids_type = Words(), np.zeros(buckets, np.int64), None

        def rows(ids: pa.Array, n_words: list[int], features: list[np.ndarray]) -> pa.RecordBatch:
            ends = np.concatenate([[0], np.cumsum([len(x) for x in features])]).astype(np.int32)
            flat = pa.array(np.concatenate(features), pa.int32())
            nothing = pa.nulls(len(ids), pa.list_(pa.int64()))
            columns = [ids, pa.array(n_words, pa.int64()), pa.ListArray.from_arrays(ends, flat), nothing]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "features", "counts"])

        for batch in batches:
            ids, ids_type = batch.column("doc_id"), batch.column("doc_id").type
            n_words, features, first = [], [], 0
            for i, text in enumerate(batch.column("text")):
                n, found = bucket_runs(text.as_py(), words, longest, buckets)
                counts += np.bincount(found, minlength=buckets)
                n_words.append(n)
                features.append(found)
                if sum(map(len, features)) >= BATCH_FEATURES:
                    yield rows(ids.slice(first, len(n_words)), n_words, features)
                    n_words, features, first = [], [], i + 1
            if n_words:
                yield rows(ids.slice(first, len(n_words)), n_words, features)
        if ids_type is not None:
            own = [pa.nulls(1, ids_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int32())), pa.array([counts])]
            yield pa.RecordBatch.from_arrays(own, ["doc_id", "n_words", "features", "counts"])

    columns = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return staged(columns.mapInArrow(of_batches, schema))


def histogram(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The number of features in each bucket, from the counts of ``bucketed``: ``buckets`` numbers on the driver."""
    each = found.where("counts is not null").select(F.posexplode("counts").alias("bucket", "n"))
    out = np.zeros(buckets, np.int64)
    for row in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: Sequence[int], target: Sequence[int]) -> list[int]:
    """Thousandths of the log ratio of the smoothed shares of each bucket in target and source, floored."""
    buckets, all_source, all_target = len(source), float(sum(source)), float(sum(target))
    return [
        math.floor(1000 * math.log((t + 1.0) * (all_source + buckets) / ((s + 1.0) * (all_target + buckets))))
        for s, t in zip(map(int, source), map(int, target), strict=True)
    ]


def _weighed(found: DataFrame, gain: list[int]) -> DataFrame:
    """The documents of ``bucketed`` with n_features and the sum of their features' gains."""
    kind = found.schema["doc_id"].dataType.simpleString()
    table = np.array(gain, np.int64)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            features = batch.column("features")
            ends = features.offsets.to_numpy().astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(table[features.values.to_numpy()[: ends[-1]]])])
            own = [np.diff(ends), sums[ends[1:]] - sums[ends[:-1]]]
            columns = [batch.column("doc_id"), batch.column("n_words"), *(pa.array(x, pa.int64()) for x in own)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    docs = found.where("counts is null").select("doc_id", "n_words", "features")
    return docs.mapInArrow(of_batches, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def ranked(rows: DataFrame, order: Sequence, task_rows: int = RANK_ROWS) -> DataFrame:
    """``rows`` with ``rank``, 1, 2, 3 ... in ``order``, without a task that sees them all.

    The rows are range-partitioned, sorted and staged with their place in the
    partition; the partitions' counts, a row each, are added up.
    """
    parts = rows.count() // task_rows + 1
    sorted_ = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = staged(sorted_.withColumn("_row", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftrightunsigned("_row", 33))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    sizes = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.join(sizes, "_part").withColumn("rank", rank).drop("_row", "_part", "_before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    min_words: int = MIN_WORDS,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) per row of ``docs``: how like ``target`` it is, and whether drawn.

    Features are all runs of 1 to ``longest`` words, counted in ``buckets`` by
    the checksum of their bytes; a bucket's gain compares its share in all texts
    of ``target`` (text) with that in all of ``docs`` (doc_id, text). ``score`` is
    the sum of a document's gains plus Gumbel noise that follows from
    ``seed`` and doc_id, so the highest scores are a sample without replacement.
    Of the N documents of ``min_words`` words, floor(``percent`` * N / 100) are
    drawn: ``rank`` counts them by score, ties to the smaller doc_id; it is null for all
    others. A null or empty text has no features and weight 0. A null doc_id draws its
    noise as an empty one and comes last among ties. Rows that repeat a
    doc_id are documents of their own, in a fixed order. Empty tables
    give an empty one, or gains against nothing. Other columns are not read.
    """
    found = bucketed(docs, longest, buckets)
    aim = bucketed(target.select(F.lit(0).alias("doc_id"), "text"), longest, buckets)
    weighed = _weighed(found, gains(histogram(found, buckets), histogram(aim, buckets)))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)
    noise = F.floor(-1000 * F.log(-F.log(uniform)))
    scored = staged(weighed.withColumn("score", F.col("weight") + noise))
    able = scored.where(F.col("n_words") >= min_words)
    drawn = able.count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    placed = ranked(able, order).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return placed.unionByName(scored.where(F.col("n_words") < min_words), allowMissingColumns=True)
