"""Removal of passages repeated across documents, by level-wise doubling of repeated windows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.staging import fresh, staged

WINDOW = 50
_M1, _M2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F  # odd, as they are inverted modulo 2**64
_WORD = 2**64


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    done, step = 1, np.uint64(base % _WORD)
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * step
        done, step = done + more, step * step
    return out[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over the word (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Windows:
    """Hashes of all windows of a text's words."""

    def __init__(self, text: bytes | None):
        self.words = (text or b"").split()
        n = len(self.words)
        one = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, n)
        self.hashes = one, _mixed(one + np.uint64(_M2))

    def sums(self, length: int, which: int = 0) -> np.ndarray:
        """64 bits for each window of ``length`` words; both ``which`` together are 128 bits."""
        n, base = len(self.words), (_M1, _M2)[which]
        if n < length:
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(self.hashes[which] * _powers(base, n), out=total[1:])
            back = _powers(pow(base, -1, _WORD), n - length + 1)
            return _mixed((total[length:] - total[:-length]) * back)


def _running(f, x: np.ndarray, span: int) -> np.ndarray:
    """``f`` over every ``span`` consecutive values, for ``f`` minimum or maximum."""
    done = 1
    while done < span:
        more = min(done, span - done)
        x = f(x[: len(x) - more], x[more:])
        done += more
    return x


def anchors(hashes: np.ndarray, span: int) -> np.ndarray:
    """Places of the smallest of every ``span`` consecutive hashes (winnowing); equal ones all count."""
    n = len(hashes)
    if n < span:
        return np.zeros(0, np.int64)
    least = _running(np.minimum, hashes, span)
    pad = np.zeros(span - 1, np.uint64)
    return np.flatnonzero(_running(np.maximum, np.concatenate([pad, least, pad]), span) == hashes)


def _covered(places: np.ndarray, before: int, n: int) -> np.ndarray:
    """Which of 0 ... n-1 lie in one of [place - before, place]."""
    edge = np.zeros(n + 1, np.int32)
    places = np.asarray(places, np.int64)
    np.add.at(edge, np.maximum(places - before, 0), 1)
    np.add.at(edge, np.minimum(places, n - 1) + 1, -1)
    return np.cumsum(edge[:n]) > 0


def _binary(docs: DataFrame) -> DataFrame:
    """doc_id, text in bytes, and its hash, which tells rows of one doc_id apart."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))


def _sketches(docs: DataFrame, window: int) -> DataFrame:
    """Per row: doc_id, text_hash, digest of the whole text, n_words, and its anchors at half the window (hash, place)."""
    half = (window + 1) // 2

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                found = Windows(text)
                sums = found.sums(half)
                at = anchors(sums, window - half + 1)
                rows.append((len(found.words), sums[at].view(np.int64), at.astype(np.int32)))
            yield batch[["doc_id", "text_hash", "digest"]].assign(
                **{name: pd.Series([r[i] for r in rows], dtype=object) for i, name in enumerate(["n_words", "sums", "places"])}
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = _binary(docs).withColumn("digest", F.md5("text"))
    return rows.mapInPandas(
        sketch,
        f"doc_id {kind}, text_hash bigint, digest string, n_words bigint, sums array<bigint>, places array<int>",
    )


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The ``rows`` whose ``keys`` are in several doc_ids, with the smallest of these as first_id.

    Documents are counted before the shuffle; the join back to the rows, where a
    passage of very many documents is one key, is split by the adaptive planner.
    """
    groups = rows.groupBy(*keys).agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    return rows.join(groups.where("first_id <> last_id").drop("last_id"), keys)


def _per_row(rows: DataFrame) -> DataFrame:
    return rows.groupBy("doc_id", "text_hash").agg(F.collect_list("place").alias("places"))


def _windows(texts: DataFrame, length: int, first: bool) -> DataFrame:
    """128-bit hashes and places of the candidate windows of ``length`` words.

    ``texts`` has the text and the places that were shared at half the length:
    anchors in the first round, whole window starts later on. A window is a
    candidate if its smallest hash is a shared anchor; later, if both halves are shared.
    """
    half = (length + 1) // 2

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            for doc_id, text_hash, text, places in zip(batch["doc_id"], batch["text_hash"], batch["text"], batch["places"], strict=True):
                found = Windows(text)
                n = len(found.words) - length + 1
                if n <= 0:
                    continue
                if first:
                    sums = found.sums(half)
                    least = _running(np.minimum, sums, length - half + 1)
                    at = np.flatnonzero(np.isin(least, sums[places]))
                else:
                    at = np.intersect1d(places, np.asarray(places) - (length - half))
                    at = at[at < n]
                yield pd.DataFrame(
                    {
                        "doc_id": doc_id,
                        "text_hash": text_hash,
                        "h1": found.sums(length, 0)[at].view(np.int64),
                        "h2": found.sums(length, 1)[at].view(np.int64),
                        "place": at.astype(np.int32),
                    }
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInPandas(candidates, f"doc_id {kind}, text_hash bigint, h1 bigint, h2 bigint, place int")


def repeated_windows(docs: DataFrame, window: int = WINDOW, longest: int | None = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The windows of several documents, found by doubling.

    Returns the copies, (doc_id, text_hash, n_words) of rows whose whole text a
    smaller doc_id has too, and (doc_id, text_hash, length, places, later) of the
    other rows: the starts of their windows of ``length`` words that are in
    several documents, and in ``later`` those that a smaller doc_id has too.

    The smallest hash among a window's windows of half the length is an anchor
    wherever the window stands. So the first level compares anchors alone,
    about one word in thirteen. Windows whose smallest hash is repeated are
    compared at ``window`` words, then starts that are repeated together with
    the start behind them at twice that length, and so on up to ``longest`` words, or with None until none is left. Sequences are
    compared by 128 bits, anchors by 64, as they only choose candidates.
    """
    sketches = staged(_sketches(docs, window))
    firsts = sketches.groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    marked = sketches.join(firsts, "digest")
    copies = marked.where("doc_id > first_id").select("doc_id", "text_hash", "n_words")
    rows = marked.where("doc_id = first_id").select(
        "doc_id", "text_hash", F.inline(F.arrays_zip(F.col("sums").alias("sum"), F.col("places").alias("place")))
    )
    shared = staged(_per_row(_shared(rows, ["sum"])))
    levels = None
    length = window
    while True:
        texts = staged(_binary(docs).join(shared, ["doc_id", "text_hash"]))
        found = _shared(_windows(texts, length, length == window), ["h1", "h2"])
        level = found.groupBy("doc_id", "text_hash").agg(
            F.collect_list("place").alias("places"),
            F.collect_list(F.when(F.col("doc_id") > F.col("first_id"), F.col("place"))).alias("later"),
        )
        level = staged(level.select("doc_id", "text_hash", F.lit(length).alias("length"), "places", "later"))
        levels = level if levels is None else levels.unionByName(level)
        length *= 2
        if (longest is not None and length > longest) or level.isEmpty():
            return copies, levels
        shared = level.select("doc_id", "text_hash", "places")


def _keep(window: int):
    @F.pandas_udf("text string, n_words bigint, n_removed bigint")
    def keep(texts: pd.Series, places: pd.Series, copy: pd.Series) -> pd.DataFrame:
        out = []
        for text, starts, whole in zip(texts, places, copy, strict=True):
            words = (text or b"").split()
            n = len(words)
            if whole and n >= window:
                kept = []
            elif starts is None or len(starts) == 0:
                kept = words
            else:
                covered = _covered(np.asarray(starts) + window - 1, window - 1, n)
                kept = [words[i] for i in np.flatnonzero(~covered)]
            out.append((b" ".join(kept).decode(), n, n - len(kept)))
        return pd.DataFrame(out, columns=["text", "n_words", "n_removed"])

    return keep


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the kept words as text, joined by one space, and ``n_words``, ``n_removed`` besides.

    A word goes if a window of ``window`` words over it is in a document with a
    smaller doc_id too, as the texts were given. Repeats within a document, and
    between rows of one doc_id, stay. A null text has no words and becomes
    empty; rows without doc_id stay whole and take nothing from others. Further
    columns are kept, but for those named n_words or n_removed.
    """
    copies, levels = repeated_windows(docs, window)
    whole = copies.select("doc_id", "text_hash", F.lit(True).alias("copy"), F.lit(None).cast("array<int>").alias("later"))
    parts = levels.where(F.size("later") > 0).select("doc_id", "text_hash", F.lit(False).alias("copy"), "later")
    id_, hash_, copy, later = (fresh(docs, x) for x in ("id", "hash", "copy", "later"))
    verdicts = whole.unionByName(parts).dropDuplicates(["doc_id", "text_hash"]).toDF(id_, hash_, copy, later)
    joined = docs.join(verdicts, (F.col("doc_id") == F.col(id_)) & (F.xxhash64("text") == F.col(hash_)), "left")
    out = _keep(window)(F.col("text").cast("binary"), F.col(later), F.coalesce(copy, F.lit(False)))
    kept = fresh(docs, "kept")
    others = [F.col(f"{kept}.text").alias("text") if x == "text" else F.col(x) for x in docs.columns if x not in ("n_words", "n_removed")]
    return joined.withColumn(kept, out).select(*others, f"{kept}.n_words", f"{kept}.n_removed")
