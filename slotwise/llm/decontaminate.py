"""Benchmark decontamination: a broadcast hash set of benchmark n-grams, scanned over every document."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.staging import fresh, staged

WINDOW = 10
#: Text of the items of one broadcast; items beyond it are scanned for in further rounds.
BLOCK_BYTES = 16 << 20

#: A-Z become a-z; other ASCII but digits and letters parts words.
NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 1 << 22


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(NORMAL).split()


class Ngrams:
    """The windows of some items: numbered words, a hash set of windows, and which items each is in."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.numbers: dict[bytes, int] = {}
        self.owners: dict[tuple[int, ...], list[str]] = {}
        for item_id, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            length = min(window, len(ids))
            for i in range(len(ids) - length + 1 if ids else 0):
                owners = self.owners.setdefault(tuple(ids[i : i + length]), [])
                if item_id not in owners:
                    owners.append(item_id)
        self.lengths = sorted({len(x) for x in self.owners})
        self.filters = {}
        for length in self.lengths:
            grams = np.array([x for x in self.owners if len(x) == length], np.uint64)
            seen = np.zeros(_SLOTS, bool)
            seen[self._slots(grams.T)] = True
            self.filters[length] = seen

    @staticmethod
    def _slots(columns) -> np.ndarray:
        """The place of each window's hash; ``columns`` are its words, one after the other."""
        total = 0
        for column in columns:
            total = (total ^ column) * _BASE
            total = total ^ (total >> np.uint64(29))
        return (total >> np.uint64(42)).astype(np.int64)

    def hits(self, words: list[bytes]) -> list[tuple[int, int, list[str]]]:
        """(first word, number of words, items) of every place where a window stands; hash hits are verified."""
        n = len(words)
        ids = np.fromiter(map(self.numbers.get, words, repeat(0)), np.uint64, n)
        found = []
        for length in self.lengths:
            if n < length:
                continue
            views = [ids[k : n - length + 1 + k] for k in range(length)]
            # an unknown word is in no window
            known = np.flatnonzero(np.convolve(ids == 0, np.ones(length, int))[length - 1 : n] == 0)
            if not len(known):
                continue
            with np.errstate(over="ignore"):
                slots = self._slots(view[known] for view in views)
            for at in known[self.filters[length][slots]].tolist():
                owners = self.owners.get(tuple(ids[at : at + length].tolist()))
                if owners:
                    found.append((at, length, owners))
        return found


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in lists of about ``block_bytes`` of text, so that none grows with the benchmark."""
    items = benchmark.where("text is not null").select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text")
    )
    items = items.dropDuplicates(["item_id", "text"])  # copies would all be in one block
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = total // block_bytes + 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for i in range(n):
        yield [(r["item_id"], bytes(r["text"])) for r in items.where(part == i).collect()]


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, spans and items, the last two arrays of struct(first, length) and of item ids.

    Columns of ``docs`` with these names are replaced. The benchmark is broadcast
    in blocks of bounded size; with more than one, the documents are staged
    between the rounds. A null text has no words, a null item none either, and
    an item of fewer words than ``window`` is one window. Rows of equal item_id
    are one item, a null item_id is none. Documents are rows: repeated ids do not meet.
    """
    spark = docs.sparkSession
    empty = {"n_words": "bigint", "spans": "array<struct<first:int,length:int>>", "items": "array<string>"}
    out = docs.drop(*empty)
    state = fresh(out, "state")
    kind = f"struct<{','.join(f'{k}:{v}' for k, v in empty.items())}>"
    out = out.withColumn(state, F.lit(None).cast(kind))
    blocks = _blocks(benchmark.where("item_id is not null"), block_bytes)
    for i, block in enumerate(blocks):
        sent = spark.sparkContext.broadcast(block)
        out = (staged(out) if i else out).withColumn(state, _scan(sent, window, kind)(F.col("text").cast("binary"), state))
    return out.select(*(F.col(x) for x in out.columns if x != state), *(f"{state}.{x}" for x in empty))


def _scan(sent, window: int, kind: str):
    @F.pandas_udf(kind)
    def scan(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        ngrams = Ngrams(sent.value, window)
        for texts, before in batches:
            rows = []
            for text, spans, items in zip(texts, before["spans"], before["items"], strict=True):
                words = words_of(text)
                hits = ngrams.hits(words)
                spans, items = [] if spans is None else list(spans), set() if items is None else set(items)
                for first, length, owners in hits:
                    spans.append({"first": first, "length": length})
                    items.update(owners)
                rows.append((len(words), spans, sorted(items)))
            yield pd.DataFrame(rows, columns=["n_words", "spans", "items"])

    return scan


def count_hits(found: DataFrame) -> DataFrame:
    """``find_hits`` with n_hit, the number of words inside any span, and contaminated."""
    ordered = F.array_sort("spans")
    step = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda total, x: F.struct(
            (total["n"] + F.greatest(F.lit(0), x["first"] + x["length"] - F.greatest(total["end"], x["first"]))).alias("n"),
            F.greatest(total["end"], x["first"] + x["length"]).alias("end"),
        ),
        lambda total: total["n"].cast("long"),
    )
    return found.withColumn("n_hit", step).withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark stands, columns as given."""
    marked = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return find_hits(marked, benchmark, window).where(F.size("spans") == 0).select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the words of the spans cut out of the texts; what stands between words stays."""
    import re

    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(texts, spans, strict=True):
            if text is not None and found is not None and len(found):
                text = bytes(text)
                hit = {i for x in found for i in range(x["first"], x["first"] + x["length"])}
                lower = text.translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
                kept, at = [], 0
                for i, m in enumerate(word.finditer(lower)):
                    if i in hit:
                        kept.append(text[at : m.start()])
                        at = m.end()
                text = b"".join([*kept, text[at:]])
            out.append(None if text is None else bytes(text).decode())
        return pd.Series(out, dtype=object)

    marked = docs.select(F.struct(*docs.columns).alias("row"), "text")
    found = find_hits(marked, benchmark, window)
    new = cut(F.col("text").cast("binary"), "spans").alias("text")
    return found.select(*(new if x == "text" else F.col("row")[x].alias(x) for x in docs.columns))
