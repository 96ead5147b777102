"""Mixing of sources to target weights by Pfair scheduling of their blocks."""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator, Sequence
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.llm.staging import fresh, staged

BLOCK_DOCS = 8
#: Weights are taken to 1 / SHARES, finer than floating point; no list is as long as that.
SHARES = 1 << 62
#: Sources at most; a count and a weight of each is held on the driver.
MAX_SOURCES = 500
BUCKET_ROWS = 1000
#: Blocks of a source in a row of the table of slots, and rows of it that are made at once.
PART_BLOCKS, PARTS_AT_ONCE = 1024, 64


def shares_of(weights: dict[str, float], shares: int = SHARES) -> dict[str, int]:
    """Whole shares in proportion to ``weights`` that sum to ``shares`` (largest remainders).

    Only sources whose part is below one share are raised to one; the others keep their proportions.
    """
    if not weights:
        return {}
    if min(weights.values()) <= 0 or len(weights) > shares:
        raise ValueError("weights must be positive, and no more than there are shares")
    free, out = {s: Fraction(w) for s, w in weights.items()}, {}
    while True:
        total, left = sum(free.values()), shares - len(out)
        exact = {s: w / total * left for s, w in free.items()}
        if not (small := [s for s, x in exact.items() if x < 1]):
            break
        for s in small:
            out[s] = 1
            del free[s]
    whole = {s: int(x) for s, x in exact.items()}
    rest = left - sum(whole.values())
    for s in sorted(free, key=lambda s: (whole[s] - exact[s], s))[:rest]:
        whole[s] += 1
    return {s: out.get(s) or whole[s] for s in weights}


def _in_order(shares: dict[str, int]) -> Iterator[tuple[str, int]]:
    """(source, block) of each slot, without an end, by earliest deadline first; see ``schedule``."""
    period = sum(shares.values())
    waiting = [(0, s, 0) for s in shares]
    heapq.heapify(waiting)
    ready: list[tuple] = []
    for t in itertools.count():
        while waiting and waiting[0][0] <= t:
            _, s, i = heapq.heappop(waiting)
            due, part = divmod((i + 1) * period, shares[s])
            heapq.heappush(ready, (due + (part > 0), not part, -shares[s], s, i))
        _, _, _, s, i = heapq.heappop(ready)
        yield s, i
        heapq.heappush(waiting, ((i + 1) * period // shares[s], s, i + 1))


class Schedule(Sequence):
    """The slots of one period, worked out as far as they are asked for."""

    def __init__(self, shares: dict[str, int]):
        self._length, self._known, self._rest = sum(shares.values()), [], _in_order(shares)

    def __len__(self) -> int:
        return self._length

    def __getitem__(self, t: int) -> str:
        if not 0 <= t < self._length:
            raise IndexError(t)
        while len(self._known) <= t:
            self._known.append(next(self._rest)[0])
        return self._known[t]


def schedule(shares: dict[str, int]) -> Sequence[str]:
    """The source of each slot of one period, by earliest deadline first.

    Block i (from 0) of a source of weight w is released at floor(i / w) and due
    at ceil((i + 1) / w). One block is placed in each slot: of those released,
    the one due first; among equals the source whose next window overlaps, then
    the larger weight, then the name. After any number t of slots a source
    has more than w * t - 1 and less than w * t + 1 blocks.
    """
    return Schedule(shares)


def places(shares: dict[str, int], blocks: dict[str, int]) -> Iterator[tuple[str, int, int]]:
    """(source, block, slot) of all blocks, slot by slot: when a source has no more, the others go on in their proportions.

    Then the schedule of the sources that are left begins anew. Nothing but a
    place for each source is held.
    """
    left, first, slot = {s: n for s, n in blocks.items() if n > 0}, dict.fromkeys(blocks, 0), 0
    while left:
        divisor = math.gcd(*(shares[s] for s in left))
        used = dict.fromkeys(left, 0)
        for s, i in _in_order({s: shares[s] // divisor for s in left}):
            yield s, first[s] + i, slot
            slot += 1
            used[s] = i + 1
            if i + 1 == left[s]:
                break
        first |= {s: first[s] + n for s, n in used.items()}
        left = {s: left[s] - n for s, n in used.items() if left[s] > n}


def _place_table(docs: DataFrame, shares: dict[str, int], blocks: dict[str, int]) -> DataFrame:
    """(_s, _part, _slots): the slots of ``PART_BLOCKS`` blocks of a source a row, made and written by one task as it goes."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["_s", "_part", "_slots"]
        for batch in batches:
            if not len(batch):
                continue
            begun: dict[str, list[int]] = {s: [] for s in blocks}
            full: list[tuple] = []
            for s, block, slot in places(shares, blocks):
                begun[s].append(slot)
                if len(begun[s]) == PART_BLOCKS or block + 1 == blocks[s]:
                    full.append((s, block // PART_BLOCKS, begun[s]))
                    begun[s] = []
                    if len(full) == PARTS_AT_ONCE:
                        yield pd.DataFrame(full, columns=columns)
                        full = []
            yield pd.DataFrame(full, columns=columns)

    one = docs.sparkSession.range(0, 1, 1, 1)
    return staged(one.mapInPandas(rows, "_s string, _part bigint, _slots array<bigint>"))


def tempered(counts: dict[str, int], power: float = 0.5) -> dict[str, float]:
    """Weights that grow slower than the sources do."""
    return {s: n**power for s, n in counts.items()}


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    block_docs: int = BLOCK_DOCS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``docs`` with block, slot and place: the block within its source, that block's slot in the mix, the place in the block.

    A source's documents, ordered by a hash of doc_id, form blocks of
    ``block_docs`` (the last may be short), and the slots of the blocks follow
    the Pfair schedule of ``weights`` (``tempered`` counts if not given). In any
    prefix of the mix, as long as no source has been used up, a source deviates
    by less than one block from its weight (up to t / SHARES after t slots). Every row is in the mix once; when a
    source has no more, the others go on at their proportions. Sources without
    a weight get the smallest one given; weights of sources without documents
    are left out. A null source is one of its own, named "" in ``weights``. Null
    texts, null and repeated ids are rows like any other; the order of rows that
    are equal in doc_id is that of their texts' hashes. An empty table gives an
    empty mix. Columns named block, slot or place are replaced.

    Rows are counted within buckets of a source, as many as the number of rows
    asks for, and buckets are added up. So no source is gathered in one task.
    The driver holds a count a source. The schedule depends on what came before
    each slot, so one task works through the blocks (not their rows) and writes
    their slots as it goes. ``docs`` is read three times, twice without its texts.
    """
    name, h, bucket, earlier = (fresh(docs, x) for x in ("source", "hash", "bucket", "earlier"))
    sourced = docs.drop("block", "slot", "place").withColumn(name, F.coalesce(F.col("source").cast("string"), F.lit("")))
    counted = sourced.groupBy(name).agg(F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(counted) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    counts = {r[name]: r["n"] for r in counted}
    weights = weights or tempered(counts)
    weights = {s: weights.get(s, min(weights.values())) for s in sorted(counts)}
    slots = _place_table(docs, shares_of(weights), {s: -(-n // block_docs) for s, n in counts.items()})

    buckets = sum(counts.values()) // bucket_rows + 1
    hashed = sourced.withColumn(h, F.xxhash64("doc_id")).withColumn(bucket, F.pmod(F.col(h), F.lit(buckets)))
    before = W.partitionBy(name).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    sizes = hashed.groupBy(name, bucket).agg(F.count("*").alias(earlier))
    sizes = sizes.withColumn(earlier, F.coalesce(F.sum(earlier).over(before), F.lit(0)))
    ties = [F.xxhash64("text")] if "text" in docs.columns else []
    rank = F.row_number().over(W.partitionBy(name, bucket).orderBy(h, "doc_id", *ties)) - 1
    ranked = hashed.withColumn("place", rank).join(sizes, [name, bucket])
    ranked = ranked.withColumn("place", F.col("place") + F.col(earlier)).withColumn("block", F.expr(f"place div {block_docs}"))
    ranked = ranked.withColumn("place", F.pmod("place", F.lit(block_docs)))

    at = fresh(docs, "slots")
    placed = ranked.join(
        slots.select(F.struct("*").alias(at)),
        (F.col(name) == F.col(f"{at}._s")) & (F.expr(f"block div {PART_BLOCKS}") == F.col(f"{at}._part")),
    )
    slot = F.get(f"{at}._slots", F.pmod("block", F.lit(PART_BLOCKS)).cast("int"))
    kept = [x for x in docs.columns if x not in ("block", "slot", "place")]
    return placed.withColumn("slot", slot).select(*kept, "block", "slot", F.col("place").cast("int").alias("place"))


def in_mix_order(docs: DataFrame, weights: dict[str, float] | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The rows and columns of ``docs``, range-partitioned and sorted in the order of the mix.

    Written as files, their names and the rows in them are in that order.
    """
    row = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", *(["text"] if "text" in docs.columns else []))
    mixed = mix(row, weights, block_docs).select("row", "slot", "place")
    return mixed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").select("row.*")
