"""SimHash near-duplicates: candidate pairs by pigeonring filtering, classes by connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.components import connected_components
from slotwise.llm.staging import fresh, staged

SEED = 42
SEGMENTS = 8  # of 8 bits each, on a ring
MAX_BITS = 3
#: Segments of a chain whose differences must add up to 0 (the first two) or 1 at most (the next three).
EXACT, LOOSE = 2, 3
#: A bucket of more distinct fingerprints than this is linked by shared masks instead of pairs.
MAX_BUCKET = 4096

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes | None, shingle_words: int = 3) -> int:
    """64 bits: bit j is set if it is set in over half the shingles' hashes; zero without words."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle_words:
        hashes = [digest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - shingle_words + 1].tolist()
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle_words - 1 :].tolist(), strict=True)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):  # bounds the unpacked bits of a long text
        part = np.array(hashes[at : at + 65536], ">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle_words: int = 3, carried: Sequence[str] = ()) -> DataFrame:
    """(doc_id, ``carried``, fp long) per row of ``docs``; a null text has fingerprint zero. Carried columns are strings."""
    names = ["doc_id", *carried]

    def of_batches(batches: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            fps = [fingerprint(x, shingle_words) for x in batch["text"]]
            yield batch[names].assign(fp=np.array(fps, np.int64))

    columns = docs.select(*[F.col(x).cast("string").alias(x) for x in names], F.col("text").cast("binary").alias("text"))
    found = columns.mapInPandas(of_batches, ", ".join([*(f"{x} string" for x in names), "fp long"]))
    return found.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType), *carried, "fp")


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * (SEGMENTS - 1 - i % SEGMENTS)).bitwiseAND(F.lit(255))


def _ring_differences(a: Column, b: Column) -> list[Column]:
    return [F.bit_count(_segment(a.bitwiseXOR(b), i)) for i in range(SEGMENTS)]


def _viable(differences: list[Column], max_bits: int) -> Column:
    """Some start from which every chain of l segments differs in l * max_bits / SEGMENTS bits at most."""
    starts = F.lit(False)
    for i in range(SEGMENTS):
        total, ok = F.lit(0), F.lit(True)
        for length in range(1, SEGMENTS + 1):
            total = total + differences[(i + length - 1) % SEGMENTS]
            ok = ok & (total <= length * max_bits // SEGMENTS)
        starts = starts | ok
    return starts


def _keys(fp: Column) -> Column:
    """24 keys; fingerprints within 3 bits share one at least.

    By the pigeonring principle some chain of 5 segments has no difference in
    its first two and one at most in the other three. So two of those three are
    equal as well, and a key is the start, which of the three is left out, and
    the 32 bits of the four equal segments.
    """
    keys = []
    for i in range(SEGMENTS):
        for out in range(LOOSE):
            parts = [i, i + 1, *(i + EXACT + j for j in range(LOOSE) if j != out)]
            key = F.lit(i * LOOSE + out).cast("long")
            for part in parts:
                key = F.shiftleft(key, 8).bitwiseOR(_segment(fp, part))
            keys.append(key)
    return F.array(*keys)


def _by_masks(crowded: DataFrame, max_bits: int) -> DataFrame:
    """Links within crowded buckets (key, fp): rows for masks, no pairs.

    Members of a bucket can differ in the 32 bits outside its key alone. Those
    that agree in all but ``max_bits`` of these are near each other, and each
    is tied to the smallest of them. Every near pair of the bucket agrees under
    one such mask, so no component is torn.
    """
    free = []
    for i in range(SEGMENTS):
        for out in range(LOOSE):
            segments = [i + EXACT + out, *range(i + EXACT + LOOSE, i + SEGMENTS)]
            bits = sorted(8 * (SEGMENTS - 1 - p % SEGMENTS) + bit for p in segments for bit in range(8))
            free.append(F.array(*map(F.lit, bits)))
    masked = crowded.withColumn("free", F.array(*free)[F.shiftrightunsigned("key", 32).cast("int")])
    masked = masked.withColumns({"last": F.lit(-1), "mask": F.lit(0).cast("long")})
    for _ in range(max_bits):
        masked = masked.withColumn("bit", F.explode(F.expr("filter(free, x -> x > last)")))
        masked = masked.withColumns({"mask": F.expr("mask | shiftleft(1L, bit)"), "last": F.col("bit")})
    masked = masked.select("key", "mask", F.expr("fp & ~mask").alias("rest"), "fp")
    smallest = masked.groupBy("key", "mask", "rest").agg(F.min("fp").alias("a"), F.max("fp").alias("b"))
    tied = masked.join(smallest.where("a <> b"), ["key", "mask", "rest"]).where("fp <> a")
    return tied.select("a", F.col("fp").alias("b"))


def links(fps: DataFrame, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(a, b) with a < b: distinct fingerprints of ``fps`` (fp) that differ in ``max_bits`` or fewer bits.

    Candidates share a key of ``_keys``, pass the budgets of ``_viable`` and then
    the full Hamming check, all inside the join, so that only links leave it. A
    bucket of over ``max_bucket`` fingerprints yields a spanning set of its links
    instead of all of them, enough for the same components, in work that is
    proportional to its size.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the keys hold for at most 3 differing bits")
    keyed = fps.select("fp", F.explode(_keys(F.col("fp"))).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    crowds = staged(sizes.where(F.col("n") > max_bucket))
    has_crowds = not crowds.isEmpty()
    pairs = keyed if not has_crowds else keyed.join(crowds, "key", "left_anti")
    left = pairs.select("key", F.col("fp").alias("a"))
    right = pairs.select(F.col("key").alias("other"), F.col("fp").alias("b"))
    a, b = F.col("a"), F.col("b")
    near = F.bit_count(a.bitwiseXOR(b)) <= max_bits
    found = left.join(right, (F.col("key") == F.col("other")) & (a < b) & _viable(_ring_differences(a, b), max_bits) & near)
    found = found.select("a", "b")
    if has_crowds:
        found = found.unionByName(_by_masks(keyed.join(crowds, "key", "left_semi"), max_bits))
    return found.distinct()


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id that links lead to, itself included.
    Texts that are null or without words share fingerprint zero. Rows that
    repeat a doc_id are rows of their own; a null doc_id is never the smallest (a class
    of nulls alone has a null id). An empty table gives an empty one. Other
    columns are not read. Equal fingerprints are one node of the graph, so
    copies are never paired.
    """
    marked = staged(fingerprints(docs, shingle_words))
    rooted = _rooted(marked, max_bits)
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    members = rooted.join(smallest, "root").select("fp", "component_id")
    return marked.join(members, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _rooted(marked: DataFrame, max_bits: int) -> DataFrame:
    """(fp, first_id, root): the distinct fingerprints of ``marked`` (doc_id, fp) and the class each is in, staged."""
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    found = staged(links(nodes, max_bits))
    classes = connected_components(found).withColumnsRenamed({"node": "fp", "component": "root"})
    return staged(nodes.join(classes, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")))


def drop_near_duplicates(docs: DataFrame, shingle_words: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each class: that of the smallest doc_id, same columns.

    Rows, not ids, are in classes: rows that share a doc_id but not a class are
    judged apart, so no text is lost that has no near duplicate. Among rows of
    a class with the same doc_id the one whose columns have the smallest hash
    stays, whatever the order of the rows. Rows without doc_id have no class:
    they stay, one for each text.
    """
    row, text = fresh(docs, "row"), fresh(docs, "text_hash")
    columns = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind]
    digest = F.concat_ws(" ", *[F.hex(F.xxhash64(F.lit(i), *columns)) for i in (1, 2)])
    text_hash = F.when(F.col("doc_id").isNull(), F.sha2(F.coalesce("text", F.lit("")), 256))
    keyed = docs.withColumns({row: digest, text: text_hash})
    marked = staged(fingerprints(keyed, shingle_words, [row, text]))
    classes = _rooted(marked, max_bits).select("fp", "root")
    of = F.when(F.col("doc_id").isNotNull(), F.col("root")).alias("class")
    chosen = marked.join(classes, "fp").groupBy(of, F.col(text).alias("text")).agg(F.min(F.struct("doc_id", row)).alias("first"))
    kept = chosen.select(F.col(f"first.{row}").alias(row)).distinct()
    return keyed.join(kept, row, "left_semi").dropDuplicates([row]).select(*docs.columns)
