"""Token ids of documents in ORC files: integer run-length encoding, row indexes, Bloom filters on doc_id."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from slotwise.llm.staging import new_folder, staged

#: Stripes of 16 MB, a task's reading each; min, max and Bloom filter of every 1,000 documents.
ORC_OPTIONS = {
    "orc.stripe.size": str(16 << 20),
    "orc.row.index.stride": "1000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "compression": "lz4",
}
END_ID = 0
#: Text that goes to one file, estimated from a few rows and the number of all; larger tasks meet fewer new pieces.
FILE_TEXT_BYTES = 64 << 20
#: Bytes of the texts whose pieces are told apart together, bytes of a run of new pieces, ids of a batch of results.
SLICE_BYTES, RUN_BYTES, OUT_IDS = 8 << 20, 8 << 10, 1 << 19
#: Pieces whose ids a task remembers from slice to slice; it starts over when there are more.
MAX_KNOWN = 400_000
#: Rows whose pieces every task knows from the start, and the characters of each that are looked at. It changes no
#: result, and what is broadcast is about 250,000 pieces, or 10 MB, whatever the size of the table.
COMMON_ROWS, COMMON_CHARS = 5000, 4096

_WHITE = r"[\t-\r \x1c-\x1f\x85\p{Z}]"
_BESIDE_SPACE = rf"{_WHITE} | {_WHITE}|\A | \z"
_BESIDE_LINE_END = rf"{_WHITE}\n|\n{_WHITE}|\A\n|\n\z"
_INK = r"[^\t-\r \x1c-\x1f\x85\p{Z}]"
#: Pieces that can stand in a run: neither end is white space, but for a space in front of some.
_BARE = f"(?s)^{_INK}(.*{_INK})?$"
_SPACED = f"(?s)^ {_INK}(.*{_INK})?$"
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")


@dataclass(frozen=True)
class Common:
    """Pieces that all tasks know (each once), their ids one after the other, and how many each has."""

    pieces: pa.StringArray
    ids: np.ndarray
    counts: np.ndarray


class PieceEncoder:
    """Whole texts to ids, each distinct piece by the tokenizer once, as long as it is remembered.

    The byte-level pre-tokenizer never joins what a single space between two
    other characters parts, and keeps that space with what follows. So texts
    are split there, and the ids of the pieces are the ids of the text. A single
    line end between other characters is a piece of its own. For the same reason
    pieces are encoded in runs, and the ids of a run are cut by the bytes that
    each id stands for.
    """

    def __init__(self, path: str, end_id: int, common: Common | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        self.common = common or Common(pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(0, np.int64))
        self.known: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.id_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.id_bytes[i] = len(token)  # a character a byte

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    @staticmethod
    def _marked(texts: pa.StringArray) -> pa.StringArray:
        """``texts`` with a null character wherever they can be split: before spaces, around line ends.

        White space beside a space or a line end belongs with it to the
        pre-tokenizer; such texts are split at their other spaces alone.
        """
        lined = pc.if_else(pc.match_substring_regex(texts, _BESIDE_LINE_END), texts, pc.replace_substring(texts, "\n", "\0\n\0"))
        tight = pc.match_substring_regex(texts, _BESIDE_SPACE)
        marked = pc.replace_substring(lined, " ", "\0 ")
        some = [_SAFE_SPACE.sub("\0 ", x) for x in lined.filter(tight).to_pylist()]
        return pc.replace_with_mask(marked, tight, pa.array(some, pa.string()))

    def _learn(self, parts: list[str]) -> None:
        """Encodes new parts, in runs of those with a space in front, in runs of those without, the others alone."""
        texts = pa.array(parts, pa.string())
        for fit, between in ((_SPACED, ""), (_BARE, "\n")):
            some = texts.filter(pc.match_substring_regex(texts, fit))
            ends = np.cumsum(pc.binary_length(some).to_numpy())
            at = 0
            while at < len(some):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + RUN_BYTES)))
                self._learn_run(some.slice(at, to - at), between)
                at = to
        for part in parts:
            if part not in self.known:
                self.known[part] = self._ids(part).tobytes()

    def _learn_run(self, parts: pa.StringArray, between: str) -> None:
        texts, sizes = parts.to_pylist(), pc.binary_length(parts).to_numpy().astype(np.int64)
        ids = self._ids(between.join(texts))
        starts = np.cumsum(sizes + len(between)) - sizes - len(between)
        passed = np.cumsum(self.id_bytes[ids]) - self.id_bytes[ids]  # the bytes before each id
        first, last = np.searchsorted(passed, starts), np.searchsorted(passed, starts + sizes)
        whole = ids.tobytes()
        self.known.update({t: whole[4 * a : 4 * b] for t, a, b in zip(texts, first.tolist(), last.tolist(), strict=True)})

    def _encode_parts(self, parts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and the place of each part's among them (first, number)."""
        if len(self.known) > MAX_KNOWN:
            self.known = {}
        at = pc.index_in(parts, value_set=self.common.pieces)
        rest = parts.filter(at.is_null()).to_pylist()
        self._learn([x for x in rest if x not in self.known])
        found = [self.known[x] for x in rest]
        ids = np.concatenate([np.frombuffer(b"".join(found), np.int32), self.common.ids])
        own = _places(np.fromiter(map(len, found), np.int64, len(found)) // 4)
        places = _places(self.common.counts) + [len(ids) - len(self.common.ids), 0]
        out = np.empty((len(parts), 2), np.int64)
        missing = at.is_null().to_numpy(zero_copy_only=False)
        out[missing] = own
        out[~missing] = places[at.drop_null().to_numpy()]
        return ids, out

    def _encode_pieces(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one after the other, and the number of each piece's ids.

        Marks after a letter are a part of their own to the pre-tokenizer, so
        pieces that differ in these alone are encoded once.
        """
        stems = pc.utf8_rtrim(pieces, characters=".,;:!?")
        marked = pc.and_(pc.not_equal(stems, pieces), pc.match_substring_regex(stems, r"\pL\z"))
        some = zip(pieces.filter(marked).to_pylist(), stems.filter(marked).to_pylist(), strict=True)
        marks = pc.replace_with_mask(
            pa.repeat(pa.scalar("", pa.string()), len(pieces)), marked, pa.array([x[len(y) :] for x, y in some], pa.string())
        )
        parts = pa.concat_arrays([pc.if_else(marked, stems, pieces), marks]).dictionary_encode()
        ids, places = self._encode_parts(parts.dictionary)
        both = places[parts.indices.to_numpy().reshape(2, -1).T.ravel()]  # each stem before its marks
        return _gathered(ids, both), both[:, 1].reshape(-1, 2).sum(1)

    def encode(self, texts: pa.StringArray) -> Iterator[tuple[int, int, pa.ListArray]]:
        """The ids of texts a to b, each with the end id, for consecutive a and b."""
        nulls = pc.match_substring(texts, "\0")
        odd = {i: self._ids(texts[i].as_py()) for i in np.flatnonzero(nulls.to_numpy(zero_copy_only=False)).tolist()}
        split = pc.split_pattern(self._marked(pc.if_else(nulls, "", texts)), "\0")
        coded = split.values.dictionary_encode()
        ids, counts = self._encode_pieces(coded.dictionary)
        # the end id is a last piece, and so are the texts that have null characters
        extra = [np.array([self.end_id], np.int32), *(np.append(x, self.end_id).astype(np.int32) for x in odd.values())]
        last = np.full(len(texts), len(counts))
        last[list(odd)] = len(counts) + 1 + np.arange(len(odd))
        ids = np.concatenate([ids, *extra])
        counts = np.concatenate([counts, [len(x) for x in extra]])
        places = _places(counts)
        offsets = split.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        order = np.insert(coded.indices.to_numpy().astype(np.int64), offsets[1:], last)
        offsets += np.arange(len(offsets))
        ends = np.concatenate([[0], np.cumsum(counts[order])])[offsets]
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(ends, ends[a] + OUT_IDS, "right")) - 1)
            some = _gathered(ids, places[order[offsets[a] : offsets[b]]])
            yield a, b, pa.ListArray.from_arrays((ends[a : b + 1] - ends[a]).astype(np.int32), some)
            a = b


def _places(counts: np.ndarray) -> np.ndarray:
    """(first, number) of consecutive groups of ids."""
    return np.stack([np.cumsum(counts) - counts, counts], axis=1)


def _gathered(ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The ids at every (first, number) of ``places``, one after the other."""
    first, n = places[:, 0], places[:, 1]
    return ids[np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)]


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``SLICE_BYTES`` together; a larger text is a range of its own."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    a = 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(total, total[a] + SLICE_BYTES, "right")) - 1)
        yield a, b
        a = b


def look_at(docs: DataFrame, tokenizer: str) -> tuple[Common, int]:
    """The pieces of about ``COMMON_ROWS`` of the texts, drawn at random, and how many bytes all texts have.

    One pass finds the sizes and draws the texts, and one task encodes those. So the driver
    holds neither texts nor a tokenizer, only the pieces and their ids.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    drawn = F.when(F.rand(7) < COMMON_ROWS / max(docs.count(), 1), F.substring(text, 1, COMMON_CHARS))
    looked = staged(docs.select(F.octet_length(text).cast("bigint").alias("size"), drawn.alias("text")))
    some = looked.where("text is not null").select("text").repartition(1)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(tokenizer, END_ID)
        for batch in batches:
            texts = batch.column("text")
            for a, b in _slices(pc.binary_length(texts).to_numpy()):
                for _ in encoder.encode(texts.slice(a, b - a)):
                    pass
        known = encoder.known.values()
        offsets = np.cumsum([0, *map(len, known)]) // 4
        ids = pa.ListArray.from_arrays(offsets.astype(np.int32), np.frombuffer(b"".join(known), np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(encoder.known.keys(), pa.string()), ids], ["piece", "ids"])

    found = some.mapInArrow(learn, "piece string, ids array<int>").toArrow()
    ids = found.column("ids").combine_chunks()
    counts = ids.value_lengths().to_numpy().astype(np.int64)
    common = Common(found.column("piece").combine_chunks(), ids.flatten().to_numpy(), counts)
    return common, looked.agg(F.sum("size")).first()[0] or 0


def token_ids(docs: DataFrame, tokenizer: str, end_id: int = END_ID, common: Common | None = None) -> DataFrame:
    """(doc_id, row, ids array<int>) for (doc_id, row, text): ids of the whole text and ``end_id``; a null text is empty."""
    sent = docs.sparkSession.sparkContext.broadcast(common and (common.pieces, common.ids, common.counts))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(tokenizer, end_id, sent.value and Common(*sent.value))
        for batch in batches:
            texts, keys = batch.column("text"), batch.select(["doc_id", "row"])
            for start, stop in _slices(pc.binary_length(texts).fill_null(0).to_numpy()):
                for a, b, ids in encoder.encode(texts.slice(start, stop - start).fill_null("")):
                    part = keys.slice(start + a, b - a)
                    yield pa.RecordBatch.from_arrays([*part.columns, ids], ["doc_id", "row", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "row", "text").mapInArrow(encode, f"doc_id {kind}, row bigint, ids array<int>")


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, order: list[Column] | None = None, end_id: int = END_ID
) -> None:
    """Writes ORC files of (doc_id, row, ids) to ``folder``, in ascending doc_id order from file to file.

    ``order`` gives another order. ``row`` ascends in that order, within and
    across files; its upper 31 bits number the file. Texts, not ids, are
    range-partitioned, so that the smaller of the two is shuffled and each text
    is encoded once. Null ids come first; rows that repeat a doc_id are ordered
    by the hash of their texts. An empty table makes a folder without rows.
    """
    keys = {f"key{i}": key for i, key in enumerate([*(order or [F.col("doc_id")]), F.xxhash64("text")])}
    common, size = look_at(docs, tokenizer)
    keyed = docs.select("doc_id", "text", *(key.alias(name) for name, key in keys.items()))
    ranged = keyed.repartitionByRange(size // FILE_TEXT_BYTES + 1, *keys).sortWithinPartitions(*keys)
    numbered = ranged.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    token_ids(numbered, tokenizer, end_id, common).write.options(**ORC_OPTIONS).orc(folder)


def read_tokens(spark: SparkSession, folder: str, doc_id_type: str = "bigint") -> DataFrame:
    """(doc_id, row, ids) of a folder of ``write_tokens``; filters on doc_id skip stripes and groups of rows."""
    return spark.read.schema(f"doc_id {doc_id_type}, row bigint, ids array<int>").orc(folder)


def token_index(table: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the rows of ``read_tokens``.

    ``start`` is the number of ids before the document in the order of ``row``:
    the sum of the files before, a row a file, and a running sum in each file.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat, offsets = ids.values.to_numpy().astype("<u4", copy=False), ids.offsets.to_numpy()
            crcs = [zlib.crc32(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            columns = [batch.column("doc_id"), batch.column("row"), np.diff(offsets).astype(np.int64), np.array(crcs, np.int64)]
            yield pa.RecordBatch.from_arrays([*columns[:2], *map(pa.array, columns[2:])], ["doc_id", "row", "n_tokens", "ids_crc32"])

    kind = table.schema["doc_id"].dataType.simpleString()
    rows = table.select("doc_id", "row", "ids").mapInArrow(
        digest, f"doc_id {kind}, row bigint, n_tokens bigint, ids_crc32 bigint"
    )
    rows = staged(rows).withColumn("file", F.shiftrightunsigned("row", 33))
    sums = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1))
    sums = sums.select("file", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.sum("n_tokens").over(W.partitionBy("file").orderBy("row")) - F.col("n_tokens")
    placed = rows.withColumn("within", within).join(sums, "file")
    return placed.select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def tokenize(docs: DataFrame, tokenizer: str, folder: str | None = None, order: list[Column] | None = None) -> DataFrame:
    """Writes the token files of ``docs`` (a new shared folder by default) and returns their index, read from them."""
    folder = folder or new_folder(docs.sparkSession)
    write_tokens(docs, folder, tokenizer, order)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return token_index(read_tokens(docs.sparkSession, folder, kind))
