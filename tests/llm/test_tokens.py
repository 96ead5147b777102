import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_data import edge_docs, empty_docs, texts, tuples
from tokenizers import Tokenizer

from slotwise.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "é", "ß", " ", " ", "  ", "\n", "\t", "\xa0", "\u3000", "'s", "9", "<|endoftext|>", "\0", "漢", "🙂", ".", "!!"]
PARTS += ["\x1c", "\x85", "the", "ing", "\r\n", "_", "\x0b", "word. Word\nNext"]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def encoded(encoder, some):
    return [ids for _, _, part in encoder.encode(pa.array(some, pa.string())) for ids in part.to_pylist()]


def test_pieces_make_the_ids_of_whole_texts(plain, monkeypatch):
    monkeypatch.setattr(tokens, "RUN_BYTES", 64)
    monkeypatch.setattr(tokens, "MAX_KNOWN", 50)
    monkeypatch.setattr(tokens, "OUT_IDS", 40)
    r = random.Random(2)
    encoder = tokens.PieceEncoder(PATH, 0)
    for _ in range(300):
        some = ["".join(r.choice(PARTS) for _ in range(r.randrange(30))) for _ in range(r.randrange(1, 12))]
        assert encoded(encoder, some) == [plain(x) for x in some]


def test_common_pieces_change_nothing(spark, plain):
    docs = edge_docs(spark)
    common, size = tokens.look_at(docs, PATH)
    assert len(common.pieces) > 100 and size == sum(len((t or "").encode()) for _, t in texts())
    some = [t or "" for _, t in texts()]
    assert encoded(tokens.PieceEncoder(PATH, 0, common), some) == [plain(x) for x in some]


def test_the_driver_encodes_nothing(spark, plain, monkeypatch):
    driver = os.getpid()

    class Refused:
        @staticmethod
        def from_file(path):
            assert os.getpid() != driver
            return Tokenizer.from_file(path)

    monkeypatch.setattr(tokens, "Tokenizer", Refused)
    common, _ = tokens.look_at(edge_docs(spark), PATH)
    check(spark, texts(), tokens.tokenize(edge_docs(spark), PATH), plain)
    pieces, ends = common.pieces.to_pylist(), np.cumsum(common.counts)
    assert len(set(pieces)) == len(pieces) > 100 and ends[-1] == len(common.ids)
    for piece, n, end in zip(pieces, common.counts.tolist(), ends.tolist(), strict=True):
        assert common.ids[end - n : end].tolist() == plain(piece)[:-1]


def test_the_pieces_are_those_of_a_bounded_draw(spark, monkeypatch):
    monkeypatch.setattr(tokens, "COMMON_ROWS", 20)
    docs = spark.range(0, 2000, 1, 4).selectExpr("id as doc_id", "'w' || repeat('x', cast(id as int)) as text")
    assert 0 < len(tokens.look_at(docs, PATH)[0].pieces) < 60


def check(spark, rows, found, plain):
    expected = [(d, len(plain(t)), zlib.crc32(np.array(plain(t), "<u4").tobytes())) for d, t in rows]
    got = found.collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((str(d), *x) for d, *x in expected)
    got.sort(key=lambda r: r["start"])
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    return [r["doc_id"] for r in got]


def test_round_trip_in_id_order(spark, plain, tmp_path, monkeypatch):
    monkeypatch.setattr(tokens, "FILE_TEXT_BYTES", 20000)
    folder = str(tmp_path / "tokens")
    order = check(spark, texts(), tokens.tokenize(edge_docs(spark), PATH, folder), plain)
    named = [x for x in order if x is not None]
    assert order[: order.count(None)] == [None] * order.count(None) and named == sorted(named)
    back = tokens.read_tokens(spark, folder).where("doc_id = 5").collect()
    assert [r["ids"] for r in back] == [plain(texts()[5][1])]


def test_other_order_and_empty_table(spark, plain):
    from pyspark.sql import functions as F

    order = check(spark, texts(), tokens.tokenize(edge_docs(spark), PATH, order=[-F.col("doc_id")]), plain)
    named = [x for x in order if x is not None]
    assert named == sorted(named, reverse=True)
    assert tokens.tokenize(empty_docs(spark), PATH).count() == 0


def test_files_have_indexes_and_bloom_filters(spark, tmp_path):
    from pathlib import Path

    from pyarrow import orc

    folder = tmp_path / "tokens"
    tokens.write_tokens(edge_docs(spark), str(folder), PATH)
    files = sorted(Path(folder).glob("*.orc"))
    assert files
    found = [orc.ORCFile(str(f)) for f in files]
    assert all(f.row_index_stride == 1000 for f in found)
    assert sum(f.nrows for f in found) == len(texts())
    assert any(f.content_length > 0 and b"doc_id" in Path(p).read_bytes() for f, p in zip(found, files, strict=True))
    assert tuples(tokens.read_tokens(spark, str(folder)), "doc_id")


def test_the_size_counts_texts_that_are_read_late(spark, monkeypatch):
    monkeypatch.setattr(tokens, "COMMON_ROWS", 10)
    docs = spark.range(0, 100, 1, 1).selectExpr("id as doc_id", "if(id < 90, 'a', repeat('é', 5000)) as text")
    assert tokens.look_at(docs, PATH)[1] == 90 + 10 * 10000
