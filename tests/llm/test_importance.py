import hashlib
import math
import random
import re
import zlib

import pytest
from llm_data import edge_docs, empty_docs, prose, texts, tuples

from slotwise.llm import importance

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def plain_features(text):
    w = plain_words(text)
    return [zlib.crc32(b" ".join(w[i : i + n])) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def plain(docs, target, percent=5):
    source, aim = [0] * 10000, [0] * 10000
    for counts, rows in ((source, [t for _, t in docs]), (aim, target)):
        for text in rows:
            for b in plain_features(text):
                counts[b] += 1
    a, b = sum(source), sum(aim)
    gain = [math.floor(1000 * math.log((t + 1) * (a + 10000) / ((s + 1) * (b + 10000)))) for s, t in zip(source, aim)]
    rows = []
    for doc_id, text in docs:
        features = plain_features(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        weight = sum(gain[x] for x in features)
        rows.append([doc_id, len(plain_words(text)), len(features), weight, weight + noise, None])
    able = [r for r in rows if r[1] >= 20]
    able.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for i, r in enumerate(able[: percent * len(able) // 100], 1):
        r[5] = i
    return sorted(map(tuple, rows), key=str)


COLUMNS = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]


def as_plain(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("percent", [5, 40, 100])
def test_draw_of_awkward_rows(spark, percent):
    target = [prose(6, 300), None, "", prose(3, 40), "A a a"]
    aims = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    found = importance.resample(edge_docs(spark), aims, percent)
    assert as_plain(found) == plain(texts(), target, percent)


@pytest.mark.parametrize("rows", [0, 1])
def test_empty_tables(spark, rows):
    aims = spark.createDataFrame([("x y",)] * rows, "text string")
    assert importance.resample(empty_docs(spark), aims).count() == 0
    if not rows:
        docs = spark.createDataFrame([(1, prose(1, 30)), (2, None)], "doc_id bigint, text string")
        assert as_plain(importance.resample(docs, aims, 100)) == plain([(1, prose(1, 30)), (2, None)], [], 100)


def test_words_are_those_of_the_pattern_with_their_offsets():
    random.seed(5)
    alphabet = "aZ09 \t\n.-_é漢\x00\x7f~{"
    words = importance.Words()
    for n in (0, 1, 5, 300, 20000):
        low = "".join(random.choice(alphabet) for _ in range(n)).encode().translate(importance.LOWER)
        found = [(w.encode(), start + a, start + b) for start, ws, at in words(low) for w, (a, b) in zip(ws, at, strict=True)]
        assert found == [(m[0], *m.span()) for m in WORD.finditer(low)]
        assert all(low[a:b] == w for w, a, b in found)


@pytest.mark.parametrize("size", [1, 7, 50, 10**6])
def test_features_do_not_depend_on_slices(size, monkeypatch):
    monkeypatch.setattr(importance.slices, "__defaults__", (size,))
    for _, text in texts()[:12] + [(0, "x" * 5000 + " " + "y z " * 40)]:
        n, found = importance.bucket_runs((text or "").encode(), importance.Words())
        assert n == len(plain_words(text))
        assert sorted(found.tolist()) == sorted(plain_features(text))


def test_ranks_are_whole_over_many_tasks(spark):
    rows = spark.range(5000).selectExpr("id", "id % 7 as score")
    found = importance.ranked(rows.orderBy("id"), [rows["score"].desc(), rows["id"]], task_rows=300)
    order = sorted(range(5000), key=lambda i: (-(i % 7), i))
    assert tuples(found, "rank", "id") == [(k + 1, i) for k, i in enumerate(order)]


def test_documents_like_the_target_are_drawn(spark):
    r = random.Random(9)
    special = lambda n: " ".join(f"term{r.randrange(60)}" for _ in range(n))
    aim = [special(300) for _ in range(3)]
    docs = [(i, special(100) if i % 10 == 0 else prose(100 + i, 100)) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    aims = spark.createDataFrame([(t,) for t in aim], "text string")
    drawn = [r["doc_id"] for r in importance.resample(df, aims, 10).where("rank is not null").collect()]
    assert len(drawn) == 20 and sum(i % 10 == 0 for i in drawn) >= 15
