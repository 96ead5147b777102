import random

import numpy as np
import pytest
from llm_data import edge_docs, empty_docs, texts

from slotwise.llm import language_id


def network(languages=("x", "y"), seed=1):
    return language_id.Network(list(languages), hidden=4, seed=seed)


def test_gradients_are_those_of_the_loss():
    net = network()
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    x = np.array([[1, 2, 3, 2], [5, 1, 256, 256], [3, 3, 7, 256]], np.int16)
    y = np.array([0, 1, 1])

    def loss():
        logits, _ = net._forward(x)
        p = np.exp(logits - logits.max(-1, keepdims=True))
        p /= p.sum(-1, keepdims=True)
        mask = (x.T != language_id.PAD)
        return -(np.log(p[:, np.arange(3), y]) * mask).sum() / mask.sum()

    grads = net._gradients(x, y)
    for name, at in [("bytes", (0, 2, 5)), ("bytes", (1, 3, 9)), ("states", (1, 2, 7)), ("out", (0, 1, 1)), ("bias", (0,))]:
        kept = net.weights[name][at]
        net.weights[name][at] = kept + 1e-3
        up = loss()
        net.weights[name][at] = kept - 1e-3
        down = loss()
        net.weights[name][at] = kept
        assert abs((up - down) / 2e-3 - grads[name][at]) < 1e-3


def test_fast_labels_are_those_of_the_forward_pass():
    net = network(seed=3)
    rows = language_id._sequences(bytes(range(256)) + b"tail", language_id.RUN_BYTES)
    logits, _ = net._forward(rows)
    p = np.exp(logits - logits.max(-1, keepdims=True))
    p = p / p.sum(-1, keepdims=True) * (rows.T != language_id.PAD)[..., None]
    assert np.allclose(net._label_sums(rows), p.sum(0), atol=1e-4)
    found = net.probabilities([bytes(range(256)) + b"tail", b"", b"a" * 400000])
    assert np.allclose(found[0], p.sum((0, 1)) / 260, atol=1e-4)
    assert np.allclose(found.sum(1), [1, 0, 1], atol=1e-3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = "crc32(cast(doc_id as string)) % 4 = 2"
    net = language_id.train(docs.where(f"not {held}"), rows=800)
    rows = language_id.predict(docs.where(held), net).select("lang", "lang_pred", "score").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_awkward_rows(spark):
    docs = edge_docs(spark)
    net = language_id.train(docs, rows=20)
    assert net.languages == ["de", "en"]
    rows = language_id.predict(docs, net).select("doc_id", "text", "lang_pred", "score").collect()
    assert len(rows) == len(texts())
    for r in rows:
        lettered = any(c.isalpha() for c in r["text"] or "")
        assert r["lang_pred"] in (net.languages if lettered else ["und"])
        assert (r["score"] > 0) == lettered
    kept = language_id.keep_identified(docs, net, 0.0)
    assert kept.columns == docs.columns
    assert kept.count() == sum(any(c.isalpha() for c in t or "") for _, t in texts())


def test_without_rows_or_labels(spark):
    docs = edge_docs(spark)
    assert language_id.train(empty_docs(spark)) is None
    assert language_id.train(docs.where("lang is null")) is None
    assert {r["lang_pred"] for r in language_id.predict(docs, None).collect()} == {"und"}
    assert language_id.predict(empty_docs(spark), network()).count() == 0


def test_the_sample_is_bounded(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('abc def ', 200) as text", "'en' as lang")
    rows = language_id.training_rows(docs, rows=50, chars=20).collect()
    assert len(rows) == 50 and all(len(r["text"]) <= 20 for r in rows)


def strangers() -> dict[str, str]:
    """Junk, and texts in languages and scripts that the tables lack."""
    r = random.Random(1)
    made = lambda letters: " ".join("".join(r.choices(letters, k=r.randint(3, 9))) for _ in range(80))
    return {
        "consonants": made("bcdfghjklmnpqrstvwxz"),
        "letters": made("abcdefghijklmnopqrstuvwxyz"),
        "hex": " ".join(f"{r.getrandbits(128):032x}" for _ in range(20)),
        "code": "for(int i=0;i<n;i++){a[i]=b[i]*c[i];} return x->y; " * 5,
        "finnish": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. " * 4,
        "polish": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. " * 4,
        "russian": "Все люди рождаются свободными и равными в своем достоинстве и правах. " * 4,
        "chinese": "人人生而自由,在尊严和权利上一律平等。" * 8,
    }


@pytest.mark.parametrize("languages", [["en"], ["de", "en"], ["de", "en", "es", "fr"]])
def test_texts_in_no_learned_language_go(spark, languages):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    held = "crc32(cast(doc_id as string)) % 4 = 2"
    known = docs.where(docs["lang"].isin(languages))
    net, limits = language_id.train_with_limits(known.where(f"not {held}"), rows=800)
    assert net.languages == languages
    rows = [(name, text, None) for name, text in strangers().items()]
    others = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    assert language_id.keep_learned(others, net, limits).collect() == []
    clean = known.where(held).where(r"text rlike '\\p{L}'")
    kept = language_id.keep_learned(clean, net, limits)
    assert kept.columns == docs.columns
    assert kept.count() >= 0.995 * clean.count()


def test_limits_of_few_rows(spark):
    docs = edge_docs(spark)
    net, limits = language_id.train_with_limits(docs, rows=20)
    assert language_id.keep_learned(docs, net, limits).columns == docs.columns
    assert language_id.train_with_limits(empty_docs(spark)) == (None, None)
    assert language_id.keep_learned(docs, None, None).count() == 0
    one = docs.where("lang is not null and doc_id = 1 or doc_id = 2")
    net, limits = language_id.train_with_limits(one)
    assert language_id.keep_learned(one, net, limits).count() > 0


def test_familiarity_of_a_long_text_is_that_of_its_parts():
    net = network()
    limits = language_id._limits(net, [("ab cd ab ef", "x"), ("xy zy xy zz", "y"), ("ab ab cd", "x"), ("xy xy zy", "y")])
    limits.between = 1.0
    one, many = (limits.distance_of(b"ab cd ef " * n, "x") for n in (1000, 200_000))
    assert np.isfinite([one, many]).all() and abs(one - many) < 0.01


def test_repeated_ids_leave_a_whole_sample(spark):
    rows = [(7, f"wort {i} und noch ein satz", "de") for i in range(3000)] + [(7, f"words {i} and one more", "en") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    sample = language_id._sample(docs, 50, 200)
    assert len(sample) == 50 and {lang for _, lang in sample} == {"de", "en"}
    same = spark.createDataFrame([(7, "ein satz", "de")] * 500, docs.schema)
    assert language_id._sample(same, 50, 200) == [("ein satz", "de")] * 50
