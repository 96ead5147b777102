import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import edge_docs, empty_docs, in_order, texts, tuples

from slotwise.llm import substring


def plain(rows, window):
    first = {}
    split = [(i, (t or "").split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - window + 1):
            gram = tuple(w[k : k + window])
            if i is not None:
                first[gram] = min(i, first.get(gram, i))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return in_order(out)


def test_awkward_rows(spark):
    found = substring.remove_repeats(edge_docs(spark).drop("n_words"), 50)
    assert tuples(found, "doc_id", "n_words", "n_removed", "text") == plain(texts(), 50)


def test_clashing_columns_are_kept_or_replaced(spark):
    docs = edge_docs(spark)
    found = substring.remove_repeats(docs, 50)
    assert set(found.columns) == set(docs.columns) | {"n_removed"}
    assert found.schema["n_words"].dataType.simpleString() == "bigint"


def test_empty_table(spark):
    assert substring.remove_repeats(empty_docs(spark), 50).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), max_size=8), st.integers(2, 7))
def test_small_windows_of_few_words(spark, docs, window):
    rows = [(i, " ".join(words)) for i, words in enumerate(docs)]
    found = substring.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), window)
    assert tuples(found, "doc_id", "n_words", "n_removed", "text") == plain(rows, window)


def test_doubling_goes_on_until_nothing_is_left(spark):
    shared = [f"w{i}" for i in range(37)]
    rows = [(1, " ".join(["x", *shared, "y"])), (2, " ".join([*shared, "z"])), (3, " ".join(shared[:9]))]
    _, levels = substring.repeated_windows(spark.createDataFrame(rows, "doc_id bigint, text string"), 4, None)
    lengths = {}
    for r in levels.collect():
        lengths.setdefault(r["doc_id"], {})[r["length"]] = sorted(r["places"])
    assert {k: max(v) for k, v in lengths.items()} == {1: 32, 2: 32, 3: 8}
    assert lengths[2][32] == list(range(6)) and lengths[1][16] == list(range(1, 23))


def test_hashes_tell_sequences_apart():
    words = substring.Windows(b"a b a b a c a b a b")
    for length in (1, 2, 3, 4):
        sums = words.sums(length).tolist()
        grams = [tuple(words.words[i : i + length]) for i in range(len(sums))]
        assert len(set(sums)) == len(set(grams))
        assert all((x == y) == (a == b) for x, a in zip(sums, grams) for y, b in zip(sums, grams))


def test_every_run_holds_an_anchor():
    hashes = np.random.default_rng(5).integers(0, 9, 300).astype(np.uint64)
    found = substring.anchors(hashes, 7)
    for i in range(len(hashes) - 6):
        assert any(i <= x < i + 7 for x in found)
    assert len(substring.anchors(hashes[:6], 7)) == 0
