import re

import pytest
from llm_data import CLASHING, edge_docs, empty_docs, in_order, prose, texts, tuples

from slotwise.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


ITEMS = [
    (1, " ".join(texts()[4][1].split()[45:60])),
    (2, "One"),
    (2, "two"),
    (3, None),
    (4, "...!"),
    (None, "a a"),
    (5, prose(8, 50).upper()),
    (5, prose(8, 50)),
    (6, "never there at all"),
]


def plain(rows, items, n=10):
    grams = {}
    for i, t in items:
        w = words(t)
        k = min(n, len(w))
        for at in range(len(w) - k + 1 if w and i is not None else 0):
            grams.setdefault(tuple(w[at : at + k]), set()).add(str(i))
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for k in {len(g) for g in grams}:
            for at in range(len(w) - k + 1):
                if owners := grams.get(tuple(w[at : at + k])):
                    hit.update(range(at, at + k))
                    found |= owners
        out.append((i, len(w), len(hit), ",".join(sorted(found)), bool(hit)))
    return in_order(out)


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_hits_in_one_and_in_many_blocks(spark, block_bytes):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = decontaminate.count_hits(decontaminate.find_hits(edge_docs(spark), bench, 10, block_bytes))
    got = tuples(found.selectExpr("*", "array_join(items, ',') as joined"), "doc_id", "n_words", "n_hit", "joined", "contaminated")
    assert got == plain(texts(), ITEMS)


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.find_hits(empty_docs(spark), bench).count() == 0
    assert decontaminate.drop_contaminated(edge_docs(spark), bench).count() == len(texts())


def test_contaminated_rows_go(spark):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = edge_docs(spark)
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and CLASHING > 5
    clean = [(r[0],) for r in plain(texts(), ITEMS) if not r[4]]
    assert tuples(kept, "doc_id") == in_order(clean)


def test_spans_are_cut_out(spark):
    bench = spark.createDataFrame([(1, "secret answer is")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "The Secret, answer IS: 42.", 7), (2, None, 8), (3, "clean", 9)], "doc_id int, text string, x int")
    found = decontaminate.remove_spans(docs, bench, 10)
    assert tuples(found, *docs.columns) == [(1, "The ,  : 42.", 7), (2, None, 8), (3, "clean", 9)]


def test_copies_of_an_item_do_not_fill_a_block(spark):
    rows = [(i, f"item {i} of the benchmark") for i in range(40)] + [(1, "item 1 of the benchmark")] * 400
    bench = spark.createDataFrame(rows, "item_id bigint, text string")
    blocks = list(decontaminate._blocks(bench, 300))
    assert sum(len(x) for x in blocks) == 40
    assert max(sum(len(text) for _, text in x) for x in blocks) < 1200
