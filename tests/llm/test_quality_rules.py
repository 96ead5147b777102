import re
from collections import Counter

import pytest
from llm_data import edge_docs, empty_docs, in_order, texts, tuples

from slotwise.llm import quality_rules

EXTRA = [
    (101, "a b c a b c\na b c\n \nx y z\nx y z"),
    (102, "% | word$ #tag <b> &"),
    (103, "a a a a"),
    (104, "l\r\nl\r\nm\x0bn\x0co"),
    (105, "x y x y x"),
]


def plain(rows):
    out = []
    for i, t in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        grams = Counter(zip(w, w[1:], w[2:]))
        again = {p for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for p in range(k, k + 3)}
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        symbols = len(re.findall(r"[#*$%&|<>]", t))
        out.append((i, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(again), failed))
    return in_order(out)


def test_measures(spark):
    docs = edge_docs(spark).select("doc_id", "text").unionByName(spark.createDataFrame(EXTRA, "doc_id bigint, text string"))
    found = quality_rules.score(docs)
    columns = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    assert tuples(found, *columns) == plain(texts() + EXTRA)
    assert found.where("kept and base_failed").count() == 0


def test_clashing_columns_and_empty_table(spark):
    assert quality_rules.score(edge_docs(spark)).count() == len(texts())
    assert quality_rules.score(empty_docs(spark)).count() == 0


def test_estimate_finds_the_better_rules():
    patterns = [((1, 1, 1), 9000), ((-1, -1, 1), 800), ((-1, -1, -1), 150), ((1, 1, -1), 300), ((0, 0, 1), 200)]
    found = quality_rules.estimate(patterns)
    assert found.posterior((1, 1, 1)) > 0.9
    assert found.posterior((-1, -1, 1)) < 0.1
    assert found.posterior((1, 1, -1)) > 0.5
    assert quality_rules.estimate([]).good == 0.5


def test_column_is_the_posterior(spark):
    rules = quality_rules.RULES[:2]
    found = quality_rules.estimate([((1, 1), 90), ((-1, -1), 10), ((0, 1), 5)])
    rows = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    table = spark.createDataFrame(rows, ", ".join(f"{r.name} int" for r in rules))
    for r in table.withColumn("p", found.posterior_column(rules)).collect():
        assert r["p"] == pytest.approx(found.posterior((r[0], r[1])))


def test_labels_of_the_table(spark):
    sf = "/root/testdata/sf0.01"
    scored = quality_rules.score(spark.read.parquet(f"{sf}/documents.parquet"))
    joined = scored.where("not base_failed").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    right = joined.where("kept = (quality = 1)").count()
    assert right >= 0.98 * joined.count()
