import random
from collections import Counter

import pytest
import xxhash
from llm_data import edge_docs, empty_docs, in_order, prose, texts, tuples
from pyspark.sql import functions as F

from slotwise.llm import simhash


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\v", " ").split()
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    counts = Counter()
    for gram in grams:
        h = xxhash.xxh64_intdigest(gram.encode(), 42)
        counts.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b, n in counts.items() if 2 * n > len(grams))


def plain_components(fingerprints, max_bits=3):
    parent = list(range(len(fingerprints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(fingerprints):
        for j in range(i):
            if (a ^ fingerprints[j]).bit_count() <= max_bits:
                a_, b_ = root(i), root(j)
                parent[max(a_, b_)] = min(a_, b_)
    return [root(i) for i in range(len(fingerprints))]


def expected(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(fps)
    smallest = {}
    for (doc_id, _), r in zip(rows, roots, strict=True):
        if doc_id is not None:
            smallest[r] = min(doc_id, smallest.get(r, doc_id))
    return in_order([(d, f"{fp:016x}", smallest.get(r)) for (d, _), fp, r in zip(rows, fps, roots, strict=True)])


def test_classes_of_awkward_rows(spark):
    found = simhash.near_duplicates(edge_docs(spark))
    assert tuples(found, "doc_id", "fingerprint", "component_id") == expected(texts())


def test_fingerprint_is_spark_xxhash64(spark):
    text = "Größe wxy zé"
    (row,) = spark.range(1).select(F.xxhash64(F.lit("größe wxy zé".replace("ö", "ö"))).alias("h")).collect()
    assert simhash.fingerprint(text.encode()) == row["h"]


def test_empty_table(spark):
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0
    assert simhash.drop_near_duplicates(empty_docs(spark)).count() == 0


def clouds(seed):
    r = random.Random(seed)
    out = set()
    for _ in range(12):
        centre = r.getrandbits(64)
        for _ in range(40):
            x = centre
            for b in r.sample(range(64), r.randrange(5)):
                x ^= 1 << b
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("max_bits", [1, 3])
def test_links_are_all_pairs_within_the_distance(spark, max_bits):
    fps = [x - (1 << 64) if x >> 63 else x for x in clouds(max_bits)]
    table = spark.createDataFrame([(x,) for x in fps], "fp bigint")
    found = {tuple(r) for r in simhash.links(table, max_bits).collect()}
    assert found == {
        (a, b) for a in fps for b in fps if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits
    }


def test_crowded_buckets_keep_components(spark):
    fps = [x - (1 << 64) if x >> 63 else x for x in clouds(9)[:150]]
    table = spark.createDataFrame([(x,) for x in fps], "fp bigint")
    found = [tuple(r) for r in simhash.links(table, 3, max_bucket=3).collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 for a, b in found)
    at = {x: i for i, x in enumerate(fps)}
    parent = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for a, b in found:
            low = min(parent[at[a]], parent[at[b]])
            for i in (at[a], at[b]):
                changed |= parent[i] != low
                parent[i] = low
    assert parent == plain_components([x & (1 << 64) - 1 for x in fps])


def test_one_of_each_class_stays(spark):
    docs = edge_docs(spark)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    named = [x for x in ids if x is not None]
    # one row a class: id 9 stands for two texts that have nothing to do with each other
    assert sorted(named) == sorted(d for d, _ in plain_kept(texts()) if d is not None)
    assert named.count(9) == 2
    assert ids.count(None) == 2


def plain_kept(rows):
    """One (doc_id, text) for each class, by its smallest id; of rows without id one for each text."""
    fps = [plain_fingerprint(t) for _, t in rows]
    classes = {}
    for (doc_id, text), root in zip(rows, plain_components(fps), strict=True):
        classes.setdefault(("text", text or "") if doc_id is None else root, []).append((doc_id, text))
    return [(min((d for d, _ in found if d is not None), default=None), {t for _, t in found}) for found in classes.values()]


def test_rows_of_one_id_with_other_texts_are_judged_apart(spark):
    a, b, c = prose(21, 60), prose(22, 60), prose(23, 60)
    rows = [(1, a), (5, a), (5, b), (7, b), (7, c), (7, c), (None, c), (None, c), (None, None), (9, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id bigint, text string, source string")
    found = [(r["doc_id"], r["text"]) for r in simhash.drop_near_duplicates(docs).collect()]
    assert len(found) == len(plain_kept(rows)) == 6
    for doc_id, texts_ in plain_kept(rows):
        assert sum(d == doc_id and t in texts_ for d, t in found) == 1
    assert {t for _, t in found} >= {a, b, c}


def test_the_row_that_stays_does_not_depend_on_the_order(spark):
    words = prose(24, 80).split()
    near = [" ".join([*words[:i], "other", *words[i + 1 :]]) for i in range(0, 80, 9)]
    rows = [(3, t, s) for t in near for s in "xyz"]
    schema = "doc_id bigint, text string, source string"
    results = {tuple(map(tuple, simhash.drop_near_duplicates(spark.createDataFrame(x, schema).repartition(n)).collect())) for n, x in ((1, rows), (5, rows[::-1]))}
    assert len(results) == 1
