import math
from collections import Counter
from fractions import Fraction

import pytest
from llm_data import edge_docs, empty_docs, texts

from slotwise.llm import mixing


@pytest.mark.parametrize("shares", [{"a": 1}, {"a": 1, "b": 1}, {"a": 7, "b": 2, "c": 1}, {"a": 97, "b": 53, "c": 11, "d": 3}])
def test_every_block_is_within_its_window(shares):
    slots, period = mixing.schedule(shares), sum(shares.values())
    assert Counter(slots) == Counter(shares)
    done = Counter()
    for t, s in enumerate(slots):
        w, i = Fraction(shares[s], period), done[s]
        assert math.floor(i / w) <= t < math.ceil((i + 1) / w)
        done[s] += 1
        assert all(abs(done[x] - Fraction(n, period) * (t + 1)) < 1 for x, n in shares.items())


def test_shares_add_up():
    assert mixing.shares_of({"a": 1.0, "b": 1.0, "c": 1.0}, 10) == {"a": 4, "b": 3, "c": 3}
    assert sum(mixing.shares_of({str(i): 1 / (i + 1) for i in range(70)}).values()) == mixing.SHARES
    assert mixing.shares_of({}) == {}
    with pytest.raises(ValueError):
        mixing.shares_of({"a": 0.0})


def plain_slots(shares, blocks):
    """The source of every slot, by running the schedule and starting it anew when a source is used up."""
    left, out = dict(blocks), []
    while live := {s: n for s, n in shares.items() if left.get(s, 0) > 0}:
        divisor = math.gcd(*live.values())
        slots, t = mixing.schedule({s: n // divisor for s, n in live.items()}), 0
        while all(left[s] > 0 for s in live):
            s = slots[t % len(slots)]
            out.append(s)
            left[s] -= 1
            t += 1
    return out


@pytest.mark.parametrize("weights", [None, {"a": 3.0, "b": 1.0}, {"a": 0.2, "b": 0.2, "": 0.6, "unused": 5.0}])
def test_the_mix_is_the_schedule(spark, weights):
    docs = edge_docs(spark)
    rows = mixing.mix(docs, weights, block_docs=2, bucket_rows=4).collect()
    assert len(rows) == len(texts())
    assert len({(r["slot"], r["place"]) for r in rows}) == len(rows)
    counts = Counter(r["source"] or "" for r in rows)
    weights = weights or mixing.tempered(counts)
    weights = {s: weights.get(s, min(weights.values())) for s in sorted(counts)}
    expected = plain_slots(mixing.shares_of(weights), {s: -(-n // 2) for s, n in counts.items()})
    found = {r["slot"]: r["source"] or "" for r in rows}
    assert [found[t] for t in range(len(found))] == expected
    blocks = {}
    for r in rows:
        blocks.setdefault((r["source"], r["block"]), set()).add(r["slot"])
    assert all(len(x) == 1 for x in blocks.values())


def test_buckets_do_not_change_blocks(spark):
    docs = edge_docs(spark)
    few = {(r["doc_id"], r["text"]): r["slot"] // 1 for r in mixing.mix(docs, None, 100, 1000).collect()}
    many = {(r["doc_id"], r["text"]): r["slot"] // 1 for r in mixing.mix(docs, None, 100, 2).collect()}
    assert few == many


def test_empty_table(spark):
    assert mixing.mix(empty_docs(spark)).count() == 0


def test_files_are_in_mix_order(spark, tmp_path):
    docs = edge_docs(spark)
    mixing.in_mix_order(docs, block_docs=2).write.parquet(str(tmp_path / "mixed"))
    back = spark.read.parquet(str(tmp_path / "mixed"))
    assert back.columns == docs.columns
    rows = back.selectExpr("source", "_metadata.file_name f", "_metadata.row_index i").orderBy("f", "i").collect()
    slots = sorted((r["slot"], r["place"], r["source"]) for r in mixing.mix(docs.select("doc_id", "text", "source"), block_docs=2).collect())
    assert [r["source"] for r in rows] == [s for _, _, s in slots]


@pytest.mark.parametrize(
    "weights",
    [
        {"hot": 0.5} | {f"s{i}": 0.5 / 99 for i in range(99)},
        {"hot": 0.9} | {f"s{i}": 0.1 / 499 for i in range(499)},
        mixing.tempered({"hot": 100_000} | {f"s{i}": 10_000 + 7 * i for i in range(19)}),
    ],
)
def test_every_prefix_is_within_a_block_of_the_given_weights(weights):
    total = sum(map(Fraction, weights.values()))
    exact, done = {s: Fraction(w) / total for s, w in weights.items()}, Counter()
    found = mixing.places(mixing.shares_of(weights), {s: int(7000 * w) + 10 for s, w in exact.items()})
    for s, block, t in found:
        assert block == done[s]
        done[s] += 1
        if t == 6250:
            break
        # a source is furthest behind just before one of its blocks, furthest ahead just after it
        assert block - exact[s] * t > -1 and block + 1 - exact[s] * (t + 1) < 1
    assert all(abs(done[s] - exact[s] * (t + 1)) < 1 for s in weights)


def test_a_mix_keeps_large_weights_beside_many_small_ones(spark):
    docs = spark.range(9000).selectExpr("id as doc_id", "if(id < 4500, 'hot', 's' || id % 99) as source")
    weights = {"hot": 0.5} | {f"s{i}": 0.5 / 99 for i in range(99)}
    rows = mixing.mix(docs, weights, block_docs=1).where("slot < 4000").collect()
    assert len(rows) == 4000 and abs(sum(r["source"] == "hot" for r in rows) - 2000) <= 1


def test_a_source_of_many_parts_has_every_slot_once(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "if(id % 5 = 0, 'b', 'a') as source")
    rows = mixing.mix(docs, {"a": 4, "b": 1}, block_docs=1).collect()
    assert sorted(r["slot"] for r in rows) == list(range(5000))
    assert sum(r["source"] == "b" for r in rows if r["slot"] < 2500) == 500
