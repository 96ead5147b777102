"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.staging import staged

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MARKS = "!\"#$%&'()*+,-./0123456789:;<=>?@[\\]^_`{|}~"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """Votes bad (-1) where ``value`` is in one of the bad ranges, good (1) in the good one, else abstains (0).

    Ranges are half-open; a null value abstains.
    """

    name: str
    value: str
    good: tuple[float, float]
    bad: tuple[tuple[float, float], ...]

    def vote(self) -> Column:
        x = F.expr(self.value)
        within = lambda r: (x >= r[0]) & (x < r[1])
        bad = F.lit(False)
        for r in self.bad:
            bad = bad | within(r)
        return F.when(bad, -1).when(within(self.good), 1).otherwise(0)


INF = math.inf
RULES = (
    Rule("symbols", "try_divide(n_symbols, n_words)", (0, 0.02), ((0.1, INF),)),
    Rule("letters", "1 - try_divide(n_marks, word_chars)", (0.93, INF), ((0, 0.9),)),
    Rule("repeats", "try_divide(n_repeat_words, n_words)", (0, 0.15), ((0.3, INF),)),
    Rule("lines", "if(n_lines > 2, try_divide(n_dup_lines, n_lines), null)", (0, 0.1), ((0.3, INF),)),
    Rule("word_length", "try_divide(word_chars, n_words)", (4, 8), ((0, 3), (11, INF))),
    Rule("capitals", "try_divide(n_capitals, word_chars)", (0, 0.08), ((0.25, INF),)),
    Rule("variety", "try_divide(n_distinct, n_words)", (0.4, INF), ((0, 0.2),)),
)


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of each text that the rules use, none of which needs a shuffle.

    Words are runs of other than ASCII white space. n_dup_lines counts lines
    with a word that equal an earlier line, n_repeat_words the words in 3-word
    windows that stand twice or more in the text; windows are compared by 64
    bits within the text. A null text is empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(F.translate(text, SPACE, " " * len(SPACE)), " "), "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    out = docs.select("doc_id", text.alias("text")).withColumns({"words": words, "lines": lines})
    out = out.select(
        "doc_id",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.length(_without(F.col("text"), SPACE)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length("text") - F.length(_without(F.col("text"), MARKS))).cast("long").alias("n_marks"),
        (F.length("text") - F.length(_without(F.col("text"), CAPITALS))).cast("long").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    measures = [x for x in out.columns if x != "words"]
    gram = "transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2]))"
    out = out.select(*measures, F.expr(f"if(size(words) > 2, {gram}, cast(array() as array<bigint>))").alias("grams"))
    placed = "array_sort(transform(grams, (g, i) -> struct(g, i)))"
    none = "cast(array() as array<struct<g:bigint,i:int>>)"
    out = out.select(*measures, F.expr(f"if(size(array_distinct(grams)) < size(grams), {placed}, {none})").alias("sorted"))
    again = "(k > 0 and sorted[k - 1].g = x.g) or (k + 1 < size(sorted) and sorted[k + 1].g = x.g)"
    out = out.select(*measures, F.expr(f"array_sort(transform(filter(sorted, (x, k) -> {again}), x -> x.i))").alias("at"))
    covered = F.aggregate(
        "at",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda sum_, i: F.struct(
            (sum_["n"] + i + 3 - F.greatest(sum_["end"], i)).alias("n"), (i + 3).alias("end")
        ),
        lambda sum_: sum_["n"].cast("long"),
    )
    return out.select(*measures, covered.alias("n_repeat_words"))


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


VOTES = (-1, 0, 1)


@dataclass(frozen=True)
class Accuracies:
    """P(good), and for each rule the log of P(vote | good) / P(vote | bad) of its three votes."""

    good: float
    weights: tuple[dict[int, float], ...]

    def posterior(self, votes: tuple[int, ...]) -> float:
        odds = math.log(self.good / (1 - self.good)) + sum(w[v] for w, v in zip(self.weights, votes, strict=True))
        return 1 / (1 + math.exp(-odds))

    def posterior_column(self, rules: tuple[Rule, ...]) -> Column:
        odds = F.lit(math.log(self.good / (1 - self.good)))
        for rule, w in zip(rules, self.weights, strict=True):
            vote = F.col(rule.name)
            odds = odds + F.when(vote < 0, F.lit(w[-1])).when(vote > 0, F.lit(w[1])).otherwise(F.lit(w[0]))
        return 1 / (1 + F.exp(-odds))


#: P(good) to begin with, by the number of rules that vote bad.
START = (0.99, 0.3, 0.1)


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200) -> Accuracies:
    """Expectation-maximisation (Dawid and Skene, 1979) over the patterns of votes and how many documents have each.

    Every rule has a distribution of votes on good documents and one on bad
    ones, abstentions included, each vote being counted once from the outset. A
    rule that votes bad less often on the bad than on the good says nothing:
    rules are taken to be no worse than chance. It begins with ``START``.
    """
    k = len(patterns[0][0]) if patterns else 0
    believed = [START[min(sum(v < 0 for v in pattern), len(START) - 1)] for pattern, _ in patterns]
    now = Accuracies(0.5, ({v: 0.0 for v in VOTES},) * k)
    for _ in range(rounds):
        good = 1 + sum(n * p for (_, n), p in zip(patterns, believed, strict=True))
        bad = 1 + sum(n * (1 - p) for (_, n), p in zip(patterns, believed, strict=True))
        weights = []
        for j in range(k):
            on_good, on_bad = dict.fromkeys(VOTES, 1.0), dict.fromkeys(VOTES, 1.0)
            for (pattern, n), p in zip(patterns, believed, strict=True):
                on_good[pattern[j]] += n * p
                on_bad[pattern[j]] += n * (1 - p)
            ratio = {v: math.log(on_good[v] / (good + 2)) - math.log(on_bad[v] / (bad + 2)) for v in VOTES}
            weights.append(dict.fromkeys(VOTES, 0.0) if ratio[-1] > 0 else ratio)
        now = Accuracies(good / (good + bad), tuple(weights))
        before, believed = believed, [now.posterior(pattern) for pattern, _ in patterns]
        if all(abs(x - y) < 1e-9 for x, y in zip(before, believed, strict=True)):
            break
    return now


def score(docs: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """The features, each rule's vote, p_good, base_failed and kept per row of ``docs`` (doc_id, text).

    Kept is what passes the base rules and has a posterior of ``threshold`` at
    least. Accuracies are estimated from the votes of all rows that pass the
    base, counted by pattern: 3 ** len(rules) counts at most reach the driver. Null
    and empty texts have no words and fail the base; null and repeated ids are
    rows like any other; an empty table gives an empty one. Other columns are
    not read.
    """
    if len(rules) > 8:
        raise ValueError("patterns are collected, so at most 8 rules")
    voted = staged(features(docs).withColumns({rule.name: rule.vote() for rule in rules}))
    names = [rule.name for rule in rules]
    counted = voted.where(~base_failed()).groupBy(*names).agg(F.count("*").alias("n")).orderBy(*names).collect()
    accuracies = estimate([(tuple(r[x] for x in names), r["n"]) for r in counted]) if counted else None
    p_good = accuracies.posterior_column(rules) if accuracies else F.lit(None).cast("double")
    scored = voted.withColumn("p_good", p_good).withColumn("base_failed", base_failed())
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))
