"""License scans: phrases, and an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.staging import staged

#: Phrases whose words, standing one after the other, make a label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notices by the label that a block gets if it contains enough of one's words.
TEMPLATES = {
    "gpl-notice": "this work is licensed under the gnu general public license version",
    "apache-notice": "licensed under the apache license version 2 0",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "mit-notice": "released under the mit license",
    "bsd-notice": "redistribution and use in source and binary forms with or without modification are permitted",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license",
    "no-reproduction": "all rights reserved no part of this work may be reproduced without written permission",
    "public-domain": "this work has been released into the public domain by its author",
    "gpl-header": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation"
    ),
    "gpl-warranty": (
        "this program is distributed in the hope that it will be useful but without any warranty without even "
        "the implied warranty of merchantability or fitness for a particular purpose see the gnu general "
        "public license for more details"
    ),
    "lgpl-header": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu "
        "lesser general public license as published by the free software foundation"
    ),
    "agpl-header": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "affero general public license as published by the free software foundation"
    ),
    "apache-header": (
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at"
    ),
    "apache-warranty": (
        "unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied "
        "see the license for the specific language governing permissions and limitations under the license"
    ),
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software and to permit persons to whom the software is furnished to do so subject to "
        "the following conditions"
    ),
    "mit-condition": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software"
    ),
    "mit-warranty": (
        "the software is provided as is without warranty of any kind express or implied including but not "
        "limited to the warranties of merchantability fitness for a particular purpose and noninfringement in "
        "no event shall the authors or copyright holders be liable for any claim damages or other liability "
        "whether in an action of contract tort or otherwise arising from out of or in connection with the "
        "software or the use or other dealings in the software"
    ),
    "isc-grant": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted provided that the above copyright notice and this permission notice appear in all "
        "copies"
    ),
    "isc-warranty": (
        "the software is provided as is and the author disclaims all warranties with regard to this software "
        "including all implied warranties of merchantability and fitness in no event shall the author be "
        "liable for any special direct indirect or consequential damages or any damages whatsoever resulting "
        "from loss of use data or profits whether in an action of contract negligence or other tortious "
        "action arising out of or in connection with the use or performance of this software"
    ),
    "zlib-warranty": (
        "this software is provided as is without any express or implied warranty in no event will the authors "
        "be held liable for any damages arising from the use of this software"
    ),
    "zlib-grant": (
        "permission is granted to anyone to use this software for any purpose including commercial "
        "applications and to alter it and redistribute it freely subject to the following restrictions"
    ),
    "bsd-source": (
        "redistributions of source code must retain the above copyright notice this list of conditions and "
        "the following disclaimer"
    ),
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and "
        "the following disclaimer in the documentation and or other materials provided with the distribution"
    ),
    "bsd-names": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission"
    ),
    "bsd-warranty": (
        "this software is provided by the copyright holders and contributors as is and any express or implied "
        "warranties including but not limited to the implied warranties of merchantability and fitness for a "
        "particular purpose are disclaimed"
    ),
    "mpl-copy": "if a copy of the mpl was not distributed with this file you can obtain one at",
    "boost-grant": (
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the "
        "software and accompanying documentation covered by this license the software to use reproduce "
        "display distribute execute and transmit the software"
    ),
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc-by-sa": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-attribution": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc0": (
        "to the extent possible under law the author has waived all copyright and related or neighboring "
        "rights to this work"
    ),
}
#: Share of a template's distinct words that a block must contain.
THRESHOLD = 0.9
#: Words of a block for each word of the template, which leaves room for comment marks and inserted names.
SPREAD = 1.25
#: Distinct words of all templates at most, as they are part of the plan.
MAX_VOCABULARY = 2000

_SEPARATORS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """Runs of ASCII digits, letters and all non-ASCII characters; A-Z lower-cased. None in a null text."""
    spaced = F.translate(F.coalesce(text, F.lit("")), _UPPER + _SEPARATORS, _UPPER.lower() + " " * len(_SEPARATORS))
    return F.array_remove(F.split(spaced, " "), "")


@dataclass(frozen=True)
class Template:
    """A template's distinct words, rarest first, how many of them a block must share, and a block's length in words."""

    label: str
    ranks: tuple[int, ...]
    overlap: int
    length: int

    @property
    def prefix(self) -> tuple[int, ...]:
        """Of which a block shares one at least if it shares ``overlap`` in all."""
        return self.ranks[: len(self.ranks) - self.overlap + 1]


def vocabulary(templates: dict[str, str]) -> list[str]:
    words = sorted({w for text in templates.values() for w in text.split()})
    if len(words) > MAX_VOCABULARY:
        raise ValueError(f"templates of over {MAX_VOCABULARY} distinct words")
    return words


def block_length(text: str) -> int:
    return math.ceil(SPREAD * len(text.split()))


def ordered(templates: dict[str, str], counts: dict[str, int], threshold: float) -> tuple[list[str], list[Template]]:
    """The vocabulary from the rarest word to the most frequent, and the templates by their ranks in it."""
    words = sorted(vocabulary(templates), key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(words)}
    out = []
    for label, text in templates.items():
        ranks = tuple(sorted(rank[w] for w in set(text.split())))
        out.append(Template(label, ranks, max(1, math.ceil(threshold * len(ranks) - 1e-9)), block_length(text)))
    return words, out


def phrase_places(docs: DataFrame, phrases: dict[str, str]) -> DataFrame:
    """``docs`` (with words) with n_words, n_base, first_word, last_word and base (labels).

    Words are joined with a space on either side of each, so that a phrase is a
    substring and the spaces before it count the words.
    """
    joined = F.concat(F.lit(" "), F.array_join("words", "  "), F.lit(" "))
    out = docs.withColumn("n_words", F.size("words").cast("long")).withColumn("joined", joined).drop("words")
    found = []
    for i, (phrase, label) in enumerate(phrases.items()):
        length = len(phrase.split())
        wrapped = " " + "  ".join(phrase.split()) + " "
        held = F.contains("joined", F.lit(wrapped))
        pieces = f"pieces{i}"
        out = out.withColumn(pieces, F.when(held, F.split("joined", re.escape(wrapped).replace("\\ ", " "))))
        words_in = lambda piece: F.expr(f"length({piece}) - length(replace({piece}, ' ', ''))") / 2
        found.append(
            F.when(
                F.col(pieces).isNotNull(),
                F.struct(
                    F.lit(label).alias("label"),
                    (F.size(pieces) - 1).cast("long").alias("n"),
                    words_in(f"{pieces}[0]").cast("long").alias("first"),
                    (F.col("n_words") - words_in(f"element_at({pieces}, -1)") - length).cast("long").alias("last"),
                ),
            )
        )
    out = out.withColumn("found", F.array_compact(F.array(*found)))
    each = lambda field: F.transform("found", lambda x: x[field])
    return out.select(
        *(x for x in docs.columns if x != "words"),
        "n_words",
        F.aggregate(each("n"), F.lit(0).cast("long"), lambda a, b: a + b).alias("n_base"),
        F.array_min(each("first")).alias("first_word"),
        F.array_max(each("last")).alias("last_word"),
        F.array_distinct(each("label")).alias("base"),
    )


def pieces_of(words: Column, longest: int) -> Column:
    """``words`` in pieces of three times ``longest`` that overlap by ``longest``, so that any
    ``longest`` words in a row lie whole within a piece; a shorter text is one piece."""
    last = F.greatest(F.size(words) - longest, F.lit(1)) - 1
    return F.transform(F.sequence(F.lit(0), last, F.lit(2 * longest)), lambda at: F.slice(words, at + 1, 3 * longest))


def fullest(places: Column, length: Column) -> Column:
    """The most distinct words of ``places`` (at, word) within ``length`` words in a row. Such a
    stretch can begin at a place, as moving it on to its first one loses none."""
    inside = lambda p: F.filter(places, lambda q: (q["at"] >= p["at"]) & (q["at"] < p["at"] + length))
    held = lambda p: F.size(F.array_distinct(F.transform(inside(p), lambda q: q["word"])))
    return F.array_max(F.transform(places, held))


def similar_blocks(docs: DataFrame, words: list[str], templates: list[Template]) -> DataFrame:
    """(doc_id, text_hash, label, containment): the templates that a block of a text contains enough of.

    A block of a template is any stretch of ``Template.length`` words in a row,
    whatever lines they stand in; containment is that of the best block.
    Texts are cut into overlapping pieces of bounded length, so that every block
    lies within one. Words are ranked from rare to frequent over the whole corpus. A
    piece is a candidate of a template if it holds a word of the template's prefix (prefix
    filter), has as many words as are needed (length filter), and if after the first
    shared word both have words enough left (positional filter); the shared words
    are then counted, and last those of the blocks. Texts without a prefix word are not cut.
    """
    rank = F.create_map(*(x for i, w in enumerate(words) for x in (F.lit(w), F.lit(i))))
    prefixes = sorted({words[r] for t in templates for r in t.prefix})
    least = min(t.overlap for t in templates)
    longest = max(t.length for t in templates)
    some = docs.where(F.col("text").rlike("(?i)" + "|".join(map(re.escape, prefixes))))
    worded = some.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))
    pieces = worded.select("doc_id", "text_hash", F.explode(pieces_of(F.col("words"), longest)).alias("piece"))
    near = pieces.withColumn("tokens", F.array_distinct("piece")).where(F.size("tokens") >= least)
    near = near.where(F.arrays_overlap("tokens", F.array(*map(F.lit, prefixes))))
    known = F.array_intersect("tokens", F.array(*map(F.lit, words)))
    ranked = near.select("doc_id", "text_hash", "piece", F.array_sort(F.transform(known, lambda w: rank[w])).alias("ranks"))
    shared = ranked.select("*", F.posexplode("ranks").alias("at", "rank"))
    rows = [
        (t.label, r, i, t.overlap, t.length, list(t.ranks), [words[x] for x in t.ranks])
        for t in templates
        for i, r in enumerate(t.prefix)
    ]
    schema = "label string, rank int, place int, overlap int, length int, template array<int>, named array<string>"
    prefix = docs.sparkSession.createDataFrame(rows, schema)
    pairs = shared.join(F.broadcast(prefix), "rank")  # as many rows as the prefixes have words
    pairs = pairs.where(1 + F.least(F.size("ranks") - 1 - F.col("at"), F.size("template") - 1 - F.col("place")) >= F.col("overlap"))
    both = F.array_intersect("ranks", "template")
    verified = pairs.where((F.size(both) >= F.col("overlap")) & (F.array_min(both) == F.col("rank")))  # once a pair
    placed = F.transform("piece", lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    placed = F.filter(placed, lambda p: F.array_contains("named", p["word"]))
    found = verified.withColumn("places", placed).withColumn("n", fullest(F.col("places"), F.col("length"))).where("n >= overlap")
    return found.select("doc_id", "text_hash", "label", (F.col("n") / F.size("template")).alias("containment"))


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, n_base, first_word, last_word, base and labels (arrays), score.

    n_base counts the places of all phrases, first_word and last_word are the
    first and last of their starts, null without any. ``labels`` adds those of
    the templates that some block contains ``threshold`` of; score is the largest
    share of a template in such a block, 0 without one. A block is any stretch of
    1.25 times the template's words, wherever its lines end. Null and empty texts have
    no words and no labels; null and repeated ids are rows like any other; an
    empty table gives an empty one. Other columns are not read.
    """
    vocab = vocabulary(templates)
    docs = docs.select("doc_id", "text")
    worded = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))
    worded = worded.withColumn("known", F.array_intersect("words", F.array(*map(F.lit, vocab))))
    marked = staged(phrase_places(worded, phrases))
    counted = marked.select(F.explode("known").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()
    words, ranked = ordered(templates, {r["word"]: r["n"] for r in counted}, threshold)
    found = similar_blocks(docs, words, ranked).groupBy("doc_id", "text_hash")
    found = found.agg(F.collect_set("label").alias("more"), F.max("containment").alias("score"))
    found = found.toDF("_id", "_hash", "more", "score")
    joined = marked.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_sort("base").alias("base"),
        F.array_sort(F.array_union("base", F.coalesce("more", none))).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
