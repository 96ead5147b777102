"""Small tables with the awkward cases, and helpers."""

from __future__ import annotations

import random

WORDS = "ab cd efg hi jkl mn opq rst uv wxy z0 é ñandú größe".split()
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "fp string, words string, n_words string, key string, row string, slot string, block string, place string, "
    "spans string, h string, score string, kept string, _kept_id string, _hash string, text_hash string"
)
CLASHING = SCHEMA.count(",") - 4


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(400)) for _ in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, copies, near copies, repeated rows and ids, shared passages, a very long text."""
    base, passage = prose(1, 120), prose(2, 70)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    return [
        (1, base),
        (2, base),
        (3, near),
        (3, near),
        (4, prose(3, 40) + "\n" + passage + "\n" + prose(4, 30)),
        (5, passage + " " + prose(5, 10)),
        (6, None),
        (7, ""),
        (8, " \n\t "),
        (9, "one"),
        (10, "one two"),
        (11, "A a A a A a a"),
        (12, prose(6, 30000)),
        (None, base),
        (None, None),
        (13, prose(7, 49)),
        (14, prose(7, 49)),
        (15, prose(8, 50)),
        (16, prose(8, 50)),
        (17, " ".join(["same"] * 130)),
        (18, " ".join(["same"] * 60)),
        (9, "other text for a known id"),
        (-4, passage),
    ]


def edge_docs(spark):
    rows = []
    for i, (doc_id, text) in enumerate(texts()):
        lang = [None, "en", "de"][i % 3]
        source = [None, "a", "a", "a", "b"][i % 5]
        rows.append((doc_id, text, lang, source, len(text or ""), *["x"] * CLASHING))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def tuples(df, *columns: str) -> list[tuple]:
    """Rows in an order that nulls do not upset."""
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(rows, key=lambda r: tuple((x is not None, x) if x is not None else (False, 0) for x in r))


def in_order(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: tuple((x is not None, x) if x is not None else (False, 0) for x in r))
