"""Rows that every operator has to take: nulls, empty and long texts, repeats, clashing names."""

import random

KINDS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = (
    "score double, ids array<int>, rank int, shard int, slot long, size long, kept boolean, v long, labels string, "
    "target double, region long, text_id long, hub long, home int, hidden string, spans string, part int, copies int, "
    "n_words long, decoded string, predicted int, terms string, partner long, root long, start long, quota long"
)


def long_text(words=30000, seed=3):
    rng = random.Random(seed)
    return " ".join(rng.choice("alpha beta gamma delta eps zeta eta theta".split()) for _ in range(words))


def rows():
    """Documents with every kind of odd row."""
    plain = "the quick brown fox jumps over the lazy dog and runs away from the angry old bear at night " * 2
    return [
        (1, plain, "en", "a", len(plain)),
        (2, plain, "en", "b", None),
        (2, plain, "en", "b", None),  # a repeated row
        (3, "", None, "", 0),
        (4, None, "en", None, None),
        (5, " \t\n ", "en", "a", 4),
        (6, long_text(), "en", "a", 1),
        (7, "x" * 50000, "de", None, 50000),
        (8, "ünï çødé 漢字 ▁ \x00 end", "fr", "c", 12),
        (9, "one two three", "en", "c", 13),
        (10, "ONE two\tthree", "en", "c", 13),
        (None, "no id here", "en", "a", 10),
        (None, None, None, None, None),
    ]


def frame(spark):
    return spark.createDataFrame(rows(), KINDS)


def empty(spark):
    return spark.createDataFrame([], KINDS)


def clashing(spark):
    """The same rows with further columns that have the names of results."""
    docs = frame(spark)
    for part in CLASHING.replace(", ", ",").split(","):
        name, kind = part.split(" ")
        docs = docs.selectExpr("*", f"cast(null as {kind}) as {name}")
    return docs


def collected(df, *columns):
    """Rows as sorted tuples, nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))
