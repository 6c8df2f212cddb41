"""Documents that operators must get through, whatever the case."""

import re

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names operators use inside.
CLASHING = ", id string, label string, kept string, component string, family string, number string, slot string, base string"


def passage(seed: int, n: int) -> str:
    """Words in an order that depends on the seed."""
    state, out = seed * 2654435761 % 2**32 or 1, []
    for _ in range(n):
        state = (state * 1664525 + 1013904223) % 2**32
        out.append(WORDS[state >> 16 & 15] + WORDS[state >> 20 & 3] * (state >> 9 & 1))
    return " ".join(out)


def rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, repeated rows, ties, very long texts and runs, rare characters."""
    long = passage(1, 30_000)
    texts = [
        (1, "one two three four five six seven"), (2, "one two three four five six seven"), (2, "one two three four five six seven"),
        (3, ""), (4, None), (5, " \t\n "), (6, "word"), (7, "two words"), (None, "no id here"), (None, None),
        (8, long), (9, long + " end"), (10, "x" * 50_000), (11, "é" * 3000 + " 漢字かな " + "🙂" * 10), (12, "\x00\x01   "),
        (13, passage(2, 100)), (14, passage(2, 100).upper()), (-5, passage(3, 50)), (2**62, "a b c"), (15, "a  b c"),
    ]
    return [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else "s", None if t is None else len(t))
            for k, (i, t) in enumerate(texts)]


def documents(spark, given: list[tuple] | None = None):
    """A table of documents; ``given`` are pairs of id and text."""
    data = rows() if given is None else [(i, t, "en", "s", len(t or "")) for i, t in given]
    return spark.createDataFrame(data, SCHEMA)


def clashing(spark):
    return spark.createDataFrame([(*r, *["?"] * CLASHING.count("string")) for r in rows()], SCHEMA + CLASHING)


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))


def collected(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
