"""Small tables with the cases that every operator must take."""

from __future__ import annotations

LONG = "".join(f"word{k % 977} " for k in range(40_000))
PASSAGE = " ".join(f"shared{k}" for k in range(60))
#: Columns whose names operators use inside.
CLASHING = (
    "rid long, doc string, id long, fp long, component_id long, h long, c long, kept string, "
    "lo int, hi int, n long, host string, draw long, rank int, tie long, row long, fingerprint string"
)
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"

TEXTS = [
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, " \t\n ", None, "a"),
    (4, "one", "en", "b"),
    (5, LONG, "en", "b"),
    (6, f"start of one text {PASSAGE} and its end", "en", "a"),
    (7, f"another beginning {PASSAGE} with other words", "de", "a"),
    (8, f"start of one text {PASSAGE} and its end", "en", "c"),
    (8, f"start of one text {PASSAGE} and its end", "en", "c"),
    (None, "no id here, é ß 日本語 \x00 🙂 <|endoftext|>", "fr", "a"),
    (None, None, None, None),
    (9, "a" * 3000, "en", "a"),
    (10, "### $$$ 123 456", "en", "a"),
]


def documents(spark, rows=None):
    """The cases as a table with clashing columns."""
    filled = [
        (i, t, lang, source, None if t is None else len(t), *(None,) * len(CLASHING.split(", ")))
        for i, t, lang, source in (TEXTS if rows is None else rows)
    ]
    return spark.createDataFrame(filled, SCHEMA)


def key(row):
    return tuple((x is None, str(x)) for x in row)
