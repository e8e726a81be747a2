"""Small tables with the awkward cases that every operator must take."""

WORDS = "the river of stone and a long road to some green hill with one quiet house in it for the winter".split()


def prose(n: int, seed: int = 0) -> str:
    return " ".join(WORDS[(i * (seed % 7 + 2) + i * i * (seed + 1)) % len(WORDS)] + "xyzuvw"[(i + seed) % 6] * (i % 3) for i in range(n))


ODD_TEXTS = [
    None,
    "",
    " \t\n\x0b\f\r ",
    "one",
    "é ☃ \U0001f600 ñandú",
    "a\x1cb c d e",
    "\n\n same line \n same line \n same line\n",
    "word " * 400,
    "x" * 30_000,
    "7" * 20_000,
    prose(60, 1),
    prose(60, 1),
    prose(3000, 2),
]

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_docs(spark, texts=None, repeats=True):
    """Awkward texts, a null id, an id that occurs again, and null other columns."""
    rows = [(i, t, None, None, None) for i, t in enumerate(ODD_TEXTS if texts is None else texts)]
    if repeats:
        rows += [(None, "no id " * 30, "en", "s", 1), (3, "one", None, None, None), (3, "other text", None, None, None)]
    return spark.createDataFrame(rows, DOC_SCHEMA)
