"""Small tables with the odd cases that every operator has to stand."""

import random

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
#: Names that the operators use inside.
CLASHES = ["class", "key", "bucket", "runs", "host", "row", "label", "target", "n_words", "kept",
           "__text", "__host", "__kept", "__own", "hits", "need", "head"]


def prose(seed: int, words: int = 120) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeé") for _ in range(r.randrange(1, 8)))
                    for _ in range(words))


def odd_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls, empty and long texts, copies, repeats."""
    a, b = prose(1), prose(2, 60)
    near = a.split()
    near[7] = "changed"
    rows = [
        (5, a, "en", "x", len(a)), (9, a, "en", "y", len(a)), (9, a, "en", "y", len(a)),
        (7, " ".join(near), "en", None, 1), (3, b, None, "x", None), (None, b, "en", "x", 1),
        (None, b, "en", "x", 1), (11, None, "en", "x", 0), (12, "", "en", "x", 0),
        (13, " \n\t ", "en", "x", 4), (14, "one", "en", "x", 3), (15, "One", "en", "x", 3),
        (16, LONG, "en", "z", len(LONG)), (17, a + "\n" + b, "en", "z", 1), (9, "other " + b, "en", "z", 1),
        (18, "one two three four", "en", "z", 18), (19, "é🙂 ünïcode  text \x1c here", "fr", "z", 9),
        (20, "\n".join(["same line here again"] * 40), "en", "z", 1),
    ]
    return rows


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_documents(spark, rows=None):
    """The odd rows with extra columns of clashing names, in several partitions."""
    df = spark.createDataFrame(odd_rows() if rows is None else rows, DOCUMENTS)
    for i, name in enumerate(CLASHES):
        df = df.selectExpr("*", f"{i} as `{name}`")
    return df.repartition(4)


def empty_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


def rows_of(df) -> list[tuple]:
    """Rows by column name, in an order that nulls do not disturb."""
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
