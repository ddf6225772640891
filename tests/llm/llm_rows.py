"""Small tables with every awkward case, shared by the tests of the operators."""

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, digest string, keep string, n int, loc string, cid string, file int, row int, spans int, _place_of_row string, _metadata string"

LONG = "lorem ipsum dolor sit amet consectetur " * 6000


def odd_docs(spark):
    """NULLs in each column, empty and very long texts, ties, repeated rows, extra columns with names that operators use."""
    texts = [
        (1, None), (2, ""), (3, "Ünïcode 漢字 under the MIT license 😀"), (4, "mail a.b@example.com from 10.0.0.1"), (5, "alpha beta gamma delta epsilon zeta"),
        (5, "alpha beta gamma delta epsilon zeta"), (6, "alpha beta gamma delta epsilon zeta"), (None, "alpha beta gamma delta epsilon zeta"),
        (None, None), (7, LONG), (8, LONG + "x"), (9, "one two three"), (9, "one two four"), (-3, " "), (1 << 60, "big id"),
    ]
    rows = [(i, t, None if k % 3 else "en", None if k % 4 else "src", None if t is None else len(t), None, "keep", k, "loc", None, k, None, 1, "place", None) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, COLUMNS)


def EMPTY(spark):
    return spark.createDataFrame([], COLUMNS)
