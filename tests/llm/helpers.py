"""Small tables with the awkward rows every operator must take."""

LONG = "the long text of many words goes on and on " * 4000
COLUMNS = "doc_id long, text string, lang string, source string, score double, row long, predicted int, `key` string"
ROWS = [
    (1, "A first text about the harbour, in plain words that nobody else uses here.", "en", "a", 0.1, 1, 1, "x"),
    (2, "A first text about the harbour, in plain words that nobody else uses here.", "en", "a", None, 1, 1, None),
    (2, "A first text about the harbour, in plain words that nobody else uses here.", "en", "a", None, 1, 1, None),
    (3, "", "en", "b", None, None, None, None),
    (4, None, None, None, None, None, None, None),
    (None, "A row without an id but with some words in it.", "en", "b", None, None, None, None),
    (5, " \t\n", "en", "b", None, None, None, None),
    (6, LONG, "en", "c", None, None, None, None),
    (7, "1234 5678 !!!", None, "c", None, None, None, None),
    (8, "short", "en", None, None, None, None, None),
    (9_007_199_254_740_993, "One\nsmall  text.", "fr", "c", None, None, None, None),
]


def awkward(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)
