"""Documents with everything that must not break an operator."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, fp int, key string, node date"

LONG = "onther wather " * 20_000


def odd_docs(spark, more=()):
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns that clash with inner names."""
    texts = [
        (1, "The cat sat on the mat.\nThe dog did not."),
        (2, "The cat sat on the mat.\nThe dog did not."),
        (2, "The cat sat on the mat.\nThe dog did not."),
        (3, ""),
        (4, None),
        (5, " \n\t\n "),
        (6, LONG),
        (7, "<|endoftext|>a<|endoftext|>"),
        (8, "naïve 中文 text \x1c\x85 with 🙂 odd　spaces  "),
        (None, "no id here at all"),
        (None, "no id here at all"),
        (9, "one"),
        *more,
    ]
    rows = [(i, t, "en", None, None, "mine", 7, "k", None) for i, t in texts]
    return spark.createDataFrame([*rows, (None,) * 9], SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
