"""Documents with nulls, ties, repeated rows and odd texts."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def words(seed, n, vocabulary=400):
    import random
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def text(seed, n, per_line=12):
    w = words(seed, n)
    return "\n".join(" ".join(w[i:i + per_line]) for i in range(0, n, per_line))


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, odd characters."""
    long = " ".join(words(1, 30_000, 5000)) + " " + "x" * 6000
    near = text(2, 120)
    rows = [
        (1, text(2, 120), "en", "a", 1), (2, near, "en", "a", 1), (3, near.replace("w", "W", 1), "en", "b", 1),
        (4, None, "en", "a", None), (5, "", None, "b", 0), (6, " \t\n\r\x0b\x0c ", "en", None, 7), (7, long, "en", "a", 1),
        (8, "one two three", "en", "b", 13), (9, "one two three", "en", None, 13), (10, text(3, 60), "en", "a", 1),
        (10, text(3, 60), "en", "a", 1), (11, "café  naïve  中文 \U0001f600 <|endoftext|> it's 12,5\n\n\tx ", "fr", "c", 1),
        (None, text(4, 50), "en", "a", 1), (None, None, None, None, None), (12, near + "\n" + text(5, 10), "en", "a", 1),
        (13, "the same long line of words in many texts again and again\n" * 3 + text(6, 40), "en", "c", 1),
        (14, "the same long line of words in many texts again and again\nmore text here", "en", "c", 1),
    ]
    return rows + [(100 + i, text(50 + i, 80 + 7 * i), "en", "abc"[i % 3], 1) for i in range(12)]
