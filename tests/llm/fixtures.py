"""Awkward documents that every operator has to stand."""

ODD = [
    (1, None, "en"), (2, "", "en"), (3, "   \n\t", None), (4, "word", "en"), (5, "word", "en"), (5, "word", "en"),
    (None, "a row without a key but with a few words in it", "en"), (7, "Ünïcödé 中文 😀 <|endoftext|> it's", "de"), (8, "long " * 60_000, "en"), (9, "x" * 200_000, None),
]
SCHEMA = "doc_id long, text string, lang string, n_words string, mark string, place string, set_id string"


def odd(spark):
    """ODD with columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, lang, "clash", "clash", "clash", "clash") for i, t, lang in ODD], SCHEMA)
