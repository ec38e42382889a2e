"""Small tables for the tests of the training-data operators."""

SCHEMA = "doc_id long, text string, rid string, row string, fp string, n_words string"


def documents(spark, texts, ids=None):
    """Documents with columns whose names the operators use inside, and null values in them."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, None, "x", None, "y") for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def words(rng, n, vocabulary=300):
    return " ".join(f"w{rng.integers(vocabulary)}" for _ in range(n))
