"""Small frames with the awkward cases that every operator has to bear."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra=()):
    """A documents frame of (doc_id, text); ``extra`` names columns that clash with results."""
    full = [(i, t, "en", "src0", len(t or "")) for i, t in rows]
    df = spark.createDataFrame(full, DOCS)
    from pyspark.sql import functions as F
    for name in extra:
        df = df.withColumn(name, F.lit("x"))
    return df


def awkward():
    long = " ".join(f"word{i % 977}x{i}" for i in range(20_000))
    return [(1, None), (2, ""), (3, ""), (4, "  \n\t "), (5, "one"), (6, "one"), (7, long), (8, "é à b \U0001F642  c"),
            (9, "<|endoftext|> a"), (None, "null id"), (None, None), (5, "one")]
