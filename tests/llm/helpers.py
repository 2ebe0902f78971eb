from __future__ import annotations

#: Column names that the operators use themselves.
CLASHES = ("n_words", "text_hash", "kept", "start", "end", "spans", "size", "length", "cell", "rank", "sketch", "label", "_spans", "word_length")


def frame(spark, docs, clashes=True):
    """Documents with further columns whose names clash with the operators' own."""
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return df.selectExpr("*", *(f"'x' AS `{c}`" for c in CLASHES)) if clashes else df


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.1 else f"w{rng.randrange(vocabulary)}" for _ in range(n))
