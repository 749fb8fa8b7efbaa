"""Small tables for the operators' tests."""

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=()):
    """Documents from (doc_id, text) or (doc_id, text, lang, source); ``extra`` adds columns with awkward names."""
    full = [
        (r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, None if r[1] is None else len(r[1]))
        for r in rows
    ]
    df = spark.createDataFrame(full, DOC)
    for name in extra:
        df = df.withColumn(name, df["doc_id"] * 0)
    return df


def words(seed, count, letters="abcdefghijklmnop", longest=8):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(2, longest))) for _ in range(count)]
