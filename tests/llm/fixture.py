"""Small awkward tables: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import random

from pyspark.sql import functions as F

CLASHES = ["score", "document", "key_id", "tie", "fp", "core", "normal", "line", "marks", "begin", "component_id", "__id_key", "feature"]


def documents(spark, rows, partitions=3):
    """A documents table of (doc_id, text, source) rows with columns that clash with inner names."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(partitions)
    return df.select("*", F.lit(None).cast("string").alias("lang"), F.length("text").cast("long").alias("n_chars"), *[F.lit("x").alias(c) for c in CLASHES])


def passages(seed=3, n=24):
    rng = random.Random(seed)
    base = [rng.choice(["ab", "cd", "the", "of", "x", "y"]) for _ in range(1500)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(1, 5)):
            kind = rng.random()
            if kind < 0.5:
                at = rng.randint(0, 1300)
                words += base[at : at + rng.randint(1, 200)]
            elif kind < 0.65:
                words += ["a"] * rng.randint(1, 200)
            elif kind < 0.75:
                words += ["p", "q"] * rng.randint(1, 150)
            else:
                words += [rng.choice("abcdefgh") + str(rng.randint(0, 99)) for _ in range(rng.randint(1, 60))]
        rows.append((i, " ".join(words), f"s{i % 7}"))
    extra = [
        (n, None, "s1"), (n + 1, "", None), (n + 2, rows[0][1], "s2"), (n + 2, rows[0][1], "s2"), (n + 3, rows[0][1] + " zz", "s3"),
        (n + 4, "é" * 300 + " " + "ß ü\t\n" * 200, "s4"), (n + 5, " ".join(base * 3), "s5"),
    ]
    return rows + extra
