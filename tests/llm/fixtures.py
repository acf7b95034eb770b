"""Small tables with the cases that every operator has to stand."""

from __future__ import annotations

import random

# Names that operators use inside.
CLASHING = "id text2 block n h hash task comp label score kept rank key bands odd node size range kind".split()


def table(spark, rows, schema, *, clash=True):
    """Rows with further columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, schema)
    if clash:
        for name in CLASHING:
            if name not in df.columns:
                df = df.selectExpr("*", f"'x' AS {name}")
    return df


def documents(spark, texts, *, clash=True):
    """``(doc_id, text)`` from a list of texts, or of pairs of id and text."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return table(spark, rows, "doc_id bigint, text string", clash=clash)


def prose(seed: int, words: int) -> str:
    """Words that hardly any other seed has."""
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefghijklmnopqrst") for _ in range(pick.randint(2, 8))) for _ in range(words))


def rows(df, *columns):
    """Rows as plain tuples, in order."""
    found = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in found), key=repr)
