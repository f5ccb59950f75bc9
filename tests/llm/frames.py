"""Small tables with the odd cases that every operator must stand."""

from __future__ import annotations

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

LONG = " ".join(f"word{i % 977}" for i in range(40_000))
ODD = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, LONG, "en", "b", len(LONG)),
    (5, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
    (5, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
    (None, "une phrase sans aucun identifiant", "fr", None, 33),
    (None, None, None, None, None),
    (8, " \t\n ", "en", "b", 4),
    (9, "漢字 and ünïcode ½ \u0000 \U0001f600", "en", "c", 20),
]


def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows."""
    return spark.createDataFrame(ODD, DOCS)


def empty_documents(spark):
    return spark.createDataFrame([], DOCS)


def crowded(df):
    """``df`` with columns named like those that the operators work with."""
    from pyspark.sql import functions as F

    names = ("score", "fp", "key1", "key2", "_key1", "size", "taken", "place", "places", "label", "key", "text_of", "_found", "component_id", "bucket")
    return df.withColumns({name: F.lit(1) for name in names})


def documents_dir(df, folder, **tables):
    """A folder of tables as the registered queries read them."""
    df.write.parquet(f"{folder}/documents.parquet")
    for name, table in tables.items():
        table.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
