"""Small tables with the awkward rows that every operator must bear."""

from __future__ import annotations

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, clashing=True):
    """(doc_id, text[, source]) rows as documents, with columns whose names operators use inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if clashing:
        df = df.withColumns({"size": F.lit(-1), "row": F.lit("x"), "label": F.lit(7), "score": F.lit("y"),
                             "fp": F.lit(0.5), "taken": F.lit(None).cast("int"), "ids": F.lit("z")})
    return df


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def embeddings(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return df.withColumns({"score": F.lit("x"), "rank": F.lit(0), "slot": F.lit(-1), "v": F.lit("clash")})


def pages(spark, rows):
    return (spark.createDataFrame(rows, "page_id long, url string, html string")
            .withColumns({"host": F.lit("clash"), "capture": F.lit(1), "bytes": F.lit(1), "rule": F.lit("r")}))


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
