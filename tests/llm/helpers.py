"""Small tables with awkward rows."""

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, schema=DOC):
    """Documents with ids from 1; a pair gives the id as well."""
    rows = []
    for i, t in enumerate(texts, 1):
        doc_id, text = t if isinstance(t, tuple) else (i, t)
        rows.append((doc_id, text, "en", "a", len(text or "")))
    return spark.createDataFrame(rows, schema)


def clashing(df):
    """The rows with extra columns named as operators name their results."""
    names = "id digest n keys ids decoded spans kept keep_id group_size class_id host path features evidence window slots score uid shard size first lift"
    return df.selectExpr("*", *[f"'x' AS `{n}`" for n in names.split() if n not in df.columns])
