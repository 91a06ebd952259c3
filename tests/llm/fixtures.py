"""Small awkward tables shared by the tests of the operators."""

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, extra=False):
    """Documents numbered from 0; ``extra`` adds columns whose names the operators might use themselves."""
    rows = [(i if not isinstance(t, tuple) else t[0], t if not isinstance(t, tuple) else t[1]) for i, t in enumerate(texts)]
    frame = spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in rows], DOC_SCHEMA)
    if not extra:
        return frame
    names = ["id", "key", "row", "n", "a", "b", "k", "l_doc", "l_old", "own", "spans", "shard", "component", "score", "text_1", "u_id", "copies", "with blank.dot"]
    return frame.selectExpr("*", *[f"'x' AS `{name}`" for name in names])


def words(n, seed=0):
    """``n`` different words."""
    return [f"w{seed}x{i}" for i in range(n)]


def text(n, seed=0):
    return " ".join(words(n, seed))
