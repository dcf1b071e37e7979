"""Small tables with every awkward case."""

LONG = "lorem " * 20_000


def rough(spark, n=8):
    """Documents with null and empty texts, ties, a very long text, repeated rows, and extra columns with clashing names."""
    rows = [(0, "the quick brown fox jumps", "a"), (1, None, "a"), (2, "", None), (3, LONG, "b"), (4, "the quick brown fox jumps", "c"), (5, "\n\n", "a"), (5, "\n\n", "a"), (6, "x", "d")]
    return spark.createDataFrame(
        [(i, t, s, "en", 1, 2, 3) for i, t, s in rows[:n]], "doc_id long, text string, source string, lang string, n_chars long, removed_lines int, `__lost` int"
    )
