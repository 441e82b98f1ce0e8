"""Small tables with every odd case, and rows of the given tables."""

FOLDER = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i % 977} is number {i} of a long text." for i in range(6000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))


def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and clashing extra columns."""
    rows = [
        (1, PASSAGE, "en"),
        (2, PASSAGE, "en"),
        (2, PASSAGE, "en"),
        (3, None, "en"),
        (4, "", None),
        (None, "a text without an id that is otherwise quite normal", "en"),
        (None, None, None),
        (5, "   \n\t ", "de"),
        (6, LONG, "en"),
        (7, "before it " + PASSAGE + " and behind it", None),
        (8, "éèê ñ 日本語 😀 \x00 </turn> ###", "fr"),
        (9, "short", "en"),
        (9, "another text with the same id", "en"),
    ]
    names = ["class", "row", "n", "head", "group", "label", "spans", "base", "kept", "code", "ids", "lang_pred"]
    rows = [r + tuple(f"x{i}" for i in range(len(names))) for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"`{n}` string" for n in names))


def no_docs(spark):
    return odd_docs(spark).limit(0)
