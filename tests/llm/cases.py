"""Hand-made documents with what operators must cope with: nulls in every
column, empty and very long texts, ties, repeated rows, and columns whose
names the operators use themselves."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "digest string, kept boolean, place int, row int, component string, `odd name` string")
EXTRA = ("x", True, 7, 7, "y", "z")
LONG = " ".join(f"word{i % 997}x{i % 31}" for i in range(30_000))
PLAIN = "the quick brown fox jumps over the lazy dog and runs away from it"


def documents(spark, texts=None):
    """Rows (doc_id, text); by default the edge cases."""
    rows = texts if texts is not None else [
        (1, PLAIN), (2, PLAIN.upper()), (3, PLAIN), (3, PLAIN), (None, PLAIN), (4, None), (5, ""), (6, "   \n\t"),
        (7, LONG), (8, "é" * 40_000), (9, "one two"), (10, "one two"), (None, None), (11, "\x00\x1c odd   bytes")]
    full = [(i, t, "en" if (i or 0) % 2 else None, None if i == 3 else f"src{(i or 0) % 3}",
             None if t is None else len(t), *EXTRA) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower_ascii(text):
    return text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
