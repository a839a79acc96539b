"""Small inputs that every operator must stand: nulls, empty and long texts,
ties, repeated rows, and extra columns whose names clash with results."""

LONG = ("lorem ipsum dolor sit amet " * 4000).strip()

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog\nsame line\nend", "en"),
    (2, "The quick brown fox jumps over the lazy dog\nsame line\nend", "en"),
    (2, "The quick brown fox jumps over the lazy dog\nsame line\nend", "en"),
    (3, None, "en"),
    (None, "row without an id\nsame line", None),
    (None, None, None),
    (4, "", "de"),
    (5, "\n\n  \n", "de"),
    (6, LONG, "la"),
    (7, "x" * 200_000, "la"),
    (8, "42 !!! ...", None),
    (9, "Äpfel ÉTÉ straße  same line ", "de"),
    (10, "same line", "en"),
]

SCHEMA = ("doc_id long, text string, lang string, n_lines string, n_dropped int, fp string, hash string, drop_hashes string, "
          "score string, hits int, items int, w string, h int, at int, key int, uid string, spans int, component_id string")


def docs(spark, rows=ROWS, schema=SCHEMA):
    wide = [(*r, *["c"] * 0, "a", 1, "b", "c", "d", "e", 2, 3, "f", 4, 5, 6, "g", 7, "h") for r in rows]
    return spark.createDataFrame(wide, schema)


def plain(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
