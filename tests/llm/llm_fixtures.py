"""Small frames with the cases every operator has to stand."""

from __future__ import annotations

NORMAL = "Then of the and to in. The ended thing is on the her.\nOf that and in to be the."
LONG = "the of and ended to thing. " * 9000

ROWS = [
    (1, NORMAL, "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, "a"),
    (4, NORMAL, "de", "b"),
    (4, NORMAL, "de", "b"),
    (5, LONG, "en", "b"),
    (None, "Some other words stand here, with no id at all.", None, None),
    (6, "One two", "fr", "c"),
    (7, "é ñ 漢字 🙂 <|endoftext|> \x1c\x85 end\t\n  ", "es", "ç"),
    (8, NORMAL.replace("her", "his"), "en", None),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"
#: Names the operators use for columns of their own.
CLASHES = (
    "score quality keep fp fingerprint component_id size w weight target taken key bucket turn n "
    "row start length offset media word_count root first id toxicity_score quality_score mix_row"
).split()


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def clashing(frame):
    """The frame with more columns, named like those the operators make."""
    from pyspark.sql import functions as F

    return frame.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])
