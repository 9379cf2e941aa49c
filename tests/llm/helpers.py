from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copies string, key string, block long, part string, id long"
LONG = "lorem ipsum dolor sit amet " * 4000

NASTY = [
    (1, None, None, None, None),
    (2, "", "en", "s", 0),
    (3, "same text here, twice over", "en", None, 26),
    (4, "same text here, twice over", None, "s", 26),
    (4, "same text here, twice over", None, "s", 26),
    (None, "no id at all <|endoftext|> x", "en", "s", 1),
    (5, LONG, "en", "s", len(LONG)),
    (6, "漢字 İstanbul ΣΑΣ \x1c\x00\t\n  é́ 😀 \\ [INST]", "xx", "s", 1),
    (7, "x", "en", "s", 1),
]


def nasty(spark):
    """Rows with nulls, repeats, a long text, unusual signs, and extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(*r, "c", "k", 1, "p", 2) for r in NASTY], SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def write(df, folder, name):
    df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
