"""Small inputs with every oddity: nulls, empty and long texts, repeats, clashing names."""

LONG = "lorem ipsum dolor sit amet " * 4000
PROSE = " ".join(f"word{i % 37} thing{i % 53}" for i in range(120))

ROWS = [
    (1, PROSE, "en", "a", 1),
    (2, PROSE, "en", "a", 2),
    (2, PROSE, "en", "a", 2),
    (3, PROSE + " tail", "de", None, 3),
    (4, None, None, None, None),
    (5, "", "en", "b", 0),
    (6, " \n\t ", "en", "b", 3),
    (7, LONG, "fr", "c", len(LONG)),
    (8, "é 😀\x00 'tis don't  two  spaces\r\n\x85end ", "fr", "c", 9),
    (None, PROSE, "en", "a", 1),
    (None, "only without id", None, "a", 1),
    (9, "one", "en", "a", 3),
    (10, "one two three four", "en", "d", 18),
    (11, "one two three four", "en", "d", 18),
]
# Columns whose names operators might use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("size", "target", "words", "slice", "place", "part", "row", "root", "doc", "sid", "key")


def documents(spark, rows=ROWS):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in CLASHING:
        df = df.withColumn(name, df["n_chars"])
    return df


def empty(spark):
    return documents(spark).limit(0)


def tuples(df, *columns):
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, str(type(x)), x if x is not None else 0) for x in r))
