"""Documents and pages with every oddity the operators must take."""

CLASHING = ["digest", "_digest", "_text", "n", "key", "score", "lang_pred", "topic", "keep_id", "_salt", "weight", "sampled", "member"]
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)

LONG = "a long line of words that goes on. " * 6000
ROWS = [
    (1, "The cat sat on the mat. It was warm there and dry. Nobody came to see it all day long.", "en", "s"),
    (2, "Le chat dort sur le tapis. Il fait chaud ici. Personne ne vient le voir de la journée.", "fr", "s"),
    (3, None, "en", "s"),
    (4, "", None, None),
    (5, " \t\n ", "en", ""),
    (6, LONG, "en", "t"),
    (7, "tie one", "en", "t"),
    (7, "tie one", "en", "t"),
    (7, "tie two", "en", "t"),
    (None, "tie one", "en", "t"),
    (None, None, None, None),
    (8, "x" * 300_000, "en", "t"),
    (9, "12345 !!! ???", "en", "t"),
    (10, "日本語 テキスト \U0001f600 éİ", "fr", "u"),
    (11, "\x00\x01 odd \x0b\x0c signs \x85\xa0 here", "fr", "u"),
]


def documents(spark, rows=ROWS):
    full = [(*r, len(r[1] or ""), *["c"] * len(CLASHING)) for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA).coalesce(2)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def ids(rows=ROWS):
    return sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
