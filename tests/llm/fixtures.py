"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeats, clashing names."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, n long, rank int, digest string, pick string, size long, comp long"


def sentence(r, n):
    return " ".join("".join(r.choice("abcdefghijklm") for _ in range(r.randint(2, 7))) for _ in range(n))


def documents(seed=3):
    """(doc_id, text, lang, source) rows."""
    r = random.Random(seed)
    passage = sentence(r, 60)
    base = sentence(r, 300)
    rows = []
    for i in range(40):
        rows.append((i, sentence(r, r.choice([1, 2, 3, 20, 34, 35, 36, 120])), "en", "a"))
    for i in range(40, 60):
        words = base.split()
        for _ in range(r.randint(0, 4)):
            words[r.randrange(len(words))] = "edited"
        rows.append((i, " ".join(words), "en", "b"))
    for i in range(60, 75):
        rows.append((i, f"{sentence(r, 50)} {passage} {sentence(r, 40)}", "de", "c"))
    for i in range(75, 85):
        rows.append((i, "Same   text\twith\nspace" + " " * (i % 3) + " and UPPER case", "de", None))
    rows += [
        (90, None, "en", "a"),
        (91, "", "en", "a"),
        (92, " \t\n\x0b\x0c\r ", "de", "b"),
        (93, "one", "de", "b"),
        (94, "One", None, "b"),
        (95, "one two", "en", "c"),
        (96, "x " * 3000, "en", "c"),
        (97, "émile ß İ 你好     end", "fr", "c"),
        (98, "12345 ... !!", "fr", "c"),
        (99, base.upper(), "en", "b"),
        (99, base.upper(), "en", "b"),
        (None, "a text without an id", "en", "a"),
        (100, " ".join(sentence(r, 2000).split()), "en", "a"),
        (-5, "one two", "en", None),
    ]
    return rows


def frame(spark, rows, partitions=5):
    """The documents table with extra columns whose names the operators use inside."""
    full = [(i, t, lang, s, len(t or ""), 7, 7, 7, "x", "y", 7, 7) for i, t, lang, s in rows]
    return spark.createDataFrame(full, DOC_SCHEMA).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
