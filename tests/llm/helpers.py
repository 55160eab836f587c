"""Small tables with the awkward cases that every operator must take."""

import random

WORDS = [f"w{i}" for i in range(400)]
DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, sig string, size int, key int, rep string"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def edited(text, seed, n):
    r, w = random.Random(seed), text.split(" ")
    for _ in range(n):
        w[r.randrange(len(w))] = f"x{r.randrange(10 ** 6)}"
    return " ".join(w)


def doc_rows():
    """Nulls in any column, empty, blank and very long texts, repeated rows, one
    id on two texts, exact and near copies, and names that could clash."""
    base = prose(1, 120)
    rows = [(i, prose(100 + i, 30 + 7 * i), "en", f"s{i % 4}") for i in range(20)]
    rows += [(30, base, "en", "s0"), (31, base, "en", "s1"), (32, base.upper().replace("W", "w"), "en", "s1")]
    rows += [(40 + i, edited(base, i, 1 + i % 6), "en", "s2") for i in range(12)]
    rows += [(60, "", "en", "s0"), (61, None, None, None), (62, " \t\n ", "en", "s0"), (63, "one two", "en", "s3"),
             (64, "One  two", "de", "s3"), (65, prose(7, 30_000), "en", "s0"), (66, "  lead and  trail  ", "en", None),
             (67, "caf\u00e9 \u00a0na\u00efve \U0001f600 \u4e2d\u6587", "fr", "s1")]
    rows += [(70, prose(70, 50), "en", "s1")] * 2 + [(71, prose(71, 50), "en", "s1"), (71, prose(72, 50), "en", "s1")]
    rows += [(None, prose(80, 40), "en", "s1"), (None, base, "en", "s1"), (None, None, "en", "s1")]
    return [(*r, len(r[1]) if r[1] is not None else None, "sig", 5, 6, None) for r in rows]


def documents(spark, rows=None):
    return spark.createDataFrame(doc_rows() if rows is None else rows, DOC_SCHEMA)


def got(df):
    return [r.asDict() for r in df.collect()]
