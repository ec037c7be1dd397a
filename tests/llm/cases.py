"""Rows that every text operator has to stand, and plain helpers for brute force."""

import re

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = (
    "doc_id long, text string, lang string, id long, row long, digest string, key int, n long, "
    "score double, n_lines long, shard int, words string, size string"
)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


def prose(seed, n):
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i * seed) % 99991}" for i in range(n))


def messy(spark, extra=()):
    """Nulls, empty, blank and very long texts, repeated rows, and columns of all kinds of names."""
    base = prose(1, 60)
    rows = [
        (1, base),
        (2, base),
        (2, base),
        (3, None),
        (4, ""),
        (5, " \n\t \n"),
        (None, base),
        (None, None),
        (6, "One line of words\none LINE of words\n\nshort"),
        (7, "  one line of words  \r\nshort"),
        (8, prose(8, 30_000)),
        (9, "ünï cödé   tail \x85 end 漢字"),
        (10, base + " tail"),
        *extra,
    ]
    filler = ("en", 7, 7, "d", 1, 1, 0.5, 3, 1, "w", "s")
    return spark.createDataFrame([(i, t, *filler) for i, t in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
