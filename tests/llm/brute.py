"""Plain-Python versions of the contracts, and the edge-case documents every operator meets."""

import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, h1 string, n_lines string"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def docs_of(spark, rows):
    """Documents from (doc_id, text), with extra columns whose names clash with inner ones."""
    full = [(i, t, "en", "s", None if t is None else len(t), "k", "h", "n") for i, t in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(n, seed=0):
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[x // 65536 % len(WORDS)] + str(x // 128 % 50))
    return " ".join(out)


EDGE = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b "),
    (4, "one"),
    (None, "A null id, and a line of ÉCLAIR text\nshared line of ten chars"),
    (None, "shared line of ten chars\n\nother"),
    (5, "Shared Line of ten CHARS \n\x1fshared line of ten chars\ntail"),
    (6, "shared line of ten chars"),
    (6, "shared line of ten chars"),
    (7, prose(3000, 1)),
    (8, prose(3000, 1)),
    (9, "é" * 30 + "\n" + "É" * 30 + "\n日本語 テキスト"),
    (10, "shared line of ten chars\n" * 3),
]
