"""Small tables with awkward rows, and what brute force needs."""

import re

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, word string"


def docs_frame(spark, rows):
    """rows: (doc_id, text[, source]); two columns clash with names used inside the operators."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "clash", "clash") for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t))
