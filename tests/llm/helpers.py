"""Small tables and brute-force versions for the operators' tests."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("score", "held_out", "h1", "_row", "id", "size", "sequence_id", "rank", "component", "_text")


def docs(spark, rows, clash=False):
    """rows: (doc_id, text[, lang[, source]])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None,
             None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if clash:
        from pyspark.sql import functions as F
        df = df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})
    return df


def grams(text, n=5):
    w = re.findall(r"\w+", (text or "").lower())
    k = min(n, len(w))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()


def components(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
