import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "key string, size string, score string, row_key string, bucket string, vector string")


def words(text):
    return WORD.findall(text or "")


def make_docs(spark, rows):
    """rows: (doc_id, text[, source]); the other columns bear names that operators use inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "k", "z", "y", "x", "w", "v") for r in rows]
    return spark.createDataFrame(full, SCHEMA)
