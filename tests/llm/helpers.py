import random
import zlib

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = "score double, size long, label int, target double, block long, key string, id long, p long, x string, component long, copies int, sig binary"


def words(rng: random.Random, n: int, vocabulary: int = 4000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark, rows):
    """Rows of (doc_id, text[, source]) as documents."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def edge_rows():
    rng = random.Random(5)
    long = words(rng, 30_000)
    return [
        (None, "a text without an id that is long enough to be cut somewhere", None, None, None),
        (1, None, None, "a", None),
        (2, "", "en", None, 0),
        (3, long, "en", "a", len(long)),
        (4, "same words in a row that repeats itself wholly and says so", "en", "b", 58),
        (4, "same words in a row that repeats itself wholly and says so", "en", "b", 58),
        (5, "same words in a row that repeats itself wholly and says so", "de", "b", 58),
        (6, " \n\t ", "en", "b", 4),
        (7, "é" * 70 + "\x00 ÿ \U0001f600", "fr", "ä", 75),
    ]


def edge_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns whose names the operators use too."""
    rows = [(*r, 0.5, 3, 1, 2.0, 7, "k", 9, 1, "y", 4, 2, b"z") for r in edge_rows()]
    return spark.createDataFrame(rows, f"{SCHEMA}, {EXTRA}")


def crc(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())
