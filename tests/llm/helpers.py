"""Small inputs and plain-Python counterparts for the operators' tests."""

import re
import zlib

DOCS = "doc_id long, text string, lang string, score double, n_words int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def crc_text(n):
    return zlib.crc32(str(n).encode())


def odd_documents():
    """Nulls in every column, empty, blank, one-word, very long and repeated
    texts, and columns named like the operators' own."""
    long = " ".join(f"w{i % 977} of" for i in range(30_000))
    line = "the same line of the text stands here"
    texts = [
        None, "", "   ", "\n\n\n", "one", "One, TWO three four.", long, long + " end",
        f"{line}\n{line} b\n{line} c\nx", f"y\n{line}\n{line} b\n{line} c",
        "É à Ñ ß 日本語 😀", "a\tb\r\nc d", "!!! ???", "x" * 5000, "don't we'll 12.5 <|endoftext|>",
    ]
    rows = [(i, t, "en", 0.5, 1) for i, t in enumerate(texts)]
    rows += [(100, line, None, None, None), (100, line, None, None, None), (None, line, "x", 1.0, 2),
             (None, None, None, None, None), (101, "", "en", 0.0, 0), (4, "one", "en", 0.5, 1),
             (100, "another text under the same id", "en", 0.0, 0)]
    return rows


def documents(spark, rows=None):
    return spark.createDataFrame(odd_documents() if rows is None else rows, DOCS).repartition(3)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int, text string")
