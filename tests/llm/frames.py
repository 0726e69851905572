"""Small tables with the cases every operator has to stand."""

from __future__ import annotations

import re

import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PAGES = "page_id long, url string, html string"


def odd_docs(spark):
    """Nulls in each column, empty and very long texts, ties and repeated rows, and columns whose
    names an operator might use for its own."""
    long = "wort für wort and word after word\n" * 3000
    rows = [
        (1, "The quick brown fox jumps over the lazy dog. It runs.\nAnd on it goes.", "en", "src0", 70),
        (1, "The quick brown fox jumps over the lazy dog. It runs.\nAnd on it goes.", "en", "src0", 70),
        (1, "another text with the same id", "en", "src0", 30),
        (2, None, "en", "src0", None),
        (3, "", None, None, 0),
        (4, " \n\t ", "de", "src1", 4),
        (5, "12345 !!! ###", "de", "src1", 13),
        (6, long, "de", "src1", len(long)),
        (None, "a row that has no id at all, only some words", "en", "src2", 44),
        (None, None, None, None, None),
        (7, "日本語のテキスト𝔘 x", "ja", "src2", 11),
        (8, "The quick brown fox jumps over the lazy dog. It runs.\nAnd on it goes.", "fr", "src3", 70),
    ]
    frame = spark.createDataFrame(rows, DOCS)
    return frame.selectExpr("*", "'x' AS fp", "1 AS component_id", "2 AS keep", "3 AS row", "'y' AS k", "4 AS piece", "5 AS host", "6 AS _id")


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def first_of_linked(rows):
    """The smallest doc_id of each group of fingerprints linked by 4 bits or fewer."""
    rows = sorted(rows, key=lambda r: r["doc_id"])
    prints = [plain_fingerprint(r["text"]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    return {rows[i]["doc_id"] for i, root in enumerate(plain_components(len(rows), links)) if root == i}
