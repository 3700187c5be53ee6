"""Plain Python accounts of what the operators do, and rows to try them on."""

import re
from collections import Counter, defaultdict

WHITE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

DOCS = "doc_id bigint, text string, lang string, node bigint, label int, ids int, chunk int"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def docs(spark, rows):
    """(doc_id, text) rows in a table with columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, None, 1, 2, 3, 4) for i, t in rows], DOCS)


def shingles(text, size):
    words = WHITE_WORDS.findall(lower(text))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def groups(rows, size, num, den):
    """(doc_id, set size, component) by comparing all pairs."""
    sets = [(i, shingles(t, size)) for i, t in rows]
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, (_, one) in enumerate(sets):
        for b, (_, two) in enumerate(sets[:a]):
            if one and two and den * len(one & two) >= num * len(one | two):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    first = defaultdict(list)
    for k, (i, s) in enumerate(sets):
        if i is not None:
            first[root(k)].append(i)
    return Counter(
        (i, len(s), (min(first[root(k)], default=None) if s else i)) for k, (i, s) in enumerate(sets)
    )


def string_tiles(item, doc, least):
    """Greedy string tiling by looking at every pair of places."""
    in_item, in_doc, found = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while (
                    i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n]
                    and i + n not in in_item and d + n not in in_doc
                ):
                    n += 1
                if n > best[0]:
                    best = (n, i, d)
        n, i, d = best
        if n < least or n == 0:
            return found
        in_item |= set(range(i, i + n))
        in_doc |= set(range(d, d + n))
        found.append((i, d, n))


ODD_TEXTS = [None, "", " \n\t ", "A", "a a a a a a", "漢字 🙂 ▁ ñ", "x" * 3000, "word " * 3000, "\x00\x7f odd \x85"]
ODD_ROWS = [*enumerate(ODD_TEXTS), (3, "A"), (3, "A"), (None, "A"), (None, None), (5, "same id, other text")]
