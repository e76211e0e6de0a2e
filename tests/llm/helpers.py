"""Small inputs and plain reference versions for the tests of this folder."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def space_words(text):
    return SPACE_WORDS.findall((text or "").translate(LOWER))


def alnum_words(text):
    return ALNUM_WORDS.findall((text or "").translate(LOWER))


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.random() ** 2 * vocabulary)}" for _ in range(n))


def odd_docs(rng=None):
    """Rows with nulls in every column, blank, long, repeated and tied texts."""
    rng = rng or random.Random(5)
    long = prose(rng, 30_000)
    base = prose(rng, 60)
    rows = [
        (None, None, None, None, None), (1, "", "en", "a", 0), (2, " \n\t ", "en", "a", 4), (3, "one", None, "a", 3),
        (4, "one two", "en", None, 7), (5, base, "en", "a", 1), (5, base, "en", "a", 1), (6, base.upper(), "de", "b", 1),
        (None, base, "en", "b", 1), (7, long, "en", "b", 1), (8, long + " end", "en", "b", 1), (9, None, "en", "b", 1),
        (10, "Ünïcode 日本語 😀   ok", "xx", "c", 1), (11, "\x00\x1c\x85 a", "en", "c", 1), (12, "a\r\nb\nb\nb", "en", "c", 1)]
    return rows


def jaccard_components(docs, size, percent):
    """(doc_id -> (set size, smallest linked id)) over unique ids, by counting all overlaps."""
    sets, inverted, parent = {}, defaultdict(list), {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for doc_id, text in sorted(docs):
        words = space_words(text)
        parent[doc_id] = doc_id
        if not words:
            grams = set()
        elif len(words) < size:
            grams = {tuple(words)}
        else:
            grams = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}
        shared = Counter(o for g in grams for o in inverted[g])
        for other, n in shared.items():
            if 100 * n >= percent * (len(grams) + len(sets[other]) - n):
                a, b = find(doc_id), find(other)
                parent[max(a, b)] = min(a, b)
        for g in grams:
            inverted[g].append(doc_id)
        sets[doc_id] = grams
    return {d: (len(s), find(d)) for d, s in sets.items()}
