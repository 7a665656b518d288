"""Hard rows and brute-force helpers of the operator tests."""

from __future__ import annotations

import itertools
import re
from collections import Counter, defaultdict

SF_DIR = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

PROSE = (
    "the river ran past the old mill and the children watched the boats drift slowly "
    "towards the harbour while the evening bells rang over the quiet town below the hill"
)


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def shingle_set(tokens: list[str], size: int = 5) -> set[tuple[str, ...]]:
    return {tuple(tokens[i : i + size]) for i in range(max(1, len(tokens) - size + 1))} if tokens else set()


def similar_pairs(sets: dict) -> list[tuple]:
    """Pairs of keys whose sets have Jaccard similarity 0.8 or more."""
    holders = defaultdict(list)
    for key, values in sets.items():
        for value in values:
            holders[value].append(key)
    shared = Counter(pair for keys in holders.values() for pair in itertools.combinations(keys, 2))
    return [(a, b) for (a, b), n in shared.items() if n * 9 >= 4 * (len(sets[a]) + len(sets[b]))]


def least_connected(keys, pairs) -> dict:
    parent = {key: key for key in keys}

    def find(key):
        while parent[key] != key:
            parent[key] = parent[parent[key]]
            key = parent[key]
        return key

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {key: find(key) for key in keys}


HARD = [
    (1, PROSE, "en"),
    (2, PROSE, "en"),
    (3, PROSE.upper() + " ☃", None),
    (4, None, "en"),
    (5, "", "fr"),
    (6, "  \t\n ", "fr"),
    (7, "12345 !!! 999", None),
    (8, "word " * 40_000, "en"),
    (9, "x" * 200_000, "en"),
    (10, "日本語のテキスト 😀😀 и кириллица", "ja"),
    (11, "a\u0000b\u001c c\r\nd", None),
    (12, PROSE.replace("mill", "barn"), "en"),
    (13, 'token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"', "en"),
    (14, PROSE + "\n" + PROSE, "en"),
]
