"""Small corpora with the awkward cases, and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7))) for _ in range(n))


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Texts, near copies, repeated rows, repeated ids, nulls, empty, blank and long texts."""
    rng = random.Random(seed)
    base = ["\n".join(words(rng, rng.randint(6, 20)) for _ in range(rng.randint(1, 6))) for _ in range(n)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(base)]
    for i in range(0, n, 3):                     # near copies: one word changed
        parts = base[i].split(" ")
        parts[rng.randrange(len(parts))] = "CHANGED"
        rows.append((1000 + i, " ".join(parts), "en", "s", 1))
    rows += [(2000 + i, base[0].upper(), "en", "s", 1) for i in range(5)]       # equal but for case
    rows += [rows[3], rows[3], (7, base[9], "de", "s", 1)]                       # repeated row, repeated id
    rows += [(None, base[4], None, None, None), (None, None, None, None, None)]
    rows += [(3000, None, "en", "s", 0), (3001, "", "en", "s", 0), (3002, " \n\t ", "en", "s", 4),
             (3003, "one", "en", "s", 3), (3004, "One", "en", "s", 3), (3005, "ein wort ß ÄÖ", "de", "s", 1),
             (3006, words(rng, 30_000), "en", "s", 1), (3007, "x" * 5000, "en", "s", 1)]
    return rows


def shingles(text: str | None, size: int) -> frozenset:
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i:i + size]) for i in range(max(1, len(found) - size + 1)))


class Groups:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        self.up[self.find(a)] = self.find(b)


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]
