"""Plain answers to compare with, and awkward documents to ask about."""

from __future__ import annotations

import hashlib
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, key string, tag string"


def awkward(seed: int = 3, docs: int = 60) -> list[tuple]:
    """Documents with null, empty and long texts, copies, near copies, shared passages, odd white space."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 7))) for _ in range(400)]

    def prose(n: int) -> list[str]:
        return [r.choice(vocabulary) for _ in range(n)]

    passage, boiler = prose(70), prose(14)
    rows: list[list] = []
    for i in range(docs):
        words = prose(r.choice([0, 1, 3, 5, 40, 120, 300]))
        if i % 5 == 0:
            at = r.randint(0, len(words))
            words[at:at] = passage
        if i % 7 == 0:
            words += ["\n", *boiler, "\n"]
        if i % 6 == 1 and len(rows) > 3:
            words = (rows[r.randrange(len(rows))][1] or "").split(" ")
            if len(words) > 80 and r.random() < 0.6:
                words[r.randrange(len(words))] = "Ümlaut"
        text = "".join(w + r.choice([" ", " ", " ", "\n", "\t", "  "]) for w in words) if i % 4 else " ".join(words)
        rows.append([i * 3, text])
    rows += [[1000, None], [1001, ""], [1002, " \n\t "], [1003, "one"], [1004, "x" * 5000], [1005, "ab " * 2000],
             [None, " ".join(passage)], [1006, "the same line of ten words or more is found here\n" * 9]]
    rows.append(list(rows[5]))  # a repeated row
    return [(i, t, "en", f"s{n % 3}" if n % 4 else None, 0, n, "k", "t") for n, (i, t) in enumerate(rows)]


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None) -> set:
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def groups(n: int, links: list[tuple[int, int]]) -> list[int]:
    """The smallest index reachable from each."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def id_order(doc_id: int | None) -> int:
    return -(1 << 63) if doc_id is None else doc_id
