"""A small messy corpus and plain-Python versions of the operators."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _k1 string, _id string, score string, node string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(rng: random.Random, n: int, accents: bool = False) -> str:
    letters = "abcdefghij" + ("éüñ" if accents else "")
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def corpus(seed: int = 1) -> list[tuple]:
    """Nulls, empties, copies, near copies, shared passages and lines, a hot source, repeated
    rows, an id used twice, a very long text; extra columns with clashing names."""
    rng = random.Random(seed)
    texts: list[str | None] = [None, "", " \n\t", "one", "Two words.", "aaaa " * 300, "x" * 3000]
    base = prose(rng, 200)
    passage = prose(rng, 90)
    texts += [base, base, base.upper()]
    for _ in range(5):  # near copies of one base
        w = base.split()
        w[rng.randrange(len(w))] = "edited"
        texts.append(" ".join(w))
    for _ in range(6):  # a passage of over 400 bytes in different surroundings
        texts.append(f"{prose(rng, 60)} {passage} {prose(rng, 60, True)}")
    for i in range(14):  # common lines, differently spaced and cased
        texts.append(f"{prose(rng, 12)}\n {'Common LINE here' if i % 2 else 'common line HERE'}\t\n\n{prose(rng, 5)}")
    texts.append(prose(rng, 6000))
    texts += [prose(rng, 40, True) for _ in range(15)]
    rows = []
    for i, t in enumerate(texts):
        source = None if i % 11 == 5 else ("hot" if i % 3 else f"s{i % 4}é")
        rows.append((i * 3, t, "en", source, len(t or ""), "clash", "clash", "clash", "clash"))
    rows += [rows[9], rows[9], rows[14]]  # fully repeated rows
    rows.append((None, "no id " + passage, None, None, None, None, None, None, None))
    rows.append((None, None, None, None, None, None, None, None, None))
    return rows


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def removed_windows(texts: list[str | None], window: int) -> list[tuple[bytes, int, int]]:
    """Per text: kept bytes, removed bytes, removed runs."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[s : s + window] for d in data for s in range(len(d) - window + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for s in range(len(d) - window + 1):
            if seen[d[s : s + window]] > 1:
                gone[s : s + window] = [True] * window
        kept = bytes(c for c, g in zip(d, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((kept, len(d) - len(kept), runs))
    return out


def shingle_counts(text: str | None, n: int = 5) -> Counter:
    w = words(text)
    return Counter(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else Counter()


def probability_jaccard(a: Counter, b: Counter) -> float:
    every = a.keys() | b.keys()
    return sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in every) for d in a.keys() & b.keys())


def components(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {n: find(n) for n in nodes}


def near_classes(rows: list[tuple], threshold: float = 0.8) -> dict:
    """Class by id; rows sharing an id are one node."""
    sets = [(r[0], shingle_counts(r[1])) for r in rows if r[0] is not None]
    links = []
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            both = len(x.keys() & y.keys())
            if both and max(both / len(x.keys() | y.keys()), probability_jaccard(x, y)) >= threshold:
                links.append((a, b))
    return components({a for a, _ in sets}, links)


def common_lines(texts_by_doc: list[tuple], min_docs: int) -> set[str]:
    docs = defaultdict(set)
    for doc, text in texts_by_doc:
        for line in (text or "").split("\n"):
            docs[line_key(line)].add(doc)
    return {k for k, d in docs.items() if k and len(d) >= min_docs}


def line_key(line: str) -> str:
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
