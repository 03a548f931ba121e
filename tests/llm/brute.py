"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Groups(dict):
    """Smallest member of each group of linked things."""

    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def shingles(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) >= k:
        return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return frozenset([tuple(words)] if words else [])


def similar(rows, k, percent):
    """(id, set size, component) of each row; ids are not null and differ."""
    sets, groups = {i: shingles(t, k) for i, t in rows}, Groups()
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                groups.link(a, b)
    return {(i, len(sets[i]), groups.find(i)) for i in ids}


def without_repeats(rows, length=20):
    """id: (words, words left) of each row."""
    seen, result = set(), {}
    for i, text in sorted(rows):
        words = WORD.findall(text or "")
        gone = set()
        for s in range(len(words) - length + 1):
            run = tuple(words[s : s + length])
            if run in seen:
                gone.update(range(s, s + length))
            seen.add(run)
        result[i] = (len(words), " ".join(w for n, w in enumerate(words) if n not in gone))
    return result


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def removed_lines(rows, edits=2, min_chars=20):
    """id: places of the lines to remove."""
    lines = sorted((i, p, line) for i, t in rows if i is not None and t is not None for p, line in enumerate(t.split("\n")) if len(line) >= min_chars)
    texts, groups = sorted({x for *_, x in lines}), Groups()
    for n, a in enumerate(texts):
        for b in texts[:n]:
            if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                groups.link(a, b)
    seen, result = set(), {}
    for i, p, line in lines:
        if (root := groups.find(line)) in seen:
            result.setdefault(i, []).append(p)
        seen.add(root)
    return result


def linked_vectors(rows, threshold=0.98):
    """id: (links, component) of (id, vector, label) rows."""

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v):
            return None
        norm = math.sqrt(sum(x * x for x in v))
        return [x / norm for x in v] if norm > 0 else None

    units, groups, links = {i: unit(v) for i, v, _ in rows}, Groups(), Counter()
    for n, (i, _, a) in enumerate(rows):
        for j, _, b in rows[:n]:
            u, v = units[i], units[j]
            if a is not None and a == b and u and v and len(u) == len(v) and sum(x * y for x, y in zip(u, v)) >= threshold:
                groups.link(i, j)
                links.update([i, j])
    return {i: (links[i], groups.find(i)) for i, *_ in rows}


def counts(text):
    """Words, their characters, symbols, repeated lines and repeated words of a text."""
    text = text or ""
    words = WORD.findall(text)
    lines, seen, repeated = [x for x in text.split("\n") if WORD.search(x)], set(), 0
    for line in lines:
        repeated += line in seen
        seen.add(line)
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(inside)


def some_texts(seed: int, n: int, vocabulary: int = 400, longest: int = 120) -> list[str]:
    """Random texts, some of them copies of others with a few words changed, some with a passage of another."""
    r = random.Random(seed)
    texts: list[str] = []
    for _ in range(n):
        kind = r.random()
        if texts and kind < 0.4:
            words = r.choice(texts).split(" ")
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                words[r.randrange(len(words))] = f"new{r.randrange(9)}"
        else:
            words = [f"w{int(vocabulary * r.random() ** 2)}" for _ in range(r.randint(1, longest))]
            if texts and kind > 0.8:
                other = r.choice(texts).split(" ")
                at = r.randrange(len(other))
                words[len(words) // 2 : 0] = other[at : at + r.randint(10, 40)]
        texts.append(" ".join(words))
    return texts
