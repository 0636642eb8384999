"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
NOT_BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def shingles(text: str | None, n: int) -> frozenset:
    words = NOT_BLANK.findall((text or "").translate(LOWER))
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1))


def groups(texts: dict[int, str | None], n: int, percent: int) -> dict[int, tuple[int, int, int]]:
    """id -> (set size, component, links), by comparing all that share an n-gram."""
    sets = {i: shingles(t, n) for i, t in texts.items()}
    owners: dict = {}
    for i in sorted(sets):
        for x in sets[i]:
            owners.setdefault(x, []).append(i)
    root, links = {i: i for i in sets}, Counter()

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sorted(sets):
        for j, same in Counter(j for x in sets[i] for j in owners[x] if j < i).items():
            if 100 * same >= percent * (len(sets[i]) + len(sets[j]) - same):
                links.update([i, j])
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {i: (len(sets[i]), top(i), links[i]) for i in sets}


def without_repeats(texts: dict[int, str | None], length: int) -> dict[int, tuple[int, int, int, str]]:
    """id -> (bytes, removed, runs, digest of the rest)."""
    seen, out = set(), {}
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            piece = data[s : s + length]
            if piece in seen:
                gone[s : s + length] = b"x" * length
            seen.add(piece)
        runs = len(re.findall(rb"x+", bytes(gone)))
        out[i] = len(data), sum(map(bool, gone)), runs, sha(bytes(b for b, g in zip(data, gone) if not g))
    return out


def passages(texts: dict[int, str | None], items: list[tuple[int, str | None]], width: int = 10):
    """id -> (words, hit words, items with an occurring window)."""
    windows: dict[tuple, set] = {}
    for item, text in items:
        words = ALNUM.findall((text or "").translate(LOWER))
        for k in range(max(len(words) - width, 0) + 1) if words else ():
            windows.setdefault(tuple(words[k : k + width]), set()).add(item)
    out = {}
    for i, text in texts.items():
        words = ALNUM.findall((text or "").translate(LOWER))
        hit, found = [False] * len(words), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if items_here := windows.get(tuple(words[k : k + n])):
                    found |= items_here
                    hit[k : k + n] = [True] * n
        out[i] = len(words), sum(hit), sorted(found)
    return out


def luhn(digits: str) -> bool:
    values = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def personal(text: str | None) -> list[str]:
    text, out = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 12 <= len(digits(m)) <= 19 and luhn(digits(m)):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m)) <= 15:
            out.append((m.start(), 3, m.end()))
    return [f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in sorted(out)]


def secrets(text: str | None) -> list[str]:
    text, out = text or "", []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(out)]


def quality(text: str | None) -> tuple[int, int, int, int, int, int]:
    """Words, their characters, symbols, lines with a word, repeated lines, words in repeated windows."""
    text = text or ""
    words = NOT_BLANK.findall(text)
    lines = [x for x in text.split("\n") if NOT_BLANK.search(x)]
    grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    count, inside = Counter(grams), set()
    for k, g in enumerate(grams):
        if count[g] > 1:
            inside |= {k, k + 1, k + 2}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines), len(lines) - len(set(lines)), len(inside)
