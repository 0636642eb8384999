"""Pre-tokens without regular expressions.

The splitting pattern of the tokenizers' own documentation is

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Each code point gets a class; the classes that need a look at the next characters are found by shifting
the arrays. A class is a function from state to state, and functions compose associatively, so the state
before every character comes from a scan over compositions: within rows of equal length all rows at once,
then over the rows' totals, which are far fewer.
"""

from __future__ import annotations

import unicodedata

import numpy as np

# Classes. The first character of a text uses the class plus N_CLASSES: a constant function.
LETTER, NUMBER, OTHER, SHORT, LONG, JOIN, LAST, BLANK, N_CLASSES = range(9)
# States: what the character before belongs to.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, JOINING, IN_BLANKS, ONE_LEFT, TWO_LEFT, N_STATES = range(9)

#: Code points with the White_Space property (fixed values).
BLANKS = (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

ROW = 64


def _step(state: int, kind: int) -> tuple[int, bool]:
    """Next state, and whether a pre-token begins with this character."""
    if state == TWO_LEFT:
        return ONE_LEFT, False
    if state == ONE_LEFT:
        return FRESH, False
    if kind in (LETTER, NUMBER, OTHER):
        run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}[kind]
        return run, state not in (run, JOINING)
    if kind in (SHORT, LONG):  # an apostrophe that can begin a contraction
        if state in (IN_OTHERS, JOINING):
            return IN_OTHERS, False
        return (ONE_LEFT if kind == SHORT else TWO_LEFT), True
    if kind == JOIN:
        return JOINING, True
    if kind == LAST:
        return FRESH, True
    return IN_BLANKS, state != IN_BLANKS


class Splitter:
    def __init__(self):
        self.kinds = np.full(0x110000, 255, dtype=np.uint8)
        self.kinds[list(BLANKS)] = BLANK
        self.begins = np.array(
            [[_step(s, k % N_CLASSES)[1] or k >= N_CLASSES for k in range(2 * N_CLASSES)] for s in range(N_STATES)]
        )
        generators = [tuple(_step(s, k)[0] for s in range(N_STATES)) for k in range(N_CLASSES)]
        generators += [(g[FRESH],) * N_STATES for g in generators]
        known = {g: i for i, g in enumerate(dict.fromkeys(generators))}
        todo = list(known)
        for f in todo:  # all compositions; there are a few dozen
            for g in generators:
                h = tuple(g[s] for s in f)
                if h not in known:
                    known[h] = len(known)
                    todo.append(h)
        self.function = np.array([known[g] for g in generators], dtype=np.int32)
        self.table = np.array(list(known), dtype=np.int32)
        self.compose = np.array([[known[tuple(g[s] for s in f)] for g in known] for f in known], dtype=np.int32)

    def _classes(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        kinds = self.kinds[points]
        for point in np.unique(points[kinds == 255]).tolist():
            group = unicodedata.category(chr(point))[0]
            self.kinds[point] = LETTER if group == "L" else NUMBER if group == "N" else OTHER
        kinds = self.kinds[points]
        n = len(points)
        quote = np.flatnonzero(points == ord("'"))  # few: their next characters are looked at one by one
        quote = quote[quote + 1 < n]
        quote = quote[~first[quote + 1]]
        one = points[quote + 1]
        short = quote[np.isin(one, [ord(c) for c in "stmd"])]
        two = np.where(quote + 2 < n, points[np.minimum(quote + 2, n - 1)], 0)
        two[first[np.minimum(quote + 2, n - 1)]] = 0
        long = quote[(np.isin(one, [ord(c) for c in "rv"]) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))]
        last = kinds == BLANK
        last[:-1] &= (kinds[1:] != BLANK) & ~first[1:]
        if n:
            last[-1] = False
        kinds[last] = np.where(points[last] == 0x20, JOIN, LAST)
        kinds[short], kinds[long] = SHORT, LONG
        return kinds

    def _before(self, functions: np.ndarray) -> np.ndarray:
        """Composition of all functions before each place (index of the identity-free prefix, -1: none)."""
        n = len(functions)
        rows = -(-n // ROW)
        grid = np.zeros(rows * ROW, dtype=np.int32)
        grid[:n] = functions
        grid = grid.reshape(rows, ROW).T.copy()
        for k in range(1, ROW):
            grid[k] = self.compose[grid[k - 1], grid[k]]
        if rows == 1:
            return grid.T.reshape(-1)[:n]
        total = self._before(grid[-1])  # inclusive over rows
        grid[:, 1:] = self.compose[total[:-1], grid[:, 1:]]
        return grid.T.reshape(-1)[:n]

    def split(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Byte positions at which the pre-tokens of all texts begin."""
        if not len(data):
            return np.zeros(0, dtype=np.int64)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        places = np.flatnonzero((data & 0xC0) != 0x80)
        first = np.zeros(len(data) + 1, dtype=bool)
        first[offsets] = True
        first = first[places]
        kinds = self._classes(points, first).astype(np.int32) + N_CLASSES * first
        after = self.table[self._before(self.function[kinds]), FRESH]
        before = np.concatenate([[FRESH], after[:-1]])
        return places[self.begins[before, kinds]]


def distinct_slices(data, begin, end, hashes) -> tuple[np.ndarray, np.ndarray]:
    """One representative of each different slice, and for each slice the number of its representative."""
    one, two = hashes
    one.load(data)
    two.load(data)
    key, check = one.of(begin, end), two.of(begin, end)
    _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    if not np.array_equal(check[first][inverse], check):  # two slices with one hash
        _, first, inverse = np.unique(np.stack([key, check], 1), axis=0, return_index=True, return_inverse=True)
    return first, inverse.reshape(-1)
