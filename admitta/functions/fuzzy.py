"""String similarities (X1 to X3), 0 to 100, as Arrow functions.

The base is the Indel ratio: twice the longest common subsequence over the sum of the lengths. The
subsequence is counted with bits: one per character of the shorter string, one row of bits per
character of the other. The ``*_many`` functions hold the rows of many pairs, and of all windows of a
pair, in one array and step through the characters together; a string of more than 64 characters on
both sides is counted on its own with one big integer.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of one row.
WORD = 64
#: Elements of the largest array held at a time, and of the rows of windows, which should stay in the cache.
CHUNK, CACHED = 1 << 22, 1 << 15
#: Times that a character counts on its own in a bag, and characters of the longest text whose subsequences are counted for a bound.
ALONE, LONG = 16, 256


def _places(text: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(text):
        out[c] = out.get(c, 0) | 1 << i
    return out


def _common(size: int, places: dict[str, int], text: str) -> int:
    full = (1 << size) - 1
    row = full
    for c in text:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    return _common(len(a), _places(a), b)


def indel_ratio(a: str, b: str) -> float:
    """X3. Two empty strings are equal."""
    total = len(a) + len(b)
    return 200.0 * common_subsequence(a, b) / total if total else 100.0


def partial_ratio(a: str, b: str) -> float:
    """The shorter string against every stretch of the longer one, cut stretches at both ends included.

    Empty on one side gives 0, on both 100. For equal lengths either string is tried as the shorter.
    """
    if not a or not b:
        return 100.0 if a == b else 0.0
    if len(a) == len(b) and a != b:
        return max(_slide(a, b), _slide(b, a))
    return _slide(a, b) if len(a) <= len(b) else _slide(b, a)


def _slide(short: str, long: str) -> float:
    n = len(short)
    if short in long:
        return 100.0
    places = _places(short)
    windows = (long[max(0, end - n) : end] for end in range(1, len(long) + n))
    return max(200.0 * _common(n, places, w) / (n + len(w)) for w in windows)


def _codes(texts: Sequence[str], pad: int) -> np.ndarray:
    wide = np.array(texts, dtype=f"<U{max(map(len, texts))}").view(np.uint32).reshape(len(texts), -1)
    return np.where(wide == 0, np.uint32(pad), wide)


def _masks(patterns: Sequence[str], texts: Sequence[str], depth: int = 1) -> np.ndarray:
    """Per word of bits and character of each text the bits of the places where its pattern has it."""
    p, t = _codes(patterns, 0xFFFFFFFE), _codes(texts, 0xFFFFFFFF)
    same = np.packbits(p[:, None, :] == t[:, :, None], axis=2, bitorder="little")
    wide = np.zeros((*same.shape[:2], 8 * depth), dtype=np.uint8)
    wide[:, :, : same.shape[2]] = same
    return np.moveaxis(wide.view("<u8"), 2, 0)


def _step(row: np.ndarray, masks: Sequence[np.ndarray]) -> None:
    """One character further; sums that overflow a word of bits carry into the next."""
    carry = None
    for bits, mask in zip(row, masks):
        hit = bits & mask
        up = bits + hit
        if len(row) > 1:
            over = up < hit
            if carry is not None:
                up += carry
                over |= (up == 0) & carry
            carry = over
        bits -= hit
        bits |= up


def _chunks(pairs: np.ndarray, width: int, most: int = CHUNK):
    step = max(1, most // max(1, width))
    return (pairs[i : i + step] for i in range(0, len(pairs), step))


def common_subsequences(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """Lengths of the longest common subsequences of many pairs."""
    out = np.zeros(len(a), dtype=np.int64)
    short = [x if len(x) <= len(y) else y for x, y in zip(a, b)]
    long = [y if len(x) <= len(y) else x for x, y in zip(a, b)]
    size = np.fromiter(map(len, short), dtype=np.int64, count=len(short))
    plain = np.fromiter(("\0" not in x and "\0" not in y for x, y in zip(short, long)), dtype=bool, count=len(short))
    for i in np.flatnonzero((size > WORD) | ~plain):
        out[i] = common_subsequence(a[i], b[i])
    able = np.flatnonzero((size > 0) & (size <= WORD) & plain)
    reach = max((len(long[i]) for i in able), default=0)
    for part in _chunks(able, WORD * reach):
        masks = _masks([short[i] for i in part], [long[i] for i in part])[0]
        row = np.full(len(part), ~np.uint64(0))
        for k in range(masks.shape[1]):
            hit = row & masks[:, k]
            row = (row + hit) | (row - hit)
        out[part] = WORD - np.bitwise_count(row).astype(np.int64)
    return out


def indel_ratios(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """X3 of many pairs."""
    total = np.fromiter((len(x) + len(y) for x, y in zip(a, b)), dtype=np.float64, count=len(a))
    return np.where(total > 0, 200.0 * common_subsequences(a, b) / np.maximum(total, 1), 100.0)


def token_set_ratios(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """X1 of many pairs. Empty on either side gives 0; one set of words inside the other gives 100.

    The joined words of both sides begin with the shared ones, so only the others are compared.
    """
    out = np.zeros(len(a))
    words: dict[str, frozenset[str]] = {}
    rest, left, right, shared = [], [], [], []
    for i, (x, y) in enumerate(zip(a, b)):
        u = words.get(x)
        if u is None:
            u = words[x] = frozenset(x.split())
        v = words.get(y)
        if v is None:
            v = words[y] = frozenset(y.split())
        if not u or not v:
            continue
        both = u & v
        if len(both) == min(len(u), len(v)):
            out[i] = 100.0
            continue
        rest.append(i)
        left.append(" ".join(sorted(u - both)))
        right.append(" ".join(sorted(v - both)))
        shared.append(sum(map(len, both)) + len(both) - 1 if both else 0)
    if rest:
        l, r = (np.fromiter(map(len, s), dtype=np.float64, count=len(rest)) for s in (left, right))
        s = np.array(shared, dtype=np.float64)
        gap = (s > 0) * 1.0
        whole = 200.0 * (s + gap + common_subsequences(left, right)) / (2 * (s + gap) + l + r)
        alone = [200.0 * s / (2 * s + gap + side) for side in (l, r)]
        out[rest] = np.where(s > 0, np.maximum(whole, np.maximum(*alone)), whole)
    return out


def partial_ratios(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """X2 of many pairs: all windows of pairs with shorter sides of about one length go together."""
    out = np.zeros(len(a))
    by_depth: dict[int, list[tuple[int, str, str]]] = {}
    for i, (x, y) in enumerate(zip(a, b)):
        if not x or not y:
            out[i] = 100.0 if x == y else 0.0
        elif x in y or y in x:
            out[i] = 100.0
        elif min(len(x), len(y)) > LONG or "\0" in x or "\0" in y:
            out[i] = partial_ratio(x, y)
        else:
            if len(x) <= len(y):
                by_depth.setdefault((len(x) + WORD - 1) // WORD, []).append((i, x, y))
            if len(y) <= len(x):
                by_depth.setdefault((len(y) + WORD - 1) // WORD, []).append((i, y, x))
    for depth, group in by_depth.items():
        group.sort(key=lambda p: (-len(p[1]), len(p[2])))
        reach = sorted(len(x) + len(y) for _, x, y in group)
        for part in _chunks(np.arange(len(group)), reach[len(group) * 9 // 10] * depth, CACHED):
            some = [group[k] for k in part]
            at = np.array([i for i, _, _ in some])
            n, sizes = (np.array([len(p[k]) for p in some])[:, None] for k in (1, 2))
            most = int(n[0, 0])
            masks = _masks([x for _, x, _ in some], [y for _, _, y in some], depth)
            padded = np.zeros((*masks.shape[:2], masks.shape[2] + 2 * (most - 1)), dtype=np.uint64)
            padded[:, :, most - 1 : most - 1 + masks.shape[2]] = masks
            windows = masks.shape[2] + most - 1
            row = np.full((depth, len(some), windows), ~np.uint64(0))
            for k in range(most):
                able = int(np.searchsorted(-n[:, 0], -k))
                _step(row[:, :able], padded[:, :able, k : k + windows])
            common = depth * WORD - np.bitwise_count(row).sum(axis=0, dtype=np.int64)
            starts = np.arange(1 - most, windows + 1 - most)[None, :]
            length = np.minimum(starts + n, sizes) - np.maximum(starts, 0)
            best = np.where(length > 0, 200.0 * common / (n + np.maximum(length, 1)), 0.0).max(axis=1)
            np.maximum.at(out, at, best)
    return out


class Numbered:
    """Texts as numbers of their characters, a row each; 0 after the end. Texts over LONG, or with a zero character, are not ``able``."""

    def __init__(self, codes: np.ndarray, size: np.ndarray, able: np.ndarray, letters: int) -> None:
        self.codes, self.size, self.able, self.letters = codes, size, able, letters
        self.steps, self._masks = codes.T.copy(), {}

    def back(self) -> Numbered:
        """The same texts from their ends to their beginnings."""
        place = self.size[:, None] - 1 - np.arange(self.codes.shape[1])
        return Numbered(np.where(place >= 0, np.take_along_axis(self.codes, np.clip(place, 0, self.codes.shape[1] - 1), axis=1), 0), self.size, self.able, self.letters)

    def masks(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Per word of bits, text of this depth and character the bits of the character's places; and the place of each text."""
        if depth not in self._masks:
            some = np.flatnonzero(self.able & (np.maximum((self.size + WORD - 1) // WORD, 1) == depth))
            out = np.zeros((depth, len(some) * self.letters), dtype=np.uint64)
            base = np.arange(len(some)) * self.letters
            for k, codes in enumerate(self.steps[:, some]):
                out[k // WORD, base + codes] |= np.uint64(1 << k % WORD)
                if k + 1 == depth * WORD:
                    break
            out[:, base] = 0
            place = np.zeros(len(self.size), dtype=np.int64)
            place[some] = base
            self._masks[depth] = out, place
        return self._masks[depth]


def _numbered(*sides: Sequence[str]) -> list[Numbered]:
    size = [np.fromiter(map(len, t), dtype=np.int32) for t in sides]
    able = [np.fromiter((len(x) <= LONG and "\0" not in x for x in t), dtype=bool) for t in sides]
    points = [np.array([x if k else "" for x, k in zip(t, ok)], dtype=f"<U{LONG}").view(np.uint32).reshape(-1, LONG)[:, : max(1, n[ok].max(initial=0))] for t, ok, n in zip(sides, able, size)]
    letters = np.unique(np.concatenate([[0], *(np.unique(p) for p in points)]))
    number = np.zeros(letters[-1] + 1, dtype=np.int32)
    number[letters] = np.arange(len(letters))
    return [Numbered(number[p], n, ok, len(letters)) for p, n, ok in zip(points, size, able)]


def _subsequences(a: Numbered, b: Numbered, i: np.ndarray, j: np.ndarray, begins: bool = False) -> np.ndarray:
    """Lengths of the longest common subsequences of pairs, or the largest ratio of the first text to a beginning of the second.

    Of texts that are not able the shorter length, or 1.
    """
    out = np.ones(len(i)) if begins else np.minimum(a.size[i], b.size[j])
    able = np.flatnonzero(a.able[i] & b.able[j])
    depth = np.maximum((a.size + WORD - 1) // WORD, 1)[i[able]]
    for d in np.unique(depth):
        some = able[depth == d]
        some = some[np.lexsort((i[some], b.size[j[some]]))]
        masks, at = a.masks(d)
        for part in _chunks(np.arange(len(some)), 1, CACHED // 4):
            r, base, n = j[some[part]], at[i[some[part]]], a.size[i[some[part]]]
            row, ratio = np.full((d, len(part)), ~np.uint64(0)), np.zeros(len(part))
            for k in range(int(min(n.max(), b.size[r].max()) if begins else b.size[r].max())):
                place = base + b.steps[k].take(r)
                _step(row, [m.take(place) for m in masks])
                if begins:
                    np.maximum(ratio, 2.0 * (d * WORD - np.bitwise_count(row).sum(axis=0, dtype=np.int32)) / (n + k + 1), out=ratio)
            out[some[part]] = ratio if begins else d * WORD - np.bitwise_count(row).sum(axis=0, dtype=np.int32)
    return out


class Bounds:
    """Bounds of X1 and X2, 0 to 1, for pairs (i, j) of the texts ``a`` and ``b``.

    The shared words bound X1 from below. The characters of a pair in any order, and then its longest
    common subsequence, bound both from above: no stretch has more in common than the whole text, and the
    words that are not shared are a subsequence of the sorted words.
    """

    def __init__(self, a: Sequence[str], b: Sequence[str]) -> None:
        self.texts, words = (a, b), [[frozenset(x.split()) for x in t] for t in (a, b)]
        number = lambda values: np.fromiter(values, dtype=np.int32)
        self.words = words[0]
        self.size, self.count = [number(map(len, t)) for t in self.texts], [number(map(len, w)) for w in words]
        self.joined = [number(sum(map(len, w)) + len(w) for w in s) for s in words]
        self.raw, self.sorted = _numbered(*self.texts), _numbered(*([" ".join(sorted(w)) for w in s] for s in words))
        self.back = [x.back() for x in self.raw]
        self.blank = [number(sum(map(str.isspace, x)) for x in t) for t in self.texts]
        places: dict[str, list[int]] = {}
        known = frozenset().union(*words[0])
        for j, w in enumerate(words[1]):
            for x in w & known:
                places.setdefault(x, []).append(j)
        self.places = {x: np.array(v) for x, v in places.items()}
        self._bags()

    def _bags(self) -> None:
        """A bit per character and time it occurs, up to ALONE times; what is beyond is counted together."""
        counts = [[Counter(x) for x in t] for t in self.texts]
        most = [Counter(), Counter()]
        for m, side in zip(most, counts):
            for c in side:
                m |= c
        kept = {c: min(n, most[1][c], ALONE) for c, n in most[0].items() if c in most[1] and not c.isspace()}
        start, bits = {}, 0
        for c, n in kept.items():
            start[c], bits = bits, bits + n
        self.bag, self.beyond = [], []
        for side in counts:
            rows, over = [], []
            for c in side:
                row = rest = 0
                for x, n in c.items():
                    if x in start:
                        row |= ((1 << min(n, kept[x])) - 1) << start[x]
                        rest += max(0, n - ALONE)
                rows.append(row.to_bytes((bits + WORD) // WORD * 8, "little"))
                over.append(rest)
            self.bag.append(np.frombuffer(b"".join(rows), dtype="<u8").reshape(len(side), -1).T.copy())
            self.beyond.append(np.array(over, dtype=np.int32))

    def shared(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Number and joined length, a blank after each, of the words that text i shares with each b."""
        count, length = np.zeros((2, len(self.texts[1])), dtype=np.int32)
        for w in self.words[i]:
            at = self.places.get(w)
            if at is not None:
                count[at] += 1
                length[at] += len(w) + 1
        return count, length

    def least(self, i: int, count: np.ndarray, length: np.ndarray) -> np.ndarray:
        """X1 of text i with each b is this at least."""
        a, b = self.joined[0][i] - 1, self.joined[1] - 1
        s = length - 1.0
        alone = 2 * s / np.maximum(2 * s + 1 + np.minimum(a, b) - length, 1)
        whole = 2.0 * length / np.maximum(a + b, 1)
        return np.where(count == 0, 0.0, np.where(count == np.minimum(self.count[0][i], self.count[1]), 1.0, np.maximum(alone, whole)))

    def by_bags(self, i: np.ndarray | int, j: np.ndarray, count: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """X1 and X2 are these at most; count and length are those of ``shared``, for the pairs."""
        common = np.minimum(self.beyond[0][i], self.beyond[1][j])
        for x, y in zip(*self.bag):
            common += np.bitwise_count(x[i] & y[j])
        blanks = np.minimum(self.blank[0][i], self.blank[1][j])
        others = common - (length - count) + np.minimum(self.count[0][i], self.count[1][j]) - count - 1
        return self._sets(i, j, count, length, others), self._stretches(i, j, common + blanks)

    def by_subsequences(self, i: np.ndarray, j: np.ndarray, count: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``by_bags``, and closer; and the length of the longest common subsequence."""
        common = _subsequences(*self.raw, i, j)
        return self._sets(i, j, count, length, _subsequences(*self.sorted, i, j)), self._stretches(i, j, common), common

    def by_ends(self, i: np.ndarray, j: np.ndarray, common: np.ndarray) -> np.ndarray:
        """X2 is this at most: stretches cut at an end are compared, a whole one has no more in common than the whole text."""
        size = [self.size[0][i], self.size[1][j]]
        out = common / np.maximum(np.minimum(*size), 1)
        for s, at, some in ((slice(None), (i, j), size[0] <= size[1]), (slice(None, None, -1), (j, i), size[1] <= size[0])):
            k = np.flatnonzero(some)
            for texts in (self.raw[s], self.back[s]):
                out[k] = np.maximum(out[k], _subsequences(*texts, at[0][k], at[1][k], True))
        return np.where((size[0] == 0) & (size[1] == 0), 1.0, out)

    def _sets(self, i, j, count, length, others) -> np.ndarray:
        a, b = self.joined[0][i] - 1, self.joined[1][j] - 1
        fewer = np.minimum(self.count[0][i], self.count[1][j])
        side = np.minimum(a, b) - length
        whole = 2.0 * (length + np.maximum(np.minimum(others, side), 0)) / np.maximum(a + b, 1)
        alone = 2 * (length - 1.0) / np.maximum(2 * (length - 1.0) + 1 + side, 1)
        return np.where(fewer == 0, 0.0, np.where(count == fewer, 1.0, np.maximum(whole, alone)))

    def _stretches(self, i, j, common) -> np.ndarray:
        n = np.minimum(self.size[0][i], self.size[1][j])
        common = np.minimum(common, n)
        return np.where(n > 0, 2.0 * common / np.maximum(n + common, 1), (self.size[0][i] == self.size[1][j]) * 1.0)


def _column(many):
    @F.pandas_udf(T.DoubleType())
    def call(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(many(a.fillna("").tolist(), b.fillna("").tolist()), dtype="float64")

    return call


token_set = _column(token_set_ratios)
partial = _column(partial_ratios)
indel = _column(indel_ratios)
