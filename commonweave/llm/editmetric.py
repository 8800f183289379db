"""True edit metrics, folding of spellings, and a BK-tree over them."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable

#: Letters without a decomposition, fixed values.
_PLAIN = str.maketrans({"ß": "ss", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "æ": "ae", "Æ": "Ae", "œ": "oe", "Œ": "Oe", "đ": "d", "Đ": "D", "ð": "d", "þ": "th", "ı": "i", "ħ": "h", "ŋ": "n"})
#: Cyrillic letters in Latin spelling, fixed values.
_CYRILLIC = str.maketrans({
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e", "ж": "zh", "з": "z", "и": "i", "й": "j", "к": "k", "л": "l", "м": "m",
    "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "h", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch",
    "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya", "і": "i", "ї": "i", "є": "e", "ґ": "g",
})
_DIGRAPHS = re.compile(r"(?<=[aou])e|(?<=a)a")


def fold(text: str) -> str:
    """Lower case without accents, in Latin letters where the script has a rule."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKD", text.translate(_PLAIN)).lower()
    return "".join(c for c in text if not unicodedata.combining(c)).translate(_CYRILLIC)


#: Latin letters that Cyrillic spellings do not tell apart, fixed values.
_ALIKE = str.maketrans({"w": "v", "c": "k", "q": "k", "x": "h", "j": "i", "y": "i"})


def skeleton(text: str) -> str:
    """A folded word with the letters merged that a Cyrillic spelling merges."""
    return fold(text).replace("sch", "sh").translate(_ALIKE)


def undouble(text: str) -> str:
    """ae, oe, ue and aa, as typed for letters with marks, written as one letter."""
    return _DIGRAPHS.sub("", text)


def levenshtein(a: str, b: str, limit: int = 1 << 30) -> int:
    """Insertions, deletions and substitutions from a to b, bit-parallel; any
    value above limit may be returned as limit + 1. This is a true metric."""
    if a == b:
        return 0
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > limit:
        return limit + 1
    if not a:
        return len(b)
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, score = full, 0, len(a)
    for c in b:
        x = masks.get(c, 0) | minus
        d = (((x & plus) + plus) ^ plus) | x
        up = minus | (full & ~(d | plus))
        down = plus & d
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up = (up << 1) | 1
        plus = ((down << 1) | (full & ~(d | up))) & full
        minus = up & d & full
    return score


def damerau(a: str, b: str) -> int:
    """As levenshtein, with exchanges of two letters as one step, in its
    unrestricted form, which keeps the triangle inequality."""
    if a == b:
        return 0
    last_row: dict[str, int] = {}
    far = len(a) + len(b)
    d = [[far] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        d[i + 1][1] = i
    for j in range(len(b) + 1):
        d[1][j + 1] = j
    for i, x in enumerate(a, 1):
        last_col = 0
        for j, y in enumerate(b, 1):
            row, col = last_row.get(y, 0), last_col
            same = x == y
            if same:
                last_col = j
            d[i + 1][j + 1] = min(d[i][j] + (not same), d[i + 1][j] + 1, d[i][j + 1] + 1, d[row][col] + (i - row - 1) + 1 + (j - col - 1))
        last_row[x] = i
    return d[-1][-1]


def within(a: str, b: str, radius: int) -> bool:
    """damerau(a, b) <= radius; most pairs are decided by levenshtein(), which is at most twice as large."""
    far = levenshtein(a, b, 2 * radius)
    return far <= radius or far <= 2 * radius and damerau(a, b) <= radius


class BkTree:
    """Entries in trees by their edit distances, one tree for each length; every
    entry within a threshold of a query is found.

    The answer is under damerau(), whose exchanges count once. The trees are built
    and pruned under levenshtein(), which is quicker and at most twice as large:
    an entry at damerau distance r lies within levenshtein distance 2r, and where
    a node lies at distance d from the query, the triangle inequality leaves only
    children at distances d - 2r to d + 2r. A tree of strings more than r longer or
    shorter than the query holds no answer, and neither does a leaf with more than
    r letters that the query lacks, or without r + 1 letters of it.
    """

    def __init__(self, entries: Iterable[str]) -> None:
        self.nodes: list[str] = []
        self.children: list[dict[int, int]] = []
        self.letters: list[int] = []
        self.roots: dict[int, int] = {}
        for entry in sorted(set(entries)):
            self._add(entry)

    def _add(self, entry: str) -> None:
        self.nodes.append(entry)
        self.children.append({})
        self.letters.append(_letters(entry))
        new = len(self.nodes) - 1
        at = self.roots.setdefault(len(entry), new)
        while at != new:
            d = levenshtein(entry, self.nodes[at])
            at = self.children[at].setdefault(d, new)

    def within(self, query: str, radius: int) -> list[tuple[int, str]]:
        """(distance, entry) of every entry within radius, nearest first."""
        found, reach, own = [], 2 * radius, _letters(query)
        stack = [root for n, root in self.roots.items() if abs(n - len(query)) <= radius]
        distance = distance_from(query)
        while stack:
            at = stack.pop()
            below, letters = self.children[at], self.letters[at]
            far = (letters & ~own).bit_count() > radius or (own & ~letters).bit_count() > radius
            if far and not below:
                continue
            d = distance(self.nodes[at])
            if not far and d <= reach and (exact := damerau(query, self.nodes[at])) <= radius:
                found.append((exact, self.nodes[at]))
            if below:
                stack += [c for k, c in below.items() if d - reach <= k <= d + reach]
        return sorted(found)


def _letters(text: str) -> int:
    """The set of letters as bits; different letters may share a bit, so that the set is at most smaller."""
    out = 0
    for c in text:
        out |= 1 << (ord(c) & 127)
    return out


def distance_from(a: str) -> Callable[[str], int]:
    """levenshtein(a, .) with the part that depends on `a` alone done once."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    size, full, last = len(a), (1 << len(a)) - 1, 1 << (len(a) - 1) if a else 0

    def distance(b: str) -> int:
        if not size:
            return len(b)
        plus, minus, score = full, 0, size
        for c in b:
            x = masks.get(c, 0) | minus
            d = (((x & plus) + plus) ^ plus) | x
            up = minus | (full & ~(d | plus))
            down = plus & d
            if up & last:
                score += 1
            elif down & last:
                score -= 1
            up = (up << 1) | 1
            plus = ((down << 1) | (full & ~(d | up))) & full
            minus = up & d & full
        return score

    return distance
