"""Exact byte-level BPE over an Aho-Corasick automaton, in linear time.

A byte string is mapped to Latin-1, so that one character is one byte and the
automaton can find, for every position, the longest vocabulary entry that
starts there. Encoding then takes longest matches from the left and steps back
to shorter ones where two neighbouring tokens could not both survive the
merges. Whether two tokens may stand side by side depends on these two only,
so the answers are memoised; a set of dead positions keeps the walk linear.
The result equals that of merging pairs by rank.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable

import ahocorasick
import regex

#: Pieces within which merges happen; fixed with the vocabulary.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Distinct pieces remembered by one worker, and the longest one remembered.
MEMO_PIECES, MEMO_CHARS = 400_000, 40


class ByteBpe:
    """A vocabulary of (bytes, rank) lines in base64, and its encoder."""

    def __init__(self, path: str, pieces: str = PIECES) -> None:
        self.ranks: dict[str, int] = {}
        with open(path, "rb") as lines:
            for line in lines:
                if line.strip():
                    token, rank = line.split()
                    self.ranks[base64.b64decode(token).decode("latin-1")] = int(rank)
        self.pieces = regex.compile(pieces)
        self.length = {rank: len(token) for token, rank in self.ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.automaton.add_word(token, (len(token), rank))
        self.automaton.make_automaton()
        self.memo: dict[str, list[int]] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self._learn_splits()

    def _learn_splits(self) -> None:
        """For each token its longest proper prefix in the vocabulary, and the
        pair of which the merges made it."""
        self.shorter: dict[int, int] = {}
        self.split: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        ranks = self.ranks
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            for n in range(len(token) - 1, 0, -1):
                if (r := ranks.get(token[:n])) is not None:
                    self.shorter[rank] = r
                    break
            self.split[rank] = (rank, rank)
            n = len(token) - 1
            while n > 0:
                left, right = ranks.get(token[:n]), ranks.get(token[n:])
                if left is not None and right is not None and left < rank and right < rank and self._fit(left, right):
                    self.split[rank] = (left, right)
                    self.merged[left, right] = rank
                    break
                n -= 1
        self.fits.clear()  # answers given while pairs were still missing

    def _fit(self, left: int, right: int) -> bool:
        """Can the two tokens stand side by side in an encoding? Their inner
        edges are undone merge by merge, latest first; they cannot if at some
        point a merge across the edge has a lower rank than the one undone."""
        merged, split = self.merged, self.split
        limit = 1 << 62
        while True:
            across = merged.get((left, right))
            if across is not None and across < limit:
                return False
            if left > right:
                limit, left = left, split[left][1]
                if left == limit:
                    limit, right = right + 1, split[right][0]
                    if right + 1 == limit:
                        return True
            else:
                limit, right = right + 1, split[right][0]
                if right + 1 == limit:
                    limit, left = left, split[left][1]
                    if left == limit:
                        return True

    def _piece(self, piece: str) -> list[int]:
        text = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        if (whole := self.ranks.get(text)) is not None:
            return [whole]
        size = len(text)
        longest = [0] * size
        for end, (n, rank) in self.automaton.iter(text):
            longest[end - n + 1] = rank  # ends ascend, so the longest is written last
        alive = bytearray(b"\x01") * (size + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        length, shorter, fits = self.length, self.shorter, self.fits
        while True:
            before = out[-1] if out else None
            while True:
                end = at + length[token]
                if alive[end]:
                    if before is None:
                        ok = True
                    elif (ok := fits.get((before, token))) is None:
                        if len(fits) > 2_000_000:
                            fits.clear()
                        ok = fits[before, token] = self._fit(before, token)
                    if ok:
                        out.append(token)
                        at = end
                        if at == size:
                            return out
                        token = longest[at]
                        break
                next_token = shorter.get(token)
                if next_token is None:
                    alive[at] = 0
                    token = out.pop()
                    at -= length[token]
                    break
                token = next_token

    def encode(self, text: str | None) -> list[int]:
        """The ids of text without special tokens; [] for null and ''."""
        if not text:
            return []
        ids: list[int] = []
        memo = self.memo
        for m in self.pieces.finditer(text):
            piece = m.group()
            found = memo.get(piece)
            if found is None:
                found = self._piece(piece)
                if len(piece) <= MEMO_CHARS:
                    if len(memo) >= MEMO_PIECES:
                        memo.clear()
                    memo[piece] = found
            ids.extend(found)
        return ids

    def count(self, text: str | None) -> int:
        """The number of ids of text."""
        return len(self.encode(text))


_loaded: dict[str, ByteBpe] = {}


def loaded(path: str) -> ByteBpe:
    """The encoder of this worker process, built once."""
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


def encode_all(path: str, texts: Iterable[str | None]) -> list[list[int]]:
    """The ids of every text."""
    bpe = loaded(path)
    return [bpe.encode(t) for t in texts]
