"""Byte-pair merges: the merge list, its lookahead, and the exact merging of one piece of text."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

import numpy as np
import regex

#: White space as the tokenizer patterns see it (the Unicode property); fixed values.
SPACE = "\t-\r \x85\xa0  -     　"
_NEVER = 1 << 60
_NONE = np.int32(0x7FFFFFFF)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_WIDTHS, _ROWS = (6, 10, 16, 32), 1 << 13


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if visible, else the next free one from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in visible else next(free)) for b in range(256)]


class Merges:
    """A merge list over byte letters, with the suffix (if any) that marks the last letter of a word."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.decoder = (spec.get("decoder") or {}).get("type")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: name for name, i in [*vocab.items(), *self.special.items()]}
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            key = (vocab[left], vocab[right])
            if key not in self.rank:
                self.rank[key] = rank
                self.made[rank] = vocab[left + right]
        letters = byte_letters()
        # One number for a pair is a quicker key than a tuple.
        self.pair_rank = {left << 24 | right: rank for (left, right), rank in self.rank.items()}
        self.first = [vocab.get(x, -1) for x in letters]
        self.last = [vocab.get(x + self.suffix, -1) for x in letters]
        self.complete = min(self.first) >= 0 and min(self.last) >= 0
        self.width = {i: len(name.removesuffix(self.suffix) if self.suffix else name) for name, i in vocab.items()}
        self.lookahead = self._lookahead()
        self._table()

    def _lookahead(self) -> int:
        """Letters after a token that can still change where it ends.

        A token `a` keeps its end unless its right neighbour joins it by some merge (a, b). That
        neighbour in turn may be taken away, while it waits, by a merge of lower rank with what
        follows it, and so on; ranks fall along the chain, so it ends. One pass in rank order bounds
        its length: `reach[t]` covers merges of `t` with a right neighbour seen so far, `form[t]` what
        the forming of `t` itself could depend on.
        """
        reach: dict[int, int] = {}
        form: dict[int, int] = {}
        for (left, right), rank in self.rank.items():
            beyond = max(reach.get(right, 0), form.get(right, 0))
            new = self.made[rank]
            form[new] = max(form.get(new, 0), beyond)
            reach[left] = max(reach.get(left, 0), self.width[right] + beyond)
        longest = max(self.width.values(), default=1)
        return max([longest, *reach.values(), *form.values()])

    def merged(self, ids: list[int]) -> list[int]:
        """Merge the pair of the lowest rank, the leftmost of several, until none is left."""
        rank, made = self.pair_rank.get, self.made
        ranks = [rank(a << 24 | b, _NEVER) for a, b in zip(ids, ids[1:])]
        while ranks:
            low = min(ranks)
            if low == _NEVER:
                break
            i = ranks.index(low)
            ids[i] = new = made[low]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(ids[i - 1] << 24 | new, _NEVER)
            if i < len(ranks):
                ranks[i] = rank(new << 24 | ids[i + 1], _NEVER)
        return ids

    def _table(self) -> None:
        """The pair ranks once more as an open-addressing table that numpy can ask for many pairs at once."""
        bits = max(8, (4 * len(self.pair_rank)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, _EMPTY, np.uint64)
        self.values = np.full(1 << bits, _NONE, np.int32)
        for key, rank in self.pair_rank.items():
            slot = int((key * int(_SPREAD) & 0xFFFFFFFFFFFFFFFF) >> int(self.shift))
            while self.keys[slot] != _EMPTY:
                slot = (slot + 1) % len(self.keys)
            self.keys[slot], self.values[slot] = key, rank
        self.made_of = np.fromiter((self.made.get(r, 0) for r in range(max(self.made, default=0) + 1)), np.int64)
        self.first_of, self.last_of = np.array(self.first, np.int64), np.array(self.last, np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.uint64) << np.uint64(24)) | right.astype(np.uint64)
        slot = ((key * _SPREAD) >> self.shift).astype(np.int64)
        out = np.where(self.keys[slot] == key, self.values[slot], _NONE)
        left_over = np.flatnonzero((self.keys[slot] != key) & (self.keys[slot] != _EMPTY))
        while len(left_over):
            slot = (slot[left_over] if len(slot) != len(left_over) else slot) + 1
            slot %= len(self.keys)
            key = key[left_over] if len(key) != len(left_over) else key
            hit = self.keys[slot] == key
            out.flat[left_over[hit]] = self.values[slot[hit]]
            go_on = ~hit & (self.keys[slot] != _EMPTY)
            left_over, slot, key = left_over[go_on], slot[go_on], key[go_on]
        return out

    def _level(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of at most `width` letters, one a row: the same merging, one step in all rows at a time."""
        n = len(pieces)
        raw = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), np.uint8).reshape(n, width)
        size = np.fromiter(map(len, pieces), np.int64, n)
        columns = np.arange(width)
        ids = np.where(columns < size[:, None], self.first_of[raw], -1)
        ends = raw[np.arange(n), size - 1]
        ids[np.arange(n), size - 1] = self.last_of[ends]
        ranks = np.full((n, width), _NONE, np.int32)
        inner = columns[1:] < size[:, None]
        ranks[:, :-1][inner] = self._ranks(ids[:, :-1][inner], ids[:, 1:][inner])
        rows, out = np.arange(n), np.full((n, width), -1, np.int32)
        while True:
            at = ranks.argmin(1)
            low = ranks[np.arange(len(at)), at]
            busy = low != _NONE
            if not busy.all():
                out[rows[~busy]] = ids[~busy]
                if not busy.any():
                    break
                rows, ids, ranks, at, low = rows[busy], ids[busy], ranks[busy], at[busy], low[busy]
            mine = np.arange(len(at))
            ids[mine, at] = self.made_of[low]
            # What stands right of the pair moves one place to the left.
            source = np.minimum(columns + (columns > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, source, 1)
            ids[:, -1] = -1
            ranks = np.take_along_axis(ranks, np.minimum(columns + (columns >= at[:, None]), width - 1), 1)
            ranks[:, -1] = _NONE
            for where in (at - 1, at):
                ok = np.flatnonzero((where >= 0) & (where + 1 < width))
                ok = ok[ids[ok, where[ok] + 1] >= 0]
                ranks[ok, where[ok]] = self._ranks(ids[ok, where[ok]], ids[ok, where[ok] + 1])
        present = out >= 0
        return out[present], present.sum(1)

    def many(self, pieces: Iterable[bytes]) -> dict[bytes, np.ndarray]:
        """The ids of many pieces. Short ones are merged together, long ones one by one as streams."""
        found: dict[bytes, np.ndarray] = {}
        by_width: dict[int, list[bytes]] = {w: [] for w in _WIDTHS}
        for piece in dict.fromkeys(pieces):
            width = next((w for w in _WIDTHS if len(piece) <= w), 0)
            if piece and width and self.complete:
                by_width[width].append(piece)
            else:
                found[piece] = np.array(self.ids(piece), np.int32)
        for width, group in by_width.items():
            for k in range(0, len(group), _ROWS):
                part = group[k : k + _ROWS]
                flat, sizes = self._level(part, width)
                ends = np.cumsum(sizes)
                found.update((piece, flat[a:b]) for piece, a, b in zip(part, (ends - sizes).tolist(), ends.tolist()))
        return found

    def letters(self, piece: bytes, ends: bool = True) -> list[int]:
        """The first symbols of a piece; the last letter of a word has a symbol of its own."""
        ids = [*map(self.first.__getitem__, piece)]
        if ends:
            ids[-1] = self.last[piece[-1]]
        return ids if min(ids) >= 0 else [i for i in ids if i >= 0]

    def stream(self, piece: bytes, window: int | None = None):
        """Lists of ids of one piece. Only `window` letters are ever held as symbols: a token goes out
        once `lookahead` more letters have been seen after it, for then nothing can change it."""
        step = self.lookahead
        window = max(window or 0, 2 * step + 64)
        at = 0
        while len(piece) - at > window:
            ids = self.merged(self.letters(piece[at : at + window], False))
            out, end = [], 0
            for i in ids:
                if end + self.width[i] + step > window:
                    break
                out.append(i)
                end += self.width[i]
            yield out
            at += end
        if at < len(piece):
            yield self.merged(self.letters(piece[at:]))

    def ids(self, piece: bytes) -> list[int]:
        if len(piece) <= self.lookahead:
            return self.merged(self.letters(piece)) if piece else []
        return [i for part in self.stream(piece) for i in part]


class Memo(dict):
    """A bounded memory of what was worked out for short strings; it starts anew when it is full."""

    def __init__(self, work: Callable[[list[str]], list], most: int = 400_000, longest: int = 64):
        super().__init__()
        self.work, self.most, self.longest = work, most, longest

    def learn(self, keys: Iterable[str]) -> None:
        """Work out together what is not known yet."""
        wanted = {k for k in set(keys) if len(k) <= self.longest}
        new = [k for k in wanted if k not in self]
        if len(self) + len(new) > self.most:
            self.clear()
            new = list(wanted)
        self.update(zip(new, self.work(new)))

    def __missing__(self, key: str):
        return self.work([key])[0]


def special_pieces(text: str, special: dict[str, int]) -> list[str]:
    """The text cut around special strings; every second item is one of them."""
    if not special or not any(s in text for s in special):
        return [text]
    longest_first = sorted(special, key=len, reverse=True)
    return regex.split("(" + "|".join(map(regex.escape, longest_first)) + ")", text)


def blocks(values: list[str], letters: int = 1 << 21) -> Iterable[tuple[int, int]]:
    """Index ranges of texts that together have about so many letters."""
    start = size = 0
    for k, value in enumerate(values):
        size += len(value)
        if size >= letters:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(values):
        yield start, len(values)
