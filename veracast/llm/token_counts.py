"""Token counts by a finite-state transducer whose chunk maps compose."""

from __future__ import annotations

import re
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import arrow_stage, held, text_list, texts
from .tokenizer import SPACE, Memo, Merges, blocks, special_pieces

#: How the vocabulary's makers cut text into pieces before merging; fixed value.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")
#: One transition: the white space before a run and the run itself, or white space at the very end.
_STEPS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: After a visible character, white space always begins a new piece: the state there is the start state.
_SURE = re.compile(f"[^{SPACE}](?=[{SPACE}])")
_CHUNK = 1 << 16


class StateMap(NamedTuple):
    """What a chunk does to the transducer from any state it may be entered in.

    The state is the text read since the last sure boundary. Up to the chunk's own first boundary
    (`head`) the outcome depends on it; from there on it does not, so a count is fixed; `tail` is the
    state left behind. Without a boundary (`whole`) the chunk only lengthens the state.
    """

    head: str
    count: int
    tail: str
    whole: bool


class CountTransducer:
    """Compiled on the fly: a transition is a step of the text, its label the tokens it emits. The
    compiled table is bounded."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.emits = Memo(self._compile)

    def _compile(self, steps: list[str]) -> list[int]:
        pieces = [[s.encode()] if s.isascii() and s[0] == " " and s[1:].isalpha() else [p.encode("utf-8", "replace") for p in _PIECES.findall(s)] for s in steps]
        emitted = {piece: len(ids) for piece, ids in self.merges.many(p for own in pieces for p in own).items()}
        return [sum(map(emitted.__getitem__, own)) for own in pieces]

    def run(self, text: str) -> int:
        """Tokens of a text that begins and ends at a boundary."""
        steps = _STEPS.findall(text)
        self.emits.learn(steps)
        return sum(map(self.emits.__getitem__, steps))

    def state_map(self, chunk: str) -> StateMap:
        first = _SURE.search(chunk)
        if first is None:
            return StateMap(chunk, 0, "", True)
        # From there on the steps are settled, except the last, which may go on in the next chunk.
        steps = _STEPS.findall(chunk, first.end())
        self.emits.learn(steps)
        return StateMap(chunk[: first.end()], sum(map(self.emits.__getitem__, steps[:-1])), steps[-1], False)

    def compose(self, a: StateMap, b: StateMap) -> StateMap:
        """The map of chunk `a` followed by chunk `b`; associative."""
        if a.whole:
            start = self.state_map(a.head + b.head)
            if b.whole:
                return start
            if start.whole:
                return StateMap(start.head, b.count, b.tail, False)
            return StateMap(start.head, start.count + self.run(start.tail) + b.count, b.tail, False)
        if b.whole:
            end = self.state_map(a.tail + b.head)
            if end.whole:
                return StateMap(a.head, a.count, end.head, False)
            return StateMap(a.head, a.count + self.run(end.head) + end.count, end.tail, False)
        return StateMap(a.head, a.count + self.run(a.tail + b.head) + b.count, b.tail, False)

    def scan(self, maps: list[StateMap]) -> StateMap:
        """All maps composed pairwise, level by level, as a parallel prefix scan does."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def count(self, text: str, chunk: int = _CHUNK) -> int:
        total = 0
        for k, piece in enumerate(special_pieces(text, self.merges.special)):
            if k % 2:
                total += 1
            elif len(piece) <= chunk:
                total += self.run(piece)
            else:
                end = self.scan([self.state_map(piece[i : i + chunk]) for i in range(0, len(piece), chunk)])
                total += self.run(end.head) + end.count + self.run(end.tail)
        return total

    def count_all(self, values: list[str]) -> list[int]:
        """The transitions of many texts are compiled together, then each text is run."""
        out: list[int] = []
        for start, end in blocks(values):
            # A text with special strings or of more than one chunk goes the general way.
            plain = [len(t) <= _CHUNK and not any(x in t for x in self.merges.special) for t in values[start:end]]
            steps = [_STEPS.findall(t) if p else [] for t, p in zip(values[start:end], plain)]
            self.emits.learn(step for own in steps for step in own)
            emits = self.emits.__getitem__
            out += [sum(map(emits, own)) if p else self.count(t) for t, own, p in zip(values[start:end], steps, plain)]
        return out


def transducer(path: str) -> CountTransducer:
    return held(("token counts", path), lambda: CountTransducer(path))


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row's whole text.

    `path` is a vocabulary file that every executor can read. A null or empty text has no bytes and no
    tokens; a special string inside a text is one token. Every input row gives one row, repeated ids
    too; an empty table gives an empty result.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = transducer(path)
        values = text_list(batch.column("text"))
        counts = own.count_all(values)
        columns = [
            batch.column("doc_id"),
            pa.array([len(t.encode()) for t in values], pa.int64()),
            pa.array(counts, pa.int64()),
            pa.array([n > limit for n in counts], pa.bool_()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return arrow_stage(texts(docs), work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
