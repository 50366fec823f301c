"""BPE encoding as a bounded-lookahead transducer, and decoding by a byte-to-text state machine."""

from __future__ import annotations

import codecs
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import arrow_stage, held, text_list, texts
from .tokenizer import SPACE, Memo, Merges, blocks, byte_letters, special_pieces

#: How the vocabulary's makers cut lower-cased text into words; fixed value.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + SPACE + r"\p{L}\p{N}]+")
_CHUNKS = re.compile(f"[^{SPACE}]+")
_BLOCK = 1 << 14


def _words(chunk: str) -> list[bytes]:
    if chunk.isascii():
        lowered = chunk.lower()
        if lowered.isalpha():
            return [lowered.encode()]
    else:
        # Letters are lowered one by one: the final sigma of a word is no special case.
        lowered = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
    return [word.encode("utf-8", "replace") for word in _WORDS.findall(lowered)]


class Encoder:
    """Text to ids. No word holds white space, so the runs between it are encoded one by one; short
    ones are remembered, long ones stream through the merge transducer."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.memo = Memo(self._chunks)

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        words = [_words(chunk) for chunk in chunks]
        ids = {word: found.tobytes() for word, found in self.merges.many(w for own in words for w in own).items()}
        return [ids[own[0]] if len(own) == 1 else b"".join(map(ids.__getitem__, own)) for own in words]

    def encode_all(self, values: list[str]) -> list[np.ndarray]:
        special, out = self.merges.special, []
        for start, end in blocks(values):
            cut = [special_pieces(text, special) for text in values[start:end]]
            runs = [[_CHUNKS.findall(piece) if k % 2 == 0 else piece for k, piece in enumerate(pieces)] for pieces in cut]
            self.memo.learn(run for own in runs for k, found in enumerate(own) if k % 2 == 0 for run in found)
            for own in runs:
                parts = [b"".join(map(self.memo.__getitem__, found)) if k % 2 == 0 else np.int32(special[found]).tobytes() for k, found in enumerate(own)]
                out.append(np.frombuffer(b"".join(parts), np.int32))
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


class Decoder:
    """Ids to text. A vocabulary with a byte decoder gives bytes, which leave as text as soon as they
    are whole characters; without one the token names are joined by spaces."""

    def __init__(self, own: Merges):
        self.joined = own.decoder is None
        if self.joined:
            pieces = {i: name.encode() for i, name in own.names.items()}
        else:
            byte_of = {letter: b for b, letter in enumerate(byte_letters())}
            pieces = {i: bytes(byte_of[x] for x in name) if i not in own.special.values() else name.encode() for i, name in own.names.items()}
        self.pieces = [pieces.get(i, b"") for i in range(max(pieces) + 1)]

    def text(self, ids: Iterable[int]) -> Iterator[str]:
        state = codecs.getincrementaldecoder("utf-8")("replace")
        gap = b" " if self.joined else b""
        ids = np.asarray(ids, np.int32)
        for at in range(0, len(ids), _BLOCK):
            block = gap.join(map(self.pieces.__getitem__, ids[at : at + _BLOCK].tolist()))
            yield state.decode(gap + block if at else block)
        yield state.decode(b"", True)

    def decode(self, ids: Iterable[int]) -> str:
        return "".join(self.text(ids))


def coder(path: str) -> tuple[Encoder, Decoder]:
    """Both directions over one vocabulary, loaded once in a worker."""

    def build() -> tuple[Encoder, Decoder]:
        encoder = Encoder(path)
        return encoder, Decoder(encoder.merges)

    return held(("bpe", path), build)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.empty(0, np.int32)))


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int), decoded: each whole text encoded and its ids decoded again.

    `path` is a vocabulary file that every executor can read. A null or empty text has no ids and an
    empty decoded text; special strings inside a text become their ids. Every input row gives one
    row, repeated ids too; an empty table gives an empty result.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc, dec = coder(path)
        ids = enc.encode_all(text_list(batch.column("text")))
        decoded = pa.array([dec.decode(x) for x in ids], pa.string())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(ids), decoded], ["doc_id", "ids", "decoded"])

    return arrow_stage(texts(docs), work, "doc_id long, ids array<int>, decoded string")
