"""Whole texts to ids with a tokenizer of the tokenizers library that drops white space and lowers case.

Such a tokenizer treats each chunk between ASCII white space by itself, so a worker encodes every distinct chunk once
and remembers it (within a bound). Texts that hold one of its special tokens go to the library as a whole, which finds
them. Chunks are learned together, those of many texts at a time: where no character is beyond U+017F, normalisation
only lowers case, so one pass of the tokenizer's pattern cuts all of them, and each distinct piece goes to the library's
BPE model; any other chunk goes through the library's whole pipeline, normaliser included.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
import struct
from collections.abc import Iterable, Iterator

#: Chunks (twice as many) and pieces that a worker remembers, and chunks looked up at a time.
REMEMBERED, AT_ONCE = 300_000, 100_000
#: The last character of the range in which normalisation only lowers case, each letter to one of the range. Dotted capital I,
#: which becomes a letter and a mark, counts as beyond.
LAST = 0x17F
# The lower-case letters, the numbers and the white space up to `LAST`, the pattern of the tokenizer's
# pieces there, and the line feed that stands between chunks.
_LETTER, _NUMBER, _SPACE = "a-zªµºß-öø-ſ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
_PIECE = re.compile(f"[{_LETTER}]+|\n|'s|'t|'re|'ve|'m|'ll|'d|[{_NUMBER}]|[^{_LETTER}{_NUMBER}{_SPACE}]+")
_BEYOND = re.compile(f"[^\x00-\u012f\u0131-{chr(LAST)}]")
_CHUNK = re.compile(rb"[^\x20\x09-\x0D]+")
# Between the ids of chunks: no id below 2^24 has a byte of it in its highest place.
_BETWEEN = b"\xff\xff\xff\xff"


class WordEncoder:
    def __init__(self, described: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.whole = Tokenizer.from_str(described)
        self.special = [t.content.lower().encode() for t in self.whole.get_added_tokens_decoder().values()]
        self.model = self.whole.model
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_level = {c: "".join(t for t, _ in level.pre_tokenize_str(chr(c))) for c in range(LAST + 1)}
        self.pieces: dict[str, bytes] = {"\n": _BETWEEN}
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}  # what was known before; chunks that are met again come back

    def _cut(self, chunks: list[bytes], text: str) -> None:
        """Learns chunks without a character beyond `LAST`; `text` is all of them, a line feed between two."""
        cut = _PIECE.findall(text.lower())
        new = set(cut).difference(self.pieces)
        if len(self.pieces) + len(new) > REMEMBERED:
            self.pieces = {"\n": _BETWEEN}
            new = set(cut).difference(self.pieces)
        tokenize, byte_level = self.model.tokenize, self.byte_level
        for piece in new:
            self.pieces[piece] = _packed([t.id for t in tokenize(piece.translate(byte_level))])
        ids = b"".join(map(self.pieces.__getitem__, cut)).split(_BETWEEN)
        self.known.update(zip(chunks, ids, strict=True))

    def _learn(self, new: set[bytes]) -> None:
        if len(self.known) + len(new) > REMEMBERED:
            self.known, self.older = {}, self.known
        again = new & self.older.keys()
        self.known.update((chunk, self.older[chunk]) for chunk in again)
        plain = list(new - again)
        text = b"\n".join(plain).decode("utf-8", "replace")
        if _BEYOND.search(text):
            texts = dict(zip(plain, text.split("\n"), strict=True))
            rest = [chunk for chunk in plain if _BEYOND.search(texts[chunk])]
            encoded = self.whole.encode_batch_fast([texts[chunk] for chunk in rest], add_special_tokens=False)
            self.known.update((chunk, _packed(e.ids)) for chunk, e in zip(rest, encoded, strict=True))
            plain = [chunk for chunk in plain if chunk not in self.known]
            text = "\n".join(texts[chunk] for chunk in plain)
        if plain:
            self._cut(plain, text)

    def _looked_up(self, texts: list[list[bytes]]) -> list[bytes]:
        """The ids of each text, given as its chunks."""
        found = [list(map(self.known.get, chunks)) for chunks in texts]
        missing = [[k for k, ids in enumerate(each) if ids is None] for each in found]
        new = {chunks[k] for chunks, places in zip(texts, missing, strict=True) for k in places}
        if new:
            self._learn(new)
        for chunks, each, places in zip(texts, found, missing, strict=True):
            for k in places:
                each[k] = self.known[chunks[k]]
        return [b"".join(each) for each in found]

    def _by_itself(self, text: str, raw: bytes) -> bytes:
        if self._has_special(raw):
            return _packed(self.whole.encode(text, add_special_tokens=False).ids)
        found = (m.group() for m in _CHUNK.finditer(_lowered(text, raw)))
        return b"".join(self._looked_up([part])[0] for part in iter(lambda: list(itertools.islice(found, AT_ONCE)), []))

    def _has_special(self, raw: bytes) -> bool:
        low = raw.lower()
        return any(s in low for s in self.special)

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each whole text as little-endian unsigned 32-bit integers. Texts of about `AT_ONCE` chunks are looked up
        together; one that is longer, or holds a special token, goes by itself."""
        waiting: list[list[bytes]] = []
        size = 0
        for text in texts:
            raw = text.encode("utf-8", "surrogatepass")
            alone = len(raw) > 8 * AT_ONCE or self._has_special(raw)
            if alone or size + len(raw) > 8 * AT_ONCE:
                yield from self._looked_up(waiting)
                waiting, size = [], 0
            if alone:
                yield self._by_itself(text, raw)
            else:
                waiting.append(_lowered(text, raw).split())
                size += len(raw)
        yield from self._looked_up(waiting)


def _lowered(text: str, raw: bytes) -> bytes:
    """Fewer distinct chunks. Beyond `LAST` are marks, which compose with one case only at times: there the library lowers."""
    if raw.isascii():
        return raw.lower()
    return raw if _BEYOND.search(text) else text.lower().encode()


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_ENCODERS: dict[bytes, WordEncoder] = {}


def encoder(described: str) -> WordEncoder:
    """The worker's encoder; workers outlive tasks."""
    key = hashlib.sha256(described.encode()).digest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(described)
    return _ENCODERS[key]


def encoded(texts: Iterator[str | None], described: str) -> Iterator[bytes]:
    """The ids of each text, in order."""
    return encoder(described).encode(text or "" for text in texts)
