"""Token ids of the public word-BPE vocabulary, at corpus speed.

The vocabulary is a ``tokenizers`` JSON file with a byte-level BPE whose words
end in ``</w>`` (lower-cased, white space dropped). Two facts make encoding
whole corpora cheap without changing a single id:

* A pre-token never crosses ASCII white space, so the ids of a text are the
  ids of its white-space chunks in a row, and each distinct chunk is encoded
  once per worker (bounded caches of chunks and of their words).
* For chunks of printable ASCII and Latin letters, the file's own normaliser
  and split pattern are applied directly, and the merges run as ranked byte
  pairs (``tiktoken``'s core, the word end written as byte 0xFF). Every other
  chunk goes through ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import re
from array import array

import public_tokenizers
import regex
import tiktoken
import tokenizers

WORD_BPE = "word_bpe_49k.json"
EOS = 1                      # the id appended to every document (part of the query's contract)
CACHE_CHUNKS = 600_000       # distinct chunks kept per worker before the cache starts anew

# Fixed value: the split pattern in the vocabulary file.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# chunks whose normal form and pieces do not depend on a library's Unicode
# tables: printable ASCII, and U+00A1..U+024F as UTF-8
# lower-case ASCII and Latin-1 letters, then ASCII signs other than the apostrophe
_WORD_AND_STOPS = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])*)([!-&(-/:-@[-`{-~]*)")
_LATIN = re.compile(rb"(?:[!-~]|\xc2[\xa1-\xbf]|[\xc3-\xc8][\x80-\xbf]|\xc9[\x80-\x8f])+")

_encoders: dict[str, "WordBpe"] = {}


def encoder(path: str | None = None) -> "WordBpe":
    """The worker's encoder for a vocabulary file (by default the installed
    ``word_bpe_49k.json``)."""
    path = path or public_tokenizers.path(WORD_BPE)
    if path not in _encoders:
        _encoders[path] = WordBpe(path)
    return _encoders[path]


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the code points from 256 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordBpe:
    def __init__(self, path: str):
        self.plain = tokenizers.Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        char = _byte_of_char()
        ranks = {}
        for token, i in spec["model"]["vocab"].items():
            if token not in special:
                end = token.endswith("</w>")
                body = token[:-4] if end else token
                ranks[bytes(char[c] for c in body) + b"\xff" * end] = i
        ranks.setdefault(b"\xff", max(ranks.values()) + len(special) + 1)   # the word end alone: never produced
        core = tiktoken.Encoding("word", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
        self._merge = core._core_bpe.encode_single_piece
        self._cache: dict[bytes, bytes] = {}
        self._pieces: dict[bytes, bytes] = {}

    def _piece(self, piece: bytes) -> bytes:
        ids = self._pieces.get(piece)
        if ids is None:
            if len(self._pieces) >= CACHE_CHUNKS:
                self._pieces.clear()
            ids = array("H", self._merge(piece + b"\xff")).tobytes()
            if len(piece) <= 64:
                self._pieces[piece] = ids
        return ids

    def _chunk(self, chunk: bytes) -> bytes:
        m = _WORD_AND_STOPS.fullmatch(chunk)
        if m:                                            # a word and what follows it, by far the most chunks
            word, stops = m.groups()
            return (word and self._piece(word)) + (stops and self._piece(stops))
        if _LATIN.fullmatch(chunk):
            return b"".join([self._piece(p.encode()) for p in _PIECES.findall(chunk.decode().lower())])
        ids = self.plain.encode(chunk.decode(errors="replace"), add_special_tokens=False).ids
        return array("H", ids).tobytes()

    def encode(self, raw: bytes | None) -> bytes:
        """The ids of a text (UTF-8 bytes) as little-endian 16-bit numbers."""
        if not raw:
            return b""
        cache, chunks = self._cache, raw.lower().split()     # bytes: A-Z only, white space of ASCII only
        ids = [cache.get(c) for c in chunks]
        if None in ids:
            for i, c in enumerate(chunks):
                if ids[i] is None:
                    ids[i] = cache.get(c)
                if ids[i] is None:
                    if len(cache) >= CACHE_CHUNKS:
                        cache.clear()
                    ids[i] = self._chunk(c)
                    if len(c) <= 64:
                        cache[c] = ids[i]
        return b"".join(ids)
