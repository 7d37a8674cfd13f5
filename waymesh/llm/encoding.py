"""Token ids of whole texts with the tokenizers library.

A byte-level vocabulary never joins a character to white space that follows it, so a text
is the sequence of its chunks, each some white space and what follows up to the next; and as
letters and other characters never join, a chunk that starts with Latin letters ends after
them. Most chunks come again and again: the ids of a chunk are kept, within a bound, and the library
is asked for new ones only. Chunks of plain letters, digits and punctuation go straight to
the library's model; all others go through its whole tokenizer. Whether a vocabulary file has
the parts that this relies on is read from it once; with any other file, and for a text that
holds the string of an added token, the library encodes the whole text.

Defined cases: a null or empty text has no ids. Strings of special tokens in a text become
their ids, as the library does it, or ordinary text with ``special_as_text``. Texts are encoded
whole, whatever their length.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import regex

#: White space of Unicode; what stands between chunks.
_BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Latin letters, and what can follow a run of them without belonging to it.
_LATIN, _AFTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "\\x00-@\\[-`{-\\x7f"
_CHUNK = re.compile(f"[{_BLANK}]*[{_LATIN}]+(?=[{_AFTER}{_BLANK}]|$)|[{_BLANK}]*[^{_BLANK}]+|[{_BLANK}]+")
#: One word with a blank before it or none: the split leaves it whole.
_WORD = re.compile(f" ?[{_LATIN}]+")
_PLAIN = re.compile("[\t\n\r ]*[!-~\u00c0-\u024f]*")
#: The split that byte-level vocabularies of this kind are made with.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Chunks whose ids are kept in a generation, of which there are two, and the longest that is.
CACHED_CHUNKS, LONGEST_CACHED = 250_000, 64
#: What a vocabulary file must say for its texts to be encoded chunk by chunk.
_PRE_TOKENIZER = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
_MODEL = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "byte_fallback": False, "ignore_merges": False}


def _byte_letters() -> dict[int, int]:
    """The letter that a byte-level vocabulary writes for each byte: itself if it can be
    seen, else the next free one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: b for b in seen} | {b: 256 + k for k, b in enumerate(hidden)}


class Encoder:
    """Encodes texts to ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, vocabulary: str, special_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = special_as_text
        says = json.loads(self.tokenizer.to_str())
        has = lambda part, wanted: all((part or {}).get(k, v) == v for k, v in wanted.items())
        self.by_chunks = says["normalizer"] is None and (says["pre_tokenizer"] or {}).get("type") == "ByteLevel" and has(says["pre_tokenizer"], _PRE_TOKENIZER) and has(says["model"], _MODEL)
        self.added = [t["content"] for t in says["added_tokens"] if not (special_as_text and t["special"])]
        # one that reaches into the text around it, or is matched in changed text
        self.by_chunks &= not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in says["added_tokens"])
        self.letters = _byte_letters()
        self.model, self.blank = self.tokenizer.model.tokenize, chr(self.letters[32])
        self.ids: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _new(self, chunk: str) -> bytes:
        made = self.older.get(chunk)
        if made is None:
            if _WORD.fullmatch(chunk):
                ids = [t.id for t in self.model(chunk.replace(" ", self.blank) if chunk.isascii() else chunk.encode().decode("latin-1").translate(self.letters))]
            elif _PLAIN.fullmatch(chunk):
                model, letters = self.model, self.letters
                ids = [t.id for part in _SPLIT.findall(chunk) for t in model(part.encode().decode("latin-1").translate(letters))]
            else:
                ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
            made = array("I", ids).tobytes()
        if len(chunk) <= LONGEST_CACHED:
            if len(self.ids) >= CACHED_CHUNKS:
                self.older, self.ids = self.ids, {}
            self.ids[chunk] = made
        return made

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_chunks or any(t in text for t in self.added):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        known, new = self.ids.get, self._new  # within a text a generation that has just gone by is still asked
        return b"".join([known(c) or new(c) for c in _CHUNK.findall(text)])


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(vocabulary: str, special_as_text: bool = False) -> Encoder:
    """The encoder of this process; a worker that runs more tasks keeps it."""
    key = vocabulary, special_as_text
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]
