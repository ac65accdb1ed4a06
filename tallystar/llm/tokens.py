"""Token ids of a public tokenizer, word by word with a bounded memory of words already seen."""

from __future__ import annotations

import re
from array import array

import public_tokenizers
from tokenizers import Tokenizer

VOCABULARY = "word_bpe_49k.json"
CHUNKS = 350_000  # whitespace-separated pieces a worker remembers
WORDS = 200_000  # plain words a worker remembers

# Visible ASCII and the letters of Latin-1, which are composed, one byte pair each, and lowered one by one.
LATIN = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-ÿ]+")
# What the vocabulary's own splitting rule does to such text, once in lower case.
PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """The vocabulary writes each byte as a letter: visible Latin-1 bytes as themselves, others from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    letters = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


BYTE_LETTERS = _byte_letters()

_loaded: dict[str, "Words"] = {}


class Words:
    """Ids of a text are the ids of its whitespace-separated pieces, one after another.

    That holds since the vocabulary drops white space and never merges across it. Latin pieces go straight to
    the merges, word by word; other pieces, and those with special tokens, take the tokenizer's whole way.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.chunks: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= WORDS:
                self.words.clear()
            found = array("I", [t.id for t in self.tokenizer.model.tokenize(word.translate(BYTE_LETTERS))]).tobytes()
            self.words[word] = found
        return found

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8")
        if LATIN.fullmatch(text) and not any(s in text for s in self.special):
            found = b"".join([self._word(w) for w in PLAIN.findall(text.lower())])
        else:
            found = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if len(self.chunks) >= CHUNKS:
            self.chunks.clear()
        self.chunks[chunk] = found
        return found

    def ids(self, text: bytes) -> bytes:
        """The ids as unsigned little-endian 32-bit numbers."""
        known, miss = self.chunks.get, self._chunk
        return b"".join([known(c) or miss(c) for c in text.split()])


def words(path: str | None = None) -> Words:
    """One per worker process and vocabulary."""
    path = path or public_tokenizers.path(VOCABULARY)
    if path not in _loaded:
        _loaded[path] = Words(path)
    return _loaded[path]
