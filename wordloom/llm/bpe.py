"""Token ids of whole texts, from a vocabulary file of the ``tokenizers`` library.

The byte-level pre-tokenizer never joins characters across a lone space or line break that
stands between two other characters, so a text is the concatenation of its space-separated
words and each word can be encoded by itself. A bounded memo keeps the ids of words that
were seen. A text with any other white space (runs, tabs, leading or trailing blanks, ...)
is encoded by the library in one call, and so is one with the string of an added token, which
the library takes out before it splits the rest. Ids are kept as little-endian 32-bit bytes.

Of a word that is not in the memo, a Latin stem goes straight to the library's BPE model and a
tail of ASCII punctuation has a memo of its own: the pre-tokenizer would part them in the same
way. Any other word takes the library's whole path.
"""

from __future__ import annotations

import os
import string
import struct

MEMO_WORDS = 500_000
TAIL = string.punctuation.replace("'", "")
LAST_LATIN = "\u024f"
PACKED = [struct.Struct(f"<{n}I").pack for n in range(33)]
_encoders: dict[tuple[str, int], "WordEncoder"] = {}


def vocabulary_path(path: str | None) -> str:
    """``path``, or the public 50k byte-level vocabulary where none is given."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return path


def encoder(path: str | None = None, memo: int = MEMO_WORDS) -> "WordEncoder":
    """This Python worker's encoder for a vocabulary; its memo lives as long as the worker."""
    key = (vocabulary_path(path), memo)
    if key not in _encoders:
        _encoders[key] = WordEncoder(*key)
    return _encoders[key]


class _Irregular(Exception):
    """White space other than lone spaces and line breaks between words."""


class WordEncoder:
    def __init__(self, path: str, memo: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The parts alone, as reading the whole file as JSON would hold it in memory twice.
        splitter = json.loads(self.tokenizer.pre_tokenizer.__getstate__()) if self.tokenizer.pre_tokenizer else {}
        if self.tokenizer.normalizer or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") or not splitter.get("use_regex", True):
            raise ValueError("the vocabulary must be byte-level, without a normalizer or an added first space")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.memo = memo
        self.first: dict[str, bytes] = {}  # words at the start of a line
        self.inner: dict[str, bytes] = {}  # words after a space
        self.tails: dict[str, bytes] = {}
        self.newline = self.whole("\n")
        self.model = self.tokenizer.model.tokenize
        # Byte-level models write bytes without a printable Latin-1 character from U+0100 on.
        printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        self.letters = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in printable)}
        self.blank = chr(self.letters[0x20])

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _miss(self, word: str, known: dict[str, bytes], before: str) -> bytes:
        stem = word.rstrip(TAIL)
        if stem.isascii() and stem.isalpha():
            ids = known.get(stem)
            if ids is None:
                # ASCII letters stand for themselves, a blank for its own letter.
                ids = self._packed([t.id for t in self.model(self.blank + stem if before else stem)])
        elif stem.isalpha() and max(stem) <= LAST_LATIN:
            ids = known.get(stem) or self._stem(before + stem)
        elif word.split() != [word]:
            raise _Irregular
        else:
            ids, stem = self.whole(before + word), word
        if len(stem) < len(word):
            if len(known) < self.memo:
                known[stem] = ids
            tail = word[len(stem) :]
            ids += self.tails.get(tail) or self._tail(tail)
        if len(known) < self.memo:
            known[word] = ids
        return ids

    def _stem(self, stem: str) -> bytes:
        return self._packed([t.id for t in self.model(stem.encode().decode("latin-1").translate(self.letters))])

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return PACKED[len(ids)](*ids) if len(ids) < len(PACKED) else struct.pack(f"<{len(ids)}I", *ids)

    def _tail(self, tail: str) -> bytes:
        ids = self.whole(tail)
        if len(self.tails) < self.memo:
            self.tails[tail] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; none for null or empty."""
        if not text:
            return b""
        for token in self.added:
            if token in text:
                return self.whole(text)
        first, inner, miss = self.first, self.inner, self._miss
        at_start, after_space = first.get, inner.get
        out: list[bytes] = []
        try:
            for line in text.split("\n"):
                words = line.split(" ")
                head = words[0]
                out.append(self.newline)
                out.append(at_start(head) or miss(head, first, ""))
                del words[0]
                out += [after_space(w) or miss(w, inner, " ") for w in words]
        except _Irregular:
            return self.whole(text)
        return b"".join(out[1:])
