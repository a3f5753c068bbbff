"""Ids of a tokenizer file that drops white space, as bytes, remembered by words.

What such a tokenizer makes of a text is what it makes of its words, one after the other. A text of
ASCII and plain letters is lowered and cut into words here; each new word goes to the library's
merges and is remembered, up to a fixed number. Of any other text the stretches between white space
that are not plain go to the tokenizer itself; one with white space beyond ASCII's, or with the name
of a special token, goes there in blocks or whole. So each id is one the library gave.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator

from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from haulrate.llm.common import once_per_process

#: Letters that, beside ASCII, Python and the library lower and class alike; checked when loaded.
PLAIN = "À-ÖØ-öø-ÿ"
_LOWER = "a-zß-öø-ÿ"
#: How the tokenizer cuts a lowered plain text into words.
WORDS = re.compile(rf"[{_LOWER}]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^\s0-9{_LOWER}]+")
#: White space to Python that the library may read otherwise.
ODD_SPACE = r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
SPACE = re.compile(r"[ \t\n\r\x0b\x0c]")
ID_BYTES = 4
REMEMBERED = 400_000
LONGEST = 64
#: Texts are cut into words in blocks of about so many characters.
BLOCK = 1 << 20


def read_tokenizer(path: str) -> Tokenizer:
    """The tokenizer, if it drops white space and cuts plain characters as assumed here."""
    tokenizer = Tokenizer.from_file(path)
    encode = id_codec(tokenizer)
    signs = [c for c in map(chr, range(1, 0x100)) if _is_plain(c)]
    for probe in [*(f"a{c}1{c}{c}B{c}'LL _{c}" for c in signs), "A  b\n\tc\x0b\x0cd ", ""]:
        ids = tokenizer.encode(probe, add_special_tokens=False).ids
        if encode(probe) != _packed(ids):
            raise ValueError(f"{path} does not cut {probe!r} into words as assumed")
    return tokenizer


def word_codec(path: str) -> Callable[[str], bytes]:
    """``id_codec`` of a file, with what it remembers kept for a worker's later tasks."""
    return once_per_process(("word ids", path), lambda: id_codec(read_tokenizer(path)))


_is_plain = re.compile(rf"[\0-\x1b\x20-\x7f{PLAIN}]*").fullmatch


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Remembered(dict):
    """Two generations of what was made: when the younger is full it replaces the older one."""

    def __init__(self, make: Callable[[str], bytes]):
        self._make, self._older = make, {}

    def __missing__(self, key: str) -> bytes:
        made = self._older.get(key)
        if made is None:
            made = self._make(key)
        if len(key) <= LONGEST:
            if len(self) >= REMEMBERED:
                self._older = dict(self)
                self.clear()
            self[key] = made
        return made


def id_codec(tokenizer: Tokenizer) -> Callable[[str], bytes]:
    """A function from a text to its ids, ``ID_BYTES`` little-endian bytes each."""
    model = tokenizer.model
    level = ByteLevel(add_prefix_space=False, use_regex=False)
    known = [c for c in map(chr, range(0x100)) if _is_plain(c) and c != " "]
    as_bytes = {ord(c): level.pre_tokenize_str(c)[0][0] for c in known}
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    odd_space = re.compile(ODD_SPACE).search
    packed = [_packed([k]) for k in range(tokenizer.get_vocab_size())]

    def of_word(word: str) -> bytes:
        tokens = model.tokenize(word.translate(as_bytes))
        return b"".join([packed[token.id] for token in tokens])

    def of_library(text: str) -> bytes:
        return _packed(tokenizer.encode(text, add_special_tokens=False).ids)

    cut, of = WORDS.findall, _Remembered(of_word).__getitem__

    def of_plain(block: str) -> bytes:
        return b"".join(map(of, cut(block.lower())))

    def of_any(block: str) -> bytes:
        if odd_space(block):
            return of_library(block)
        return b"".join([(of_plain if _is_plain(s) else of_library)(s) for s in block.split()])

    def encode(text: str) -> bytes:
        for mark in special:
            if mark in text:
                return of_library(text)
        of_block = of_plain if _is_plain(text) else of_any
        return of_block(text) if len(text) <= BLOCK else b"".join(map(of_block, _blocks(text)))

    return encode


def _blocks(text: str) -> Iterator[str]:
    """The text in blocks that end before white space."""
    start = 0
    while start < len(text):
        end = SPACE.search(text, start + BLOCK)
        stop = end.start() if end else len(text)
        yield text[start:stop]
        start = stop
