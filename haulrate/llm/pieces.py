"""Exact encoding and decoding with a merge-type (BPE) piece vocabulary, by backtracking.

A text is a sequence of pieces in which every adjacent pair is compatible: merging the characters
of the two pieces anew, best score first, gives the same two pieces. The encoder walks from left to
right, takes the longest piece that an Aho-Corasick automaton finds at a position, falls back to
shorter ones when a pair is not compatible, and gives up a position (a bit in a field) from which
no piece leads on. Characters without a piece become their UTF-8 bytes.

No piece of the vocabulary has a space mark after another character, nor a character that only
stands alone, so a text is cut there into units that are encoded on their own; what a unit encodes
to is remembered up to a fixed number of units, by a Python worker for its later tasks too. A
vocabulary without such cuts is encoded whole.

Defined cases: a null text is empty; an empty text has no ids and decodes to nothing. Very long
texts and units are encoded whole. Repeated rows give equal results; other columns are not read;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass

import ahocorasick
import sentencepiece
from pyspark.sql import DataFrame

from haulrate.llm.common import filled, map_texts, once_per_process

SPACE = "▁"
REMEMBERED_UNITS = 200_000
REMEMBERED_PAIRS = 400_000
LONGEST_REMEMBERED = 48
_PROBES = ("a b", "  a  b ", "\ta\n\nb c", "", " ", "x" * 40, f"{SPACE}q {SPACE}", "é é")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id; ``rank`` orders merges (lower first) and holds only pieces of text."""

    pieces: list[str]
    rank: dict[str, int]
    bytes: dict[int, int]
    silent: frozenset[int]

    @property
    def ids(self) -> dict[str, int]:
        return {piece: k for k, piece in enumerate(self.pieces) if piece in self.rank}


def read_vocabulary(path: str) -> Vocabulary:
    """Reads a model file, and makes sure that it normalises texts as this encoder does."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(k) for k in range(model.get_piece_size())]
    as_bytes = {k: int(p[1:-1], 16) for k, p in enumerate(pieces) if model.is_byte(k)}
    silent = frozenset(k for k in range(len(pieces)) if model.is_control(k))
    plain = [
        k
        for k in range(len(pieces))
        if k not in as_bytes and k not in silent and not model.is_unknown(k)
    ]
    plain.sort(key=lambda k: (-model.get_score(k), k))
    vocabulary = Vocabulary(pieces, {pieces[k]: n for n, k in enumerate(plain)}, as_bytes, silent)
    encode, decode = codec(vocabulary)
    for probe in _PROBES:
        if (ids := model.encode(probe)) != encode(probe) or model.decode(ids) != decode(ids):
            raise ValueError(f"{path} does not encode {probe!r} as a plain merge-type vocabulary")
    return vocabulary


def merged(text: str, rank: dict[str, int]) -> list[str]:
    """The characters after all merges: the best-ranked adjacent pair first, leftmost of equals."""
    parts = list(text)
    while len(parts) > 1:
        best, at = None, -1
        for k in range(len(parts) - 1):
            r = rank.get(parts[k] + parts[k + 1])
            if r is not None and (best is None or r < best):
                best, at = r, k
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def reachable(rank: dict[str, int]) -> list[str]:
    """The pieces that merging their own characters gives."""
    return [piece for piece in rank if merged(piece, rank) == [piece]]


class Encoder:
    """Backtracking over one vocabulary; remembers pairs up to a fixed number."""

    def __init__(self, rank: dict[str, int], usable: list[str]):
        self._rank = rank
        self._usable = set(usable)
        self._pairs: dict[tuple[str, str], bool] = {}
        self._automaton = ahocorasick.Automaton()
        for piece in usable:
            self._automaton.add_word(piece, len(piece))
        self._automaton.make_automaton()

    def compatible(self, pair: tuple[str, str]) -> bool:
        if len(self._pairs) >= REMEMBERED_PAIRS:
            self._pairs.clear()
        known = self._pairs[pair] = merged(pair[0] + pair[1], self._rank) == list(pair)
        return known

    def encode(self, text: str) -> list[str]:
        """The pieces of a text; a character without a piece stands for itself."""
        size = len(text)
        if size == 1 or text in self._usable:
            return [text]
        longest = [1] * size
        for end, length in self._automaton.iter(text):
            if length > longest[end + 1 - length]:
                longest[end + 1 - length] = length
        usable, pair_known = self._usable, self._pairs.get
        failed = 0  # a bit for each position from which no piece leads on
        taken: list[str] = []
        at, length = 0, longest[0]
        while True:
            last = taken[-1] if taken else None
            while length:
                piece = text[at : at + length]
                if (length == 1 or piece in usable) and not (failed and failed >> at + length & 1):
                    if last is None:
                        break
                    fits = pair_known((last, piece))
                    if fits or fits is None and self.compatible((last, piece)):
                        break
                length -= 1
            if length:
                taken.append(piece)
                at += length
                if at == size:
                    return taken
                length = longest[at]
            else:
                failed |= 1 << at
                length = len(taken.pop())
                at -= length


def codec(vocabulary: Vocabulary, usable: list[str] | None = None) -> tuple[Callable, Callable]:
    """``encode(text) -> ids`` and ``decode(ids) -> text`` of a vocabulary."""
    by_unit = unit_codec(vocabulary, usable or reachable(vocabulary.rank))

    def encode(text: str) -> list[int]:
        joined = ",".join(ids for ids, _ in by_unit(text))
        return [int(k) for k in joined.split(",")] if joined else []

    return encode, lambda ids: decoded(vocabulary, ids, first=True)


def decoded(vocabulary: Vocabulary, ids: list[int], first: bool) -> str:
    """The text of ids: bytes joined to characters, space marks as spaces.

    ``first``: the ids start the text, so the space mark that encoding put there goes.
    """
    parts, run = [], bytearray()
    for k in ids:
        if (byte := vocabulary.bytes.get(k)) is not None:
            run.append(byte)
            continue
        if run:
            parts.append(_utf8(run))
            run = bytearray()
        if k not in vocabulary.silent:
            piece = vocabulary.pieces[k] if vocabulary.pieces[k] in vocabulary.rank else " ⁇ "
            if first and not parts:
                piece = piece.removeprefix(SPACE)
                first = False
            parts.append(piece)
    if run:
        parts.append(_utf8(run))
    return "".join(parts).replace(SPACE, " ")


def _utf8(run: bytearray) -> str:
    """Valid characters; every other byte as one replacement character."""
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(bytes(run[at : at + size]).decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def unit_pattern(rank: dict[str, int]) -> re.Pattern:
    """Cuts a marked text into units that no merge crosses.

    ``breaking`` characters (most punctuation) follow a letter or digit in no piece, so there is
    a cut between the two; what follows a breaking character may join it.
    """
    long = [piece for piece in rank if len(piece) > 1]
    if any(SPACE in piece.lstrip(SPACE) for piece in long):
        return re.compile(r"(?s).+")
    joining = {c for piece in long for c in piece} - {SPACE}
    after_alnum = {b for piece in long for a, b in zip(piece, piece[1:]) if a.isalnum()}
    alnum = {c for c in joining if c.isalnum()}
    breaking = joining - alnum - after_alnum
    if not alnum or not breaking:
        return re.compile(f"(?s){SPACE}*{_one_of(joining)}+|{SPACE}+|.")
    inner, outer = _one_of(joining - breaking), _one_of(joining - alnum)
    more = f"(?:(?<!{_one_of(alnum)}){_one_of(breaking)}+{inner}*)*"
    return re.compile(f"(?s){SPACE}*(?={_one_of(joining)}){outer}*{inner}*{more}|{SPACE}+|.")


def _one_of(characters: set[str]) -> str:
    return f"[{''.join(map(re.escape, sorted(characters)))}]"


def unit_codec(vocabulary: Vocabulary, usable: list[str]) -> Callable:
    """A function that gives for each unit of a text its ids as text, and what they decode to."""
    encoder, ids_of = Encoder(vocabulary.rank, usable), vocabulary.ids
    find = unit_pattern(vocabulary.rank).findall
    byte_ids = {byte: k for k, byte in vocabulary.bytes.items()}
    as_text = {piece: str(k) for piece, k in ids_of.items()}.get

    def convert(unit: str) -> tuple[str, str]:
        pieces = encoder.encode(unit)
        texts = [as_text(piece) for piece in pieces]
        if None not in texts:
            return ",".join(texts), "".join(pieces).replace(SPACE, " ")
        ids = []
        for piece in pieces:
            known = ids_of.get(piece)
            ids += [known] if known is not None else [byte_ids[b] for b in piece.encode()]
        return ",".join(map(str, ids)), decoded(vocabulary, ids, first=False)

    older: dict[str, tuple[str, str]] = {}

    class Remembered(dict):
        """Two generations: when the younger is full it replaces the older one."""

        def __missing__(self, unit):
            made = older.get(unit) or convert(unit)
            if len(unit) <= LONGEST_REMEMBERED:
                if len(self) >= REMEMBERED_UNITS:
                    older.clear()
                    older.update(self)
                    self.clear()
                self[unit] = made
            return made

    look_up = Remembered().__getitem__

    def units(text: str) -> list[tuple[str, str]]:
        if not text:
            return []
        return [look_up(unit) for unit in find(SPACE + text.replace(" ", SPACE))]

    return units


def kept_codec(vocabulary: Vocabulary, usable: list[str]) -> Callable:
    """The ``unit_codec`` that a Python worker keeps for its later tasks, with what it remembers."""
    named = repr((vocabulary.pieces, vocabulary.rank, vocabulary.bytes, sorted(vocabulary.silent)))
    key = hashlib.sha256(named.encode()).hexdigest()
    return once_per_process(("pieces", key), lambda: unit_codec(vocabulary, usable))


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """Per row: the number of ids, the digest of the ids, and the digest of their text."""
    vocabulary = read_vocabulary(model_path)
    usable = reachable(vocabulary.rank)

    def make():
        by_unit = kept_codec(vocabulary, usable)

        def step(texts):
            out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for text in texts:
                units = by_unit(text)
                back = "".join([unit[1] for unit in units])
                ids = ",".join([unit[0] for unit in units])
                out["n_tokens"].append(ids.count(",") + 1 if ids else 0)
                out["ids_sha256"].append(hashlib.sha256(ids.encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(back[1:].encode()).hexdigest())
            return out

        return step

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_texts(filled(docs), make, schema)


def encoded(docs: DataFrame, model_path: str) -> DataFrame:
    """Per row of ``docs`` its ids as an array."""
    vocabulary = read_vocabulary(model_path)
    usable = reachable(vocabulary.rank)

    def make():
        encode, _ = codec(vocabulary, usable)
        return lambda texts: {"ids": [encode(text) for text in texts]}

    return map_texts(filled(docs), make, "ids array<int>")
