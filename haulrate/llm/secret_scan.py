"""Secret scan: fixed patterns, and a lexer that pairs names with the literals assigned to them.

Base spans are the non-overlapping matches of three patterns. Beside them the text is read as
source or configuration: around each assignment sign stand a target name and a right side of
literals and names joined by ``+``. A name on the right side stands for the literal that the text
assigns to it (constants propagate, through other names too, each assignment of a name), so a key
that is defined under a harmless name and used as a password is found where it is written. What
``+`` joins is scored as a whole as well, and its pieces are reported. An unquoted right side that ends
its line or element and that the text assigns nothing to, as in .env, INI, properties and YAML
files, is a literal too, unless it is lower-case words alone. A literal's score is the weight of its most sensitive target name times
how far its characters vary; placeholders score nothing.

Defined cases: a null text is empty and has no spans. A method span that a base span covers wholly
is left out, as is a second one of the same place; one that reaches beyond the base span stays.
Repeated rows give equal results; other columns are not read; an empty table gives an empty result.
Texts are read whole, whatever their length, in time that goes with it.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulrate.llm.common import filled, fresh, map_texts

# The base patterns, in the order of their kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "literal")

# How strongly a part of a target name says that its value is secret.
SENSITIVE = {
    "password": 1.0,
    "passwd": 1.0,
    "passphrase": 1.0,
    "pwd": 1.0,
    "pass": 0.8,
    "secret": 1.0,
    "token": 1.0,
    "apikey": 1.0,
    "credential": 0.9,
    "credentials": 0.9,
    "bearer": 0.9,
    "auth": 0.7,
    "key": 0.7,
    "salt": 0.6,
    "signature": 0.6,
}
#: Words before "key" that make it one of a table, a cache or everyone.
HARMLESS_KEYS = frozenset(
    "primary foreign sort public partition unique index row cache lookup composite natural".split()
)
LEAST_SCORE = 0.5
LEAST_LITERAL = 6
ENOUGH_ENTROPY = 3.0
PLACEHOLDERS = re.compile(
    r"(?i)(?:x+|\*+|\.+|-+|none|null|true|false|undefined|changeme|example|placeholder|todo"
    r"|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*\)s)$|your[_-]"
)

_HINTS = ("pass", "pwd", "secret", "token", "key", "cred", "auth", "bearer", "salt", "signat")
_SIGN = re.compile(r":=|=>|[:=]")
_NAME_CHARS = string.ascii_letters + string.digits + "_$.-"
_TARGET_CHARS = 96
_TERM = re.compile(
    r"""[ \t]*(?:[rbuf]{0,2}"((?:[^"\\\n]++|\\.)*+)"|[rbuf]{0,2}'((?:[^'\\\n]++|\\.)*+)'"""
    r"""|`([^`\n]*+)`|([A-Za-z_$][A-Za-z0-9_$.]*)(?![A-Za-z0-9+/_=\-])"""
    r"""|([A-Za-z0-9+/_.=\-]))"""
)
#: An unquoted value that reads as a name: lower-case words alone.
_NAME = re.compile(r"[a-z]+(?:[_.][a-z]+)*")
_RUN = re.compile(r"[A-Za-z0-9+/_.=\-]*")
#: What may stand in an unquoted value beside the characters of _RUN, and what ends it.
_REST = re.compile(r"""[^\s"'`<>,;&{}()\[\]]*""")
_VALUE_END = re.compile(r"""[ \t]*(?:[\r\n,;&}\]<]|\Z|[ \t](?:\#|//|[A-Za-z_][\w.\-]*[=:]))""")
#: As much of either end of a value as tells a placeholder.
_ENDS = 16
#: Lengths of joined values beyond so many bits count as that, their characters by their shares.
_MOST_BITS = 256
_PLUS = re.compile(r"[ \t]*\+[ \t]*(?=[\"'`A-Za-z_$])")
_ELEMENT = re.compile(r"<([A-Za-z_][\w.\-]*)>[ \t]*([^<>\s]++)[ \t]*</\1>")
_NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the fixed patterns."""
    lowered = text.lower()
    found = []
    if any(hint in lowered for hint in ("passw", "secret", "token", "api")):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST_ASSIGNED:
                found.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST_ACCESS:
                found.append((m.start(), 1, m.end()))
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def name_weight(name: str) -> float:
    parts = [part.lower() for part in _NAME_PARTS.findall(name)]
    parts = [
        part
        for before, part in zip(["", *parts], parts)
        if not (part == "key" and before in HARMLESS_KEYS)
    ]
    parts += [a + b for a, b in zip(parts, parts[1:])]
    return max((SENSITIVE.get(part, 0.0) for part in parts), default=0.0)


def literal_score(literal: str, weight: float) -> float:
    """The name's weight, less for literals of few different characters."""
    if len(literal) < LEAST_LITERAL or PLACEHOLDERS.match(literal):
        return 0.0
    return weight * min(1.0, entropy(Counter(literal), len(literal)) / ENOUGH_ENTROPY)


def entropy(counts: Counter, total: int) -> float:
    """Bits a character; whole numbers of any size, so logarithms are taken before the quotient."""
    whole = math.log2(total)
    return sum(n / total * (whole - math.log2(n)) for n in counts.values())


def scored_spans(text: str, weights: dict[tuple[int, int], float]) -> list[tuple[int, int]]:
    """The spans whose literal scores enough; those with one end are counted in one pass."""
    found, counts, counted, last = [], Counter(), 0, -1
    for start, end in sorted(weights, key=lambda span: (span[1], -span[0])):
        if end != last:
            counts, counted, last = Counter(), end, end
        counts.update(text[start:counted])
        counted = start
        if end - start < LEAST_LITERAL or PLACEHOLDERS.match(text, start, end):
            continue
        enough = min(1.0, entropy(counts, end - start) / ENOUGH_ENTROPY)
        if weights[start, end] * enough >= LEAST_SCORE:
            found.append((start, end))
    return sorted(found)


@dataclass(frozen=True)
class Name:
    """A name on a right side, and its own span where it would be a literal if nothing defines it."""

    text: str
    span: tuple[int, int] | None = None


class Unquoted:
    """Where unquoted values of a text end; a run that several signs share is read once."""

    def __init__(self, text: str):
        self._text = text
        self._runs = {_RUN: (0, 0), _REST: (0, 0)}
        self._checked = (-1, False)

    def _end(self, run: re.Pattern, at: int) -> int:
        start, end = self._runs[run]
        if not start <= at < end:
            end = run.match(self._text, at).end()
            self._runs[run] = (at, end)
        return end

    def run(self, start: int) -> tuple[int, int]:
        return start, self._end(_RUN, start)

    def value(self, start: int) -> tuple[int, int] | None:
        """The value at ``start`` if it goes up to the end of its line or element."""
        end = self._end(_REST, start)
        if self._checked[0] != end:
            self._checked = (end, bool(_VALUE_END.match(self._text, end)))
        return (start, end) if self._checked[1] else None


def _target(text: str, at: int) -> str:
    """The name before a sign, with quotes or a bracket and blanks between; empty if none."""
    while at and text[at - 1] in " \t":
        at -= 1
    for _ in range(2):
        if at and text[at - 1] in "\"']":
            at -= 1
    size = _TARGET_CHARS
    while not (before := text[max(0, at - size) : at]).rstrip(_NAME_CHARS) and size < at:
        size *= 2
    return before[len(before.rstrip(_NAME_CHARS)) :].lstrip(string.digits + ".-")


def assignments(text: str) -> list[tuple[str, list]]:
    """Pairs of a target name and its right side, literals as (start, end) and names, as written."""
    pairs, unquoted = [], Unquoted(text)
    for sign in _SIGN.finditer(text):
        at, end = sign.span()
        if text[end : end + 1] in ("=", ":") or text[at - 1 : at] in ("=", "!", "<", ">", ":"):
            continue
        target = _target(text, at)
        if not target:
            continue
        terms, more = [], True
        while more and (term := _TERM.match(text, end)):
            kind, start = term.lastindex, term.start(term.lastindex)
            span = unquoted.run(start) if kind == 5 else term.span(kind)
            end = span[1] if kind == 5 else term.end()
            more = _PLUS.match(text, end)
            whole = unquoted.value(start) if kind >= 4 and not terms and not more else None
            terms.append(Name(term.group(4), whole) if kind == 4 else whole or span)
            if more:
                end = more.end()
        if terms:
            pairs.append((at, target, terms))
    pairs += [(m.start(), m.group(1), [m.span(2)]) for m in _ELEMENT.finditer(text)]
    return [(name, terms) for _, name, terms in sorted(pairs, key=lambda pair: pair[0])]


@dataclass(frozen=True)
class Value:
    """What scoring needs of a right side's text: it is as long as all constants in it together."""

    length: int = 0
    counts: Counter = field(default_factory=Counter)
    head: str = ""
    tail: str = ""

    @staticmethod
    def of(text: str) -> Value:
        return Value(len(text), Counter(text), text[:_ENDS], text[-_ENDS:])

    @staticmethod
    def joined(parts: list[Value]) -> Value:
        length, counts, head, tail = 0, Counter(), "", ""
        for part in parts:
            length += part.length
            counts.update(part.counts)
            head, tail = (head + part.head)[:_ENDS], (tail + part.tail)[-_ENDS:]
        if (over := length.bit_length() - _MOST_BITS) > 0:
            length >>= over
            counts = Counter({c: n >> over for c, n in counts.items() if n >> over})
        return Value(length, counts, head, tail)

    @property
    def richness(self) -> tuple[float, int]:
        """What orders values by how likely they make a joined one score."""
        return (entropy(self.counts, self.length) if self.length else 0.0, self.length)

    def score(self, weight: float) -> float:
        shown = self.head if self.length <= _ENDS else f"{self.head}\0{self.tail}"
        if self.length < LEAST_LITERAL or PLACEHOLDERS.match(shown):
            return 0.0
        return weight * min(1.0, entropy(self.counts, self.length) / ENOUGH_ENTROPY)


class Constants:
    """All assignments of a text, by their place in it, and what names on right sides stand for."""

    def __init__(self, text: str, pairs: list[tuple[str, list]]):
        self._text, self._pairs = text, pairs
        self._places: dict[str, list[int]] = {}
        for k, (name, _) in enumerate(pairs):
            self._places.setdefault(name, []).append(k)
        self._values: dict[int, Value] = {}
        self._literals: dict[tuple[int, int], Value] = {}
        self._richest: dict[str, list[int]] = {}

    def _known(self, term) -> str | None:
        """The assigned name that a term is."""
        if not isinstance(term, Name):
            return None
        return next((x for x in (term.text, term.text.removeprefix("$")) if x in self._places), None)

    def _literal(self, term) -> tuple[int, int] | None:
        """The span of a term that is a literal, or may be one."""
        if not isinstance(term, Name):
            return term
        if term.span and self._known(term) and self._text[slice(*term.span)] == term.text:
            return None
        if term.span and _NAME.fullmatch(self._text, *term.span):
            return None
        return term.span

    def weights(self) -> dict[int, float]:
        """The weight of the most sensitive name that each assignment reaches, by any way."""
        own = [name_weight(name) for name, _ in self._pairs]
        reached, followed = {}, set()
        for weight in sorted({w for w in own if w}, reverse=True):
            todo = [k for k, w in enumerate(own) if w == weight]
            while todo:
                k = todo.pop()
                if k in reached:
                    continue
                reached[k] = weight
                for name in map(self._known, self._pairs[k][1]):
                    if name is not None and name not in followed:
                        followed.add(name)
                        todo += self._places[name]
        return reached

    def literals(self, weights: dict[int, float]) -> dict[tuple[int, int], float]:
        """Every literal of those assignments with its weight."""
        found = {}
        for k, weight in weights.items():
            for span in filter(None, map(self._literal, self._pairs[k][1])):
                found[span] = max(weight, found.get(span, 0.0))
        return found

    def _meant(self, k: int, changed: tuple = ()) -> list[int | None]:
        """Per term of assignment ``k`` the latest assignment of the name before it, else the next;
        or the one that is given for the name."""
        meant, given = [], dict(changed)
        for name in map(self._known, self._pairs[k][1]):
            if name in given:
                meant.append(given[name])
                continue
            places = self._places.get(name, [])
            at = bisect_left(places, k)
            after = [p for p in places[:2] if p != k]
            meant.append(places[at - 1] if at else after[0] if after else None)
        return meant

    def _join(self, k: int, meant: list[int | None]) -> Value:
        parts = []
        for term, place in zip(self._pairs[k][1], meant):
            if place is not None:
                parts.append(self._values.get(place, Value()))
            elif span := self._literal(term):
                if span not in self._literals:
                    self._literals[span] = Value.of(self._text[slice(*span)])
                parts.append(self._literals[span])
        return parts[0] if len(parts) == 1 else Value.joined(parts)

    def _evaluate(self, k: int) -> None:
        """The value of assignment ``k`` and of all it rests on; one in a circle is empty there."""
        todo, opened = [k], set()
        while todo:
            k = todo[-1]
            meant = self._meant(k) if k not in self._values else []
            more = [p for p in meant if p is not None and p not in self._values and p not in opened]
            if k in self._values or k in opened or not more:
                self._values.setdefault(k, self._join(k, meant))
                todo.pop()
            opened.add(k)
            todo += more if k not in self._values else []

    def joined(self, weights: dict[int, float]) -> set[tuple[int, int]]:
        """The pieces of joined right sides that score enough as a whole.

        A name means its latest assignment before the right side. As code runs in other orders than
        it stands, later assignments are tried too (but not of the name that is assigned itself):
        for each right side the next and the richest one of each name, alone and all together, and
        for each assignment the richest right side before it that reads the name. So the time goes
        with the number of names on right sides, however often they are assigned.
        """
        found, told = set(), set()
        readers: dict[str, list[int]] = {}
        tries: set[tuple[int, tuple]] = set()
        for k in sorted(weights):
            own, terms = self._pairs[k]
            if len(terms) < 2:
                continue
            tries.add((k, ()))
            later = {}
            for name in set(map(self._known, terms)) - {None, own}:
                readers.setdefault(name, []).append(k)
                at = bisect_left(self._places[name], k + 1)
                if at < len(self._places[name]):
                    later[name] = (self._places[name][at], self._richest_after(name, at))
            for choice in (0, 1):
                chosen = tuple(sorted((name, places[choice]) for name, places in later.items()))
                tries.add((k, chosen))
                tries.update((k, (one,)) for one in chosen)
        for name, reading in readers.items():
            at, best = 0, None
            for place in self._places[name]:
                while at < len(reading) and reading[at] < place:
                    rich = (self._value(reading[at], ()).richness, -reading[at])
                    best = max(best or rich, rich)
                    at += 1
                if best is not None:
                    tries.add((-best[1], ((name, place),)))
        for k, changed in sorted(tries):
            if self._value(k, changed).score(weights[k]) >= LEAST_SCORE:
                found |= self._pieces(k, self._meant(k, changed), told)
        return found

    def _value(self, k: int, changed: tuple) -> Value:
        """The value of assignment ``k`` if the changed names mean those assignments."""
        meant = self._meant(k, changed)
        for place in meant:
            if place is not None:
                self._evaluate(place)
        return self._join(k, meant)

    def _richest_after(self, name: str, at: int) -> int:
        """Of a name's assignments from the ``at``-th on, the one with the richest value."""
        if name not in self._richest:
            best, after = None, []
            for place in reversed(self._places[name]):
                self._evaluate(place)
                rich = (self._values[place].richness, -place)
                best = max(best or rich, rich)
                after.append(-best[1])
            self._richest[name] = after[::-1]
        return self._richest[name][at]

    def _pieces(self, k: int, meant: list[int | None], told: set[int]) -> set[tuple[int, int]]:
        """The literals of a right side and of the assignments it means, without those told before."""
        found, todo = set(), [(k, meant)]
        while todo:
            k, meant = todo.pop()
            for term, place in zip(self._pairs[k][1], meant):
                if place is None:
                    span = self._literal(term)
                    if span and span[0] < span[1]:
                        found.add(span)
                elif place not in told:
                    told.add(place)
                    todo.append((place, self._meant(place)))
        return found


def literal_spans(text: str) -> list[tuple[int, int]]:
    """Literals that reach a sensitive name, directly or through constants, and score enough."""
    lowered = text.lower()
    if not any(hint in lowered for hint in _HINTS):
        return []
    pairs = assignments(text)
    if not any(name_weight(name) for name, _ in pairs):
        return []
    constants = Constants(text, pairs)
    weights = constants.weights()
    return sorted({*scored_spans(text, constants.literals(weights)), *constants.joined(weights)})


def all_spans(text: str) -> tuple[list, list]:
    """Base spans, and base and method spans together, each by start and kind."""
    base = base_spans(text)
    more, at, reached = [], 0, -1
    for start, end in literal_spans(text):
        while at < len(base) and base[at][0] <= start:
            reached = max(reached, base[at][2])
            at += 1
        if end > reached:
            more.append((start, 3, end))
    return base, sorted(base + more)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: counts of the base kinds, the base spans' digest, and all spans."""

    def make():
        def step(texts):
            out = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for text in texts:
                base, spans = all_spans(text)
                kinds = [kind for _, kind, _ in base]
                for k, name in enumerate(("n_assign", "n_access", "n_hex")):
                    out[name].append(kinds.count(k))
                out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
                out["spans"].append(written(spans))
            return out

        return step

    schema = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return map_texts(filled(docs), make, schema)


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span, overlapping ones as one, replaced in ``text``; ``n_chars`` follows.

    Null texts stay null; all other columns and all rows stay.
    """
    redacted = fresh(docs, "_redacted")

    def make():
        def step(texts):
            return {redacted: [None if text is None else _without(text, mark) for text in texts]}

        return step

    clean = map_texts(docs, make, f"{redacted} string", tuple(docs.columns))
    columns = {"text": F.col(redacted)}
    if "n_chars" in docs.columns:
        changed = ~F.col("text").eqNullSafe(F.col(redacted))
        length = F.length(redacted).cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(changed, length).otherwise(F.col("n_chars"))
    return clean.withColumns(columns).drop(redacted)


def _without(text: str, mark: str) -> str:
    _, spans = all_spans(text)
    if not spans:
        return text
    parts, at, end = [], 0, -1
    for start, _, stop in spans:
        if start >= end:
            parts += [text[at:start], mark]
        end = max(end, stop)
        at = end
    return "".join([*parts, text[at:]])
