r"""Personal data in texts, plain or disguised, with spans in the text as it was written.

Plain identifiers are found in the text itself (the base). For disguised ones a
chain of transducers rewrites the text and notes for every change where it came
from: look-alike letters and foreign digits become ASCII and invisible marks go;
spelled digits become digits; "at" and "dot" in their disguises become ``@`` and
``.``. What is then found with a changed place inside is mapped back through the
chain to the source characters and added, unless a base span of its kind covers it.

Where a disguise is also ordinary language, its context decides: a bare "at"
counts only before a host whose dots are disguised too, a bare "dot" only in
such a host or between digits, spelled digits only from three in a row on or
beside a plus or dot between digits.

Searches go from mark to mark (``@``, ``+``, the first digit of a run), so their
time is in proportion to a text however long its runs are. Null texts count as
empty. Each row is scanned on its own: repeated rows and ids give repeated
results, a null id stays null. Extra columns are ignored by ``found`` and kept by ``masked``.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logbrook.llm.batches import filled, map_texts

KINDS = ("email", "ip", "card", "phone")

SCHEMA = (
    "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint,"
    " base_sha256 string, spans string, n_added bigint"
)
NAMES = [column.split()[0] for column in SCHEMA.split(", ")]

Span = tuple[int, int, int]  # kind, start, end

# --- plain identifiers -------------------------------------------------------------------

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def plain(text: str) -> list[Span]:
    """The base spans by kind and start."""
    found = [(0, start, end) for start, end in _emails(text)]
    if _DIGIT.search(text):
        found += [(1, *m.span()) for m in _IP.finditer(text) if all(_byte(part) for part in m[0].split("."))]
        found += [(2, *m.span()) for m in _CARD.finditer(text) if _is_card(m[0])]
        found += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= _n_digits(m[0]) <= 15]
    return found


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ back over the local part, at most to the end of the address before."""
    at, free = text.find("@"), 0
    while at >= 0:
        match = _DOMAIN.match(text, at)
        if match:
            start = at
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                yield start, match.end()
                free = match.end()
        at = text.find("@", at + 1)


def _byte(part: str) -> bool:
    digits = part.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def _n_digits(match: str) -> int:
    return sum("0" <= mark <= "9" for mark in match)


def _is_card(match: str) -> bool:
    """16 to 19 digits that pass Luhn's check."""
    digits = [int(mark) for mark in match if "0" <= mark <= "9"]
    if not 16 <= len(digits) <= 19:
        return False
    total = sum(digits[-1::-2]) + sum(2 * d - 9 * (d > 4) for d in digits[-2::-2])
    return total % 10 == 0


# --- transducers -------------------------------------------------------------------------

Edit = tuple[int, int, str]  # start, end, what is written there instead


class Rewritten:
    """A text after some edits, which maps places of the new text to the old one."""

    def __init__(self, old: str, edits: list[Edit]) -> None:
        parts, last, new_at = [], 0, 0
        self.edits = edits
        self.starts: list[int] = []  # of the edits, in the new text
        self.ends: list[int] = []
        for start, end, written in edits:
            parts += [old[last:start], written]
            new_at += start - last
            self.starts.append(new_at)
            new_at += len(written)
            self.ends.append(new_at)
            last = end
        self.text = "".join(parts) + old[last:]

    def touched(self, start: int, end: int) -> bool:
        """Whether a span of the new text holds a changed place."""
        at = bisect.bisect_left(self.ends, start)
        while at < len(self.starts) and self.starts[at] < end:
            first = self.starts[at] if self.starts[at] == self.ends[at] else self.ends[at]
            if first > start:
                return True
            at += 1
        return False

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The old span a new one came from: whole edits, but nothing deleted at its ends."""
        return self._place(start, False), self._place(end - 1, True)

    def _place(self, at: int, after: bool) -> int:
        """Where the character ``at`` begins in the old text, or where it ends."""
        edit = bisect.bisect_right(self.starts, at) - 1
        if edit < 0:
            return at + after
        start, end, _ = self.edits[edit]
        if at < self.ends[edit]:
            return end if after else start
        return end + at - self.ends[edit] + after


# Letters of other scripts that look like these Latin ones.
LOOKALIKES = {
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P",
    "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y", "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j",
    "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "ԝ": "w", "х": "x", "у": "y",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ι": "i", "ɑ": "a", "ɡ": "g", "ı": "i",
    "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2014": "-", "\u2212": "-",
    "\u2024": ".", "\u3002": ".", "\uff61": ".", "\ufe52": ".", "\ufe6b": "@",
    "\u00a0": " ", "\u202f": " ", "\u3000": " ",
    "\u00ad": "", "\u200b": "", "\u200c": "", "\u200d": "", "\u2060": "", "\ufeff": "",
}


def _folds() -> dict[str, str]:
    """Look-alikes, decimal digits of all scripts, and the full-width and mathematical forms of ASCII."""
    folds = {chr(code): chr(code - 0xFEE0) for code in range(0xFF01, 0xFF5F)}
    for code in range(0x80, 0x20000):
        mark = chr(code)
        digit = unicodedata.decimal(mark, None)
        if digit is not None:
            folds[mark] = str(digit)
        elif 0x1D400 <= code < 0x1D800:
            form = unicodedata.normalize("NFKC", mark)
            folds[mark] = form if form.isascii() else LOOKALIKES.get(form, form)
    spaces = {chr(code): " " for code in range(0x2000, 0x200B)}
    return folds | spaces | LOOKALIKES


class Folding:
    """One character to at most one: look-alikes to ASCII, invisible marks away."""

    def __init__(self) -> None:
        self.folds = _folds()

    def edits(self, text: str) -> Iterator[Edit]:
        if text.isascii():
            return
        marks = set(text) & self.folds.keys()
        if marks:
            for match in re.finditer("[" + "".join(map(re.escape, sorted(marks))) + "]", text):
                yield *match.span(), self.folds[match[0]]


class Misread:
    """Letters that stand for digits, where digits stand on both sides."""

    marks = re.compile("(?:(?<=[0-9])|(?<=[0-9][ -]))[OoIl](?=[ -]?[0-9])")

    def edits(self, text: str) -> Iterator[Edit]:
        for match in self.marks.finditer(text):
            yield *match.span(), "0" if match[0] in "Oo" else "1"


# The digits' names in the languages of the corpus.
DIGIT_NAMES = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
    "oh": "0",
}
TIMES = {"double": 2, "triple": 3}
FEWEST_NAMES = 3

DOT_NAMES = ("dot", "punkt", "point", "punto")
AT_NAMES = ("at", "arroba", "arobase")
# After a bare "at" these are no host but plain English: "at some point in", "at the dot".
NO_DOTS = ("point", "punto")
NO_HOSTS = frozenset("a an the this that these those my your his her its our their some any".split())


def _any(words) -> str:
    return "|".join(sorted(words, key=lambda word: (-len(word), word)))


_BLANK = r"[ \t]{0,3}"
_GAP = r"[ \t]{1,3}"


def _bracketed(inner: str) -> str:
    return rf"{_BLANK}[\[({{<]{_BLANK}(?:{inner}){_BLANK}[\])}}>]{_BLANK}"


_DOT_WORD = rf"{_GAP}(?:{_any(DOT_NAMES)}){_GAP}|[_-](?:{_any(DOT_NAMES)})[_-]"
_DOT_BRACKET = _bracketed(rf"{_any(DOT_NAMES)}|\.") + r"|&#46;|&period;|%2e"
_AT_WORD = rf"{_GAP}(?:{_any(AT_NAMES)}){_GAP}|[_-](?:{_any(AT_NAMES)})[_-]"
_AT_BRACKET = _bracketed(rf"{_any(AT_NAMES)}|@") + rf"|&#64;|&commat;|%40|{_GAP}@{_BLANK}|@{_GAP}"


class Spelled:
    """Digits by name, perhaps mixed with figures, to figures: "plus four nine, double five" becomes "+4955"."""

    def __init__(self) -> None:
        item = rf"(?:(?:{_any(TIMES)})[ -]+)?(?:{_any(DIGIT_NAMES)})|[0-9]+"
        dot = rf"{_GAP}(?:{_any(DOT_NAMES)}){_GAP}|\."
        self.chain = re.compile(rf"(?<!\w)(?:plus[ -]+|\+ ?)?(?:{item})(?:(?:{dot}|[ ,-]{{1,3}})(?:{item}))++(?!\w)", re.I)
        self.part = re.compile(rf"(?P<plus>plus[ -]+|\+ ?)|(?P<dot>{dot})|(?:(?P<times>{_any(TIMES)})[ -]+)?(?P<name>{_any(DIGIT_NAMES)})|(?P<figures>[0-9]+)", re.I)

    def edits(self, text: str) -> Iterator[Edit]:
        for match in self.chain.finditer(text):
            names, written, dotted = 0, [], False
            for part in self.part.finditer(match[0]):
                if part["plus"]:
                    written.append("+")
                elif part["dot"]:
                    written.append(".")
                    dotted = True
                elif part["name"]:
                    names += TIMES.get((part["times"] or "").lower(), 1)
                    written.append(DIGIT_NAMES[part["name"].lower()] * TIMES.get((part["times"] or "").lower(), 1))
                else:
                    written.append(part["figures"])
            if names >= FEWEST_NAMES or (names and (dotted or written[0] == "+")):
                yield *match.span(), "".join(written)


class Marks:
    """Disguised ``@`` and ``.`` to the marks themselves."""

    def __init__(self) -> None:
        dot = rf"(?P<dot>{_DOT_BRACKET}|{_DOT_WORD}|\.)"
        self.at = re.compile(rf"(?<=[A-Za-z0-9_%+-])(?:(?P<sure>@|{_AT_BRACKET})|{_AT_WORD})(?=[A-Za-z0-9])", re.I)
        self.label = re.compile("[A-Za-z0-9]+(?:-[A-Za-z0-9]+)*+")
        self.dot = re.compile(dot + r"(?=[A-Za-z0-9])", re.I)
        self.dot_before = re.compile(rf"(?<=[A-Za-z0-9])(?:{_DOT_BRACKET}|{_DOT_WORD})$", re.I)
        self.between = re.compile(rf"(?<=[0-9])(?:{_DOT_BRACKET}|{_DOT_WORD})(?=[0-9])", re.I)
        self.tail = 24  # no disguised dot is longer

    def edits(self, text: str) -> Iterator[Edit]:
        found: dict[int, Edit] = {match.start(): (*match.span(), ".") for match in self.between.finditer(text)}
        for match in self.at.finditer(text):
            found |= {edit[0]: edit for edit in self._address(text, match)}
        last = 0
        for start in sorted(found):
            if start >= last:
                yield found[start]
                last = found[start][1]

    def _address(self, text: str, at: re.Match) -> list[Edit]:
        """The edits of one address, if what follows "at" is a host."""
        edits, disguised, labels = [], False, 1
        label = self.label.match(text, at.end())
        bare = not at["sure"] and at[0].strip(" \t_-").lower() == "at"
        if not label or (bare and label[0].lower() in NO_HOSTS):
            return []
        end = label.end()
        while dot := self.dot.match(text, end):
            label = self.label.match(text, dot.end())
            if not label or (bare and dot["dot"].strip(" \t_-").lower() in NO_DOTS):
                break
            if dot["dot"] != ".":
                edits.append((*dot.span(), "."))
                disguised = True
            end, labels = label.end(), labels + 1
        last = label[0] if label else ""
        if labels < 2 or not (disguised or at["sure"]) or (at[0] == "@" and not disguised):
            return []
        if last and not last[-1].isalpha():
            return []
        start = at.start()
        while True:
            while start and text[start - 1] in LOCAL:
                start -= 1
            before = self.dot_before.search(text, max(0, start - self.tail), start) if start else None
            if not before or not disguised:
                break
            edits.append((*before.span(), "."))
            start = before.start()
        if at[0] != "@":
            edits.append((*at.span(), "@"))
        return edits


# What a text must hold for the transducers to change anything; more than that is met by chance.
_NAME = f"(?:{_any(DIGIT_NAMES)})"
_STEP = f"(?:[ ,-]{{1,3}}|{_GAP}(?:{_any(DOT_NAMES)}){_GAP}|[.])"
HINTS = "|".join([
    f"{_NAME}{_STEP}(?:{_NAME}|{_any(TIMES)}|[0-9])",
    f"(?:plus[ -]+|[0-9]{_STEP})(?:{_NAME}|{_any(TIMES)})",
    "[0-9][ -]?[OoIl][ -]?[0-9]",
    _bracketed(rf"{_any(AT_NAMES)}|{_any(DOT_NAMES)}|@|\."),
    "&#46;|&#64;|&period;|&commat;|%2e|%40|[ \t]@|@[ \t]",
    rf"[ \t_-](?:{_any((*DOT_NAMES, 'arroba', 'arobase'))})[ \t_-]",
    "[^\x00-\x9f\u00a1-\u00ac\u00ae-\u0130\u0132-\u024f]",
])


class Finder:
    """The chain of transducers, ready for use."""

    def __init__(self) -> None:
        self._chain: tuple | None = None

    def __getstate__(self) -> dict:
        return {"_chain": None}  # patterns are compiled where they are used

    def rewritten(self, text: str) -> list[Rewritten]:
        """The steps that changed the text, first to last."""
        if self._chain is None:
            self._chain = Folding(), Spelled(), Misread(), Marks()
        steps = []
        for transducer in self._chain:
            edits = list(transducer.edits(text))
            if edits:
                steps.append(Rewritten(text, edits))
                text = steps[-1].text
        return steps

    def spans(self, text: str, hinted: bool = True) -> tuple[list[Span], list[Span]]:
        """Base spans and added ones, each by kind and start, as places of the text itself. Unless ``hinted`` nothing is disguised."""
        base = plain(text)
        steps = self.rewritten(text) if hinted else []
        if not steps:
            return base, []
        added = set()
        for kind, start, end in plain(steps[-1].text):
            touched = False
            for step in reversed(steps):
                touched |= step.touched(start, end)
                start, end = step.source(start, end)
            if touched and not any(k == kind and s <= start and end <= e for k, s, e in base):
                added.add((kind, start, end))
        return base, sorted(added)

    def all_spans(self, texts: pa.Array) -> Iterator[tuple[list[Span], list[Span]]]:
        """The same for many texts; null ones count as empty."""
        texts = filled(texts)
        hints = pc.match_substring_regex(texts, HINTS, ignore_case=True)
        return map(self.spans, texts.to_pylist(), hints.to_pylist())


def found(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts and digest of the base spans, and all spans."""
    finder = Finder()

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [_row(base, added) for base, added in finder.all_spans(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(column) for column in zip(*rows))], NAMES)

    return map_texts(documents.select(F.col(key).cast("bigint").alias("doc_id"), text), scan, SCHEMA, text)


def _row(base: list[Span], added: list[Span]) -> tuple:
    counts = [sum(kind == wanted for kind, _, _ in base) for wanted in range(len(KINDS))]
    return *counts, hashlib.sha256(shown(base).encode()).hexdigest(), shown(sorted({*base, *added})), len(added)


def shown(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


def masked(
    documents: DataFrame, text: str = "text", mask: Callable[[str], str] = lambda kind: f"[{kind}]"
) -> DataFrame:
    """The documents with every span replaced by its kind; a null text stays null. Of overlapping spans the first to begin names the whole."""
    finder = Finder()

    def hide(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(text)
        spans = finder.all_spans(texts)
        new = [None if value is None else _masked(value, *own, mask) for value, own in zip(texts.to_pylist(), spans)]
        return batch.set_column(batch.schema.get_field_index(text), batch.schema.field(text), pa.array(new, texts.type))

    return map_texts(documents, hide, documents.schema, text)


def _masked(text: str, base: list[Span], added: list[Span], mask: Callable[[str], str]) -> str:
    parts, last = [], 0
    for start, end, kind in sorted((start, end, kind) for kind, start, end in {*base, *added}):
        if start >= last:
            parts += [text[last:start], mask(KINDS[kind])]
        last = max(last, end)
    return "".join(parts) + text[last:]
