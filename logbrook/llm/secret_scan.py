"""Secrets in texts: all rules in one automaton, one step per byte.

The combined automaton finds where matches end. Only there the rule's own
automata are asked: read backwards for the leftmost start that no earlier match
of the kind covers, read forwards for the longest end. The rules are such that
the match that ends first also begins first.

Null texts count as empty. Each row is scanned on its own, so repeated rows give
repeated results; extra columns are ignored by ``found`` and kept by ``masked``.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logbrook.llm.automaton import compiled
from logbrook.llm.batches import filled, map_texts


@dataclass(frozen=True)
class Rule:
    """``shortest`` counts the whole match, ``shortest_value`` the run of ``value`` at its end."""

    kind: str
    pattern: str
    fold: bool = False
    shortest: int = 1
    value: str = ""
    shortest_value: int = 0


VALUE = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"

# The three base kinds first, then what this operator adds.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=\-]+""", True, 1, VALUE, 8),
    Rule("access", r"AKIA[A-Z0-9]+", shortest=16),
    Rule("hex", r"[0-9a-f]{32,}", shortest=32),
    Rule("private_key", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_\-]+\.eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+", shortest=40),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]+", shortest=40),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9\-]+", shortest=20),
)
BASE = ("assign", "access", "hex")
MASK = "[secret]"

SCHEMA = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_spans bigint"
)
NAMES = [column.split()[0] for column in SCHEMA.split(", ")]


class Scanner:
    """The compiled rules."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        patterns = [(rule.pattern, rule.fold) for rule in rules]
        self.combined = compiled(patterns, search=True)
        self.forward = [compiled([pattern], search=False) for pattern in patterns]
        self.backward = [compiled([pattern], search=False, backwards=True) for pattern in patterns]
        self._rows: tuple | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_rows": None}  # they lead in circles

    def _tables(self) -> tuple:
        if self._rows is None:
            own = [[(a.rows(), a.dead) for a in kind] for kind in (self.forward, self.backward)]
            self._rows = self.combined.rows(), *own
        return self._rows

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, by start and rule."""
        rows, forward, backward = self._tables()
        state = rows[0]
        covered = [0] * len(self.rules)
        found = []
        for at, byte in enumerate(data):
            state = state[byte]
            if state[256]:
                for rule in state[256]:
                    if at < covered[rule]:
                        continue
                    start = _reach(*backward[rule], data, at, covered[rule] - 1, -1)
                    if start is None:
                        continue
                    end = _reach(*forward[rule], data, start, len(data), 1) + 1
                    covered[rule] = end
                    if self._long_enough(self.rules[rule], data[start:end]):
                        found.append((start, rule, end))
        return sorted(found)

    @staticmethod
    def _long_enough(rule: Rule, match: bytes) -> bool:
        value = len(match) - len(match.rstrip(rule.value.encode())) if rule.value else 0
        if rule.kind == "assign":
            value = len(_assigned(match))
        return len(match) >= rule.shortest and value >= rule.shortest_value


def _assigned(match: bytes) -> bytes:
    """What is assigned: all after the first ``:`` or ``=``, blanks and one quote."""
    cut = min(at for at in (match.find(b":"), match.find(b"=")) if at >= 0)
    rest = match[cut + 1 :].lstrip(b" ")
    return rest[1:] if rest[:1] in (b'"', b"'") else rest


def _reach(rows: list[list], dead: int | None, data: bytes, at: int, stop: int, step: int) -> int | None:
    """The last place, going from ``at`` by ``step`` and before ``stop``, at which the automaton accepts."""
    state, lost, last = rows[0], None if dead is None else rows[dead], None
    for place in range(at, stop, step):
        state = state[data[place]]
        if state is lost:
            break
        if state[256]:
            last = place
    return last


def character_spans(scanner: Scanner, text: str) -> list[tuple[int, int, int]]:
    """The same spans in code points."""
    data = text.encode()
    spans = scanner.spans(data)
    if len(data) == len(text):
        return spans
    places: dict[int, int] = {}
    last = seen = 0
    for place in sorted({p for start, _, end in spans for p in (start, end)}):
        seen += len(data[last:place].decode())
        places[place], last = seen, place
    return [(places[start], rule, places[end]) for start, rule, end in spans]


def found(
    documents: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """One row per document with counts of the base kinds and its spans."""
    scanner = Scanner(rules)

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [_row(scanner, value) for value in filled(batch.column(1)).to_pylist()]
        columns = [pa.array(column) for column in zip(*rows)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], NAMES)

    return map_texts(documents.select(F.col(key).cast("bigint").alias("doc_id"), text), scan, SCHEMA, text)


def _row(scanner: Scanner, text: str) -> tuple:
    spans = character_spans(scanner, text)
    named = [(scanner.rules[rule].kind, f"{scanner.rules[rule].kind}:{start}:{end}") for start, rule, end in spans]
    base = [kind for kind, _ in named if kind in BASE]
    digest = hashlib.sha256(",".join(shown for kind, shown in named if kind in BASE).encode()).hexdigest()
    return *[base.count(kind) for kind in BASE], digest, ",".join(shown for _, shown in named), len(named)


def masked(
    documents: DataFrame, text: str = "text", length: str | None = "n_chars", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """The documents with every span replaced by ``MASK`` and ``length``, if there is such a column, brought up to date."""
    scanner = Scanner(rules)

    def mask(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(text)
        new = pa.array([value and _masked(scanner, value) for value in texts.to_pylist()], texts.type)
        batch = batch.set_column(batch.schema.get_field_index(text), batch.schema.field(text), new)
        at = batch.schema.get_field_index(length) if length else -1
        if at < 0:
            return batch
        old = batch.column(at)
        counted = pc.if_else(pc.fill_null(pc.equal(texts, new), True), old, pc.utf8_length(new).cast(old.type))
        return batch.set_column(at, batch.schema.field(at), counted)

    return map_texts(documents, mask, documents.schema, text)


def _masked(scanner: Scanner, text: str) -> str:
    parts, last = [], 0
    for start, _, end in character_spans(scanner, text):
        if start >= last:
            parts += [text[last:start], MASK]
        last = max(last, end)
    return "".join(parts) + text[last:] if parts else text
