"""Secret scans by one deterministic automaton for all rules.

All rules are compiled together (see ``automata``) into one transition array. A batch of texts is cut
behind bytes that reset the automaton and its pieces are scanned side by side, each byte once: in step
``i`` the states of all pieces advance over their ``i``-th bytes. Texts in which a rule ends somewhere are
then given their exact spans by that rule's own automaton, started only where the rule can begin.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automata import Automaton, compile_all
from .common import byte_texts, pick, slices, span_text


@dataclass(frozen=True)
class Rule:
    """A secret is ``head`` followed by ``value``; shorter values or matches than the given bytes are dropped.

    A dropped match still uses up its text.
    """

    kind: str
    head: str
    value: str
    min_value: int = 1
    min_length: int = 1


#: The first three are fixed by their definition; their order is the order of kinds.
RULES = (
    Rule("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?", r"[A-Za-z0-9+/_.=-]+", 6),
    Rule("access", "AKIA", "[A-Z0-9]+", min_length=20),
    Rule("hex", "", "[0-9a-f]{24,}", min_length=24),
    Rule("private_key", "-----BEGIN ", r"[A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", "gh[opsur]_", "[A-Za-z0-9]+", min_length=40),
    Rule("chat", "xox[abprs]-", "[A-Za-z0-9-]+", min_length=20),
)

BASE_KINDS = ("assign", "access", "hex")
PIECE_BYTES = 2048
SPANS = "array<struct<kind:string,start:long,end:long>>"


class Single:
    """One rule's own automata: where it can begin, its longest match and the end of its head."""

    def __init__(self, rule: Rule):
        self.rule = rule
        whole = compile_all([rule.head + rule.value], anchored=True)
        self.whole, self.accept, self.dead = whole.trans.tolist(), whole.accepts.tolist(), whole.dead
        head = compile_all([rule.head], anchored=True)
        self.head, self.head_accept, self.head_dead = head.trans.tolist(), head.accepts.tolist(), head.dead
        first = b"".join(re.escape(bytes([b])) for b in range(256) if whole.trans[0, b] != whole.dead)
        self.first = re.compile(b"[" + first + b"]")

    @staticmethod
    def _longest(data: bytes, at: int, trans, accept, dead: int) -> int:
        state, end = 0, at if accept[0] else -1
        for i in range(at, len(data)):
            state = trans[state][data[i]]
            if state == dead:
                break
            if accept[state]:
                end = i + 1
        return end

    def spans(self, data: bytes) -> list[tuple[int, int]]:
        """Leftmost non-overlapping longest matches as byte offsets, short ones left out."""
        found, at = [], 0
        while start := self.first.search(data, at):
            start = start.start()
            end = self._longest(data, start, self.whole, self.accept, self.dead)
            if end <= start:
                at = start + 1
                continue
            value = max(start, self._longest(data, start, self.head, self.head_accept, self.head_dead))
            if end - value >= self.rule.min_value and end - start >= self.rule.min_length:
                found.append((start, end))
            at = end
        return found


class Scanner:
    """All rules as one automaton, and each rule by itself for the exact spans."""

    def __init__(self, rules: Sequence[Rule], combined: Automaton | None = None):
        self.rules = rules
        combined = combined or compile_all([r.head + r.value for r in rules])
        # States are stored times 256, so that the next one is found at state + byte.
        self.flat = (combined.trans * 256).astype(np.int32).reshape(-1)
        self.accepts, self.edge = combined.accepts, combined.first_accepting * 256
        resets = b"".join(re.escape(bytes([b])) for b in combined.resets())
        self.reset = re.compile(b"[" + resets + b"]") if resets else None

    @cached_property
    def singles(self) -> list[Single]:
        return [Single(rule) for rule in self.rules]

    def pieces(self, texts: Sequence[bytes]) -> list[tuple[int, int, int]]:
        """(text, from, to), cut only where the automaton is back at its start."""
        out = []
        for i, text in enumerate(texts):
            at = 0
            while len(text) - at > PIECE_BYTES and self.reset:
                cut = self.reset.search(text, at + PIECE_BYTES - 1)
                if not cut:
                    break
                out.append((i, at, cut.end()))
                at = cut.end()
            out.append((i, at, len(text)))
        return out

    def hits(self, texts: Sequence[bytes]) -> np.ndarray:
        """For each text the bits of the rules that end somewhere in it; every byte is read once."""
        marks = np.zeros(len(texts), np.int64)
        pieces = sorted(self.pieces(texts), key=lambda p: p[1] - p[2])
        lengths = np.array([b - a for _, a, b in pieces])
        owner = np.array([i for i, _, _ in pieces])
        low = 0
        while low < len(pieces) and lengths[low]:
            # Pieces of similar length side by side, so that the padding stays small.
            high = max(low + 1, int(np.searchsorted(-lengths, -(int(lengths[low]) // 2), "right")))
            high = min(high, low + max(1, (16 << 20) // int(lengths[low])))
            own = lengths[low:high]
            grid = np.zeros((high - low, int(own[0])), np.uint8)
            for row, (i, a, b) in enumerate(pieces[low:high]):
                grid[row, :b - a] = np.frombuffer(texts[i], np.uint8, b - a, a)
            columns = np.ascontiguousarray(grid.T)
            active = np.searchsorted(-own, -np.arange(1, int(own[0]) + 1), "right")
            state = np.zeros(high - low, np.int32)
            found = np.zeros(high - low, np.int64)
            for step in range(int(own[0])):
                n = int(active[step])
                now = state[:n]
                np.add(now, columns[step, :n], out=now)
                np.take(self.flat, now, out=now, mode="clip")
                if now.max() >= self.edge:
                    at = np.nonzero(now >= self.edge)[0]
                    found[at] |= self.accepts[now[at] >> 8]
            np.bitwise_or.at(marks, owner[low:high], found)
            low = high
        return marks

    def spans(self, texts: Sequence[bytes]) -> list[list[tuple[str, int, int]]]:
        """(kind, start, end) of each text in code points, by start, then kind."""
        out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        marks = self.hits(texts)
        for i in np.nonzero(marks)[0].tolist():
            data = texts[i]
            found = [
                (start, rule, end) for rule in range(len(self.rules)) if marks[i] >> rule & 1
                for start, end in self.singles[rule].spans(data)
            ]
            if found and not data.isascii():
                points = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
                before = np.concatenate([[0], points])
                found = [(int(before[s]), rule, int(before[e])) for s, rule, e in found]
            out[i] = [(self.rules[rule].kind, s, e) for s, rule, e in sorted(found)]
        return out


def scan(
    docs: DataFrame, rules: Sequence[Rule] = RULES, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Each row's id and ``spans``, an array of (kind, start, end) in code points, end exclusive.

    Whole texts are scanned. Null and empty texts have no spans. Rows are scanned one by one: repeated rows
    and null ids are kept. Other columns are left out. Spans of different kinds may overlap.
    """
    combined = compile_all([r.head + r.value for r in rules])
    shared = docs.sparkSession.sparkContext.broadcast(combined)

    def run(batches):
        scanner = Scanner(rules, shared.value)
        for batch in batches:
            for part in slices(batch, 4096):
                found = scanner.spans(byte_texts(part.column(1)))
                flat = [s for spans in found for s in spans]
                offsets = np.zeros(len(found) + 1, np.int32)
                np.cumsum([len(s) for s in found], out=offsets[1:])
                values = pa.StructArray.from_arrays([
                    pa.array([s[0] for s in flat], pa.string()), pa.array([s[1] for s in flat], pa.int64()),
                    pa.array([s[2] for s in flat], pa.int64()),
                ], names=["kind", "start", "end"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), values)], names=[id_column, "spans"],
                )

    rows = pick(docs, (id_column, "long"), (text_column, "string"))
    return rows.mapInArrow(run, f"`{id_column}` long, spans {SPANS}")


def redact(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text_column: str = "text", mark: str = "[{kind}]",
) -> DataFrame:
    """The same rows and columns, with every secret in the text replaced by its kind in brackets.

    Overlapping spans are replaced as one, named after the first. Texts without a secret, null and empty
    ones stay as they are; so do all other columns.
    """
    combined = compile_all([r.head + r.value for r in rules])
    shared = docs.sparkSession.sparkContext.broadcast(combined)
    names = docs.columns
    at = names.index(text_column)

    def masked(text: str, spans) -> str:
        out, done = [], 0
        for kind, start, end in spans:
            if start >= done:
                out += [text[done:start], mark.format(kind=kind)]
            done = max(done, end)
        return "".join([*out, text[done:]])

    def run(batches):
        scanner = Scanner(rules, shared.value)
        for batch in batches:
            for part in slices(batch, 4096):
                column = part.column(at)
                texts = byte_texts(column)
                found = scanner.spans(texts)
                if any(found):
                    new = [
                        masked(t.decode(), s) if s else (t.decode() if valid else None)
                        for t, s, valid in zip(texts, found, column.is_valid().to_pylist(), strict=True)
                    ]
                    part = part.set_column(at, part.schema.field(at), pa.array(new, column.type))
                yield part

    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.mapInArrow(run, plain.schema).toDF(*names)


def digests(docs: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans and all spans of every document."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scan(docs).select(
        "doc_id", *[count(kind) for kind in BASE_KINDS],
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"), span_text(spans).alias("spans"),
    )
