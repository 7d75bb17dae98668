"""License scans: Aho-Corasick for notices and tags, a shunting-yard parser for licence expressions.

A text is brought to words (runs of digits, lower-cased letters and everything beyond ASCII) joined by
blanks. One Aho-Corasick automaton over the notice phrases then finds every place of every phrase in one
pass; a second one finds identifier tags in the raw text. What follows a tag up to the end of its line is
an expression such as ``MIT OR (GPL-2.0-only WITH Classpath-exception-2.0)``; it is brought to postfix
order by operator precedence (WITH, AND, OR) and evaluated.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, pick, slices

#: Fixed by definition: the places of these phrases are counted.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Further notices.
PHRASES = {
    "bsd license": "bsd", "lesser general public license": "lgpl", "affero general public license": "agpl",
    "mozilla public license": "mpl", "eclipse public license": "epl", "isc license": "isc",
    "boost software license": "bsl", "creative commons": "cc", "cc by": "cc", "cc by nc": "cc-nc",
    "creative commons attribution noncommercial": "cc-nc", "all rights reserved": "proprietary",
    "permission is hereby granted free of charge": "mit", "redistribution and use in source and binary forms": "bsd",
    "this is free and unencumbered software": "unlicense",
}

TAGS = ("spdx-license-identifier:", "license-expression:")

#: Public identifiers of licences that expressions may name, and of exceptions behind WITH.
IDENTIFIERS = """
0BSD AFL-2.1 AFL-3.0 AGPL-1.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.0 Apache-1.1 Apache-2.0 APSL-2.0 Artistic-1.0
Artistic-2.0 BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0
BUSL-1.1 bzip2-1.0.6 CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-3.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0
CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC-PDDC CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CECILL-B
CECILL-C CPAL-1.0 CPL-1.0 curl ECL-2.0 EFL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 FTL GFDL-1.1 GFDL-1.2 GFDL-1.3
GFDL-1.3-only GFDL-1.3-or-later GPL-1.0 GPL-1.0-only GPL-1.0-or-later GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only
GPL-3.0-or-later HPND ICU IJG ImageMagick IPL-1.0 ISC JSON LGPL-2.0 LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1 LGPL-2.1-only
LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later libpng-2.0 LPPL-1.3c MIT MIT-0 MIT-CMU MPL-1.0 MPL-1.1 MPL-2.0
MPL-2.0-no-copyleft-exception MS-PL MS-RL MulanPSL-2.0 NCSA NPL-1.1 OFL-1.0 OFL-1.1 OLDAP-2.8 OpenSSL OSL-2.1 OSL-3.0 PHP-3.01
PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 Ruby SISSL Sleepycat SSPL-1.0 TCL Unicode-3.0 Unicode-DFS-2016 Unlicense UPL-1.0 Vim W3C
WTFPL X11 Zlib zlib-acknowledgement ZPL-2.1
""".split()
EXCEPTIONS = """
389-exception Autoconf-exception-2.0 Autoconf-exception-3.0 Bison-exception-2.2 Bootloader-exception Classpath-exception-2.0
CLISP-exception-2.0 eCos-exception-2.0 Font-exception-2.0 freertos-exception-2.0 GCC-exception-2.0 GCC-exception-3.1
GPL-CC-1.0 i2p-gpl-java-exception LGPL-3.0-linking-exception Libtool-exception Linux-syscall-note LLVM-exception
Nokia-Qt-exception-1.1 OCaml-LGPL-linking-exception OpenJDK-assembly-exception-1.0 openvpn-openssl-exception
Qt-GPL-exception-1.0 Qt-LGPL-exception-1.1 Swift-exception u-boot-exception-2.0 Universal-FOSS-exception-1.0
WxWindows-exception-3.1
""".split()
_KNOWN, _KNOWN_EXCEPTIONS = frozenset(x.lower() for x in IDENTIFIERS), frozenset(x.lower() for x in EXCEPTIONS)

#: These stand for no licence at all.
NOTHING = frozenset({"none", "noassertion"})

#: Labels whose licences ask for nothing but notices.
PERMISSIVE = frozenset({"mit", "apache", "bsd", "isc", "bsl", "unlicense", "cc0", "zlib"})

PRECEDENCE = {"OR": 1, "AND": 2, "WITH": 3}

#: How much each kind of finding adds to the certainty of the score.
WEIGHTS = {"base": 0.7, "phrase": 0.6, "expression": 0.9, "broken": 0.3}

_OTHER = bytes(
    b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:-]+")
_NEXT = re.compile(r"[ \t]*([()]|[A-Za-z0-9.+:-]+)")
_END = re.compile(rb"[\r\n]|\*/|-->")


class ExpressionError(ValueError):
    pass


@dataclass(frozen=True)
class Terms:
    """What an expression asks for: all labels in it, and whether permissive licences alone satisfy it."""

    labels: frozenset[str]
    permissive: bool


def label_of(identifier: str) -> str:
    """The family of a licence identifier: its first part, lower-cased (``GPL-2.0-or-later`` -> ``gpl``)."""
    family = identifier.lower().split("-")[0].rstrip("+")
    return {"0bsd": "bsd", "gnu": "gpl", "licenseref": identifier.lower()}.get(family, family)


def postfix(text: str) -> list[str]:
    """Operands and operators in postfix order, by two stacks."""
    tokens = _TOKEN.findall(text)
    if not tokens or _TOKEN.sub("", text).strip():
        raise ExpressionError(text)
    out, stack, operand_next = [], [], True
    for token in tokens:
        upper = token.upper()
        if token == "(":
            if not operand_next:
                raise ExpressionError(text)
            stack.append(token)
        elif token == ")":
            if operand_next:
                raise ExpressionError(text)
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                raise ExpressionError(text)
            stack.pop()
        elif upper in PRECEDENCE:
            if operand_next:
                raise ExpressionError(text)
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[upper]:
                out.append(stack.pop())
            stack.append(upper)
            operand_next = True
        else:
            if not operand_next:
                raise ExpressionError(text)
            out.append(token)
            operand_next = False
    while stack:
        if stack[-1] == "(":
            raise ExpressionError(text)
        out.append(stack.pop())
    if operand_next:
        raise ExpressionError(text)
    return out


def is_licence(name: str) -> bool:
    """Whether a name, with or without the plus for later versions, is a known identifier or one of the document's own."""
    low = name.lower()
    return low in NOTHING or low.removesuffix("+") in _KNOWN or re.fullmatch(r"(documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+", low) is not None


def is_exception(name: str) -> bool:
    return name.lower() in _KNOWN_EXCEPTIONS or name.lower().startswith("additionref-")


class _Reader:
    """Reads an expression token by token and tells of each beginning whether it is an expression itself.

    Values are names, or None for what an operator has made of two values. ``take`` is false as soon as no longer
    beginning can be an expression either.
    """

    def __init__(self, values: list[str | None] = (), operators: list[str] = (), operand_next: bool = True, depth: int = 0):
        self.values, self.operators = list(values), list(operators)
        self.operand_next, self.depth = operand_next, depth

    def copy(self) -> _Reader:
        return _Reader(self.values, self.operators, self.operand_next, self.depth)

    def take(self, token: str) -> bool:
        upper = token.upper()
        operand = token == "(" or token != ")" and upper not in PRECEDENCE
        if operand != self.operand_next:
            return False
        if token == "(":
            self.operators.append(token)
            self.depth += 1
        elif token == ")":
            if self.depth == 0 or not self._reduce(0):
                return False
            self.operators.pop()
            self.depth -= 1
        elif operand:
            if not (is_licence(token) or is_exception(token)):
                return False
            self.values.append(token)
            self.operand_next = False
        else:
            if not self._reduce(PRECEDENCE[upper]):
                return False
            self.operators.append(upper)
            self.operand_next = True
        return True

    def _reduce(self, precedence: int) -> bool:
        """Apply the operators since the last open bracket that bind at least as strongly."""
        while self.operators and self.operators[-1] != "(" and PRECEDENCE[self.operators[-1]] >= precedence:
            operator, right, left = self.operators.pop(), self.values.pop(), self.values.pop()
            if operator == "WITH":
                if not _takes_exception(left, right):
                    return False
            elif not all(v is None or is_licence(v) for v in (left, right)):
                return False
            self.values.append(None)
        return True

    def complete(self) -> bool:
        """Without open brackets operators wait in rising order, so few are left to apply."""
        if self.operand_next or self.depth:
            return False
        rest = self.copy()
        return rest._reduce(0) and (rest.values[0] is None or is_licence(rest.values[0]))


def read_expression(text: str) -> tuple[str, Terms]:
    """The longest beginning of a text that is an expression, however long, and what it asks for.

    A full stop at its end belongs to the sentence. Each token is read once.
    """
    reader, at, end = _Reader(), 0, 0
    while found := _NEXT.match(text, at):
        token, at = found[1], found.end()
        bare = token.rstrip(".")
        if bare and bare != token and not reader.depth:  # the sentence may end here
            last = reader.copy()
            if last.take(bare) and last.complete():
                end = found.start(1) + len(bare)
        if not reader.take(token):
            break
        if reader.complete():
            end = at
    if not end:
        raise ExpressionError(text)
    return text[:end].lstrip(" \t"), evaluate(text[:end])


def evaluate(text: str) -> Terms:
    """OR leaves a choice, AND asks for both, WITH adds an exception to the licence before it."""
    labels: set[str] = set()
    stack: list[bool | str] = []  # a name, or whether permissive licences alone satisfy what an operator has made

    def permissive(value: bool | str) -> bool:
        if isinstance(value, bool):
            return value
        if not is_licence(value):
            raise ExpressionError(text)
        if value.lower() in NOTHING:
            return False
        label = label_of(value)
        labels.add(label)
        return label in PERMISSIVE

    for token in postfix(text):
        if token not in PRECEDENCE:
            stack.append(token)
            continue
        right, left = stack.pop(), stack.pop()
        if token == "WITH":
            if not _takes_exception(left, right):
                raise ExpressionError(text)
            allowed = permissive(left)
            labels.add(f"{label_of(left)}-with-{right.lower()}")
        else:
            a, b = permissive(left), permissive(right)
            allowed = a or b if token == "OR" else a and b
        stack.append(allowed)
    allowed = permissive(stack.pop())
    return Terms(frozenset(labels), allowed)


def _takes_exception(left: object, right: object) -> bool:
    """Whether a value is the name of a licence that the exception behind WITH can be added to."""
    names = isinstance(left, str) and isinstance(right, str)
    return names and is_licence(left) and left.lower() not in NOTHING and is_exception(right)


class Scanner:
    """The two Aho-Corasick automata. Bytes stand for characters, so offsets are byte offsets."""

    def __init__(self, base: Mapping[str, str], phrases: Mapping[str, str], tags):
        self.phrases = ahocorasick.Automaton()
        for phrase in {**phrases, **base}:
            own = (base.get(phrase), phrases.get(phrase))
            self.phrases.add_word(f" {phrase} ", (len(phrase) + 2, *own))
        self.phrases.make_automaton()
        self.tags = ahocorasick.Automaton()
        for tag in tags:
            self.tags.add_word(tag, tag)
        self.guards = [tag.encode("latin-1") for tag in tags]
        self.tags.make_automaton()

    def scan(self, data: bytes) -> tuple:
        """n_words, starts of base places, base labels, all labels, score, expressions, permissive."""
        words = data.translate(_OTHER).split()
        text = " " + b" ".join(words).decode("latin-1") + " "
        starts, base, labels, doubt = [], set(), set(), 1.0
        seen, at, number = set(), 0, 0
        for end, (length, first, other) in self.phrases.iter(text):
            begin = end - length + 1
            if first is not None:
                # Places of different phrases may arrive out of order, by the length of the longest.
                number += text.count(" ", at, begin) if begin >= at else -text.count(" ", begin, at)
                at = begin
                starts.append(number)
                base.add(first)
                if first not in seen:
                    doubt *= 1 - WEIGHTS["base"]
                    seen.add(first)
            if other is not None:
                labels.add(other)
                if other not in seen:
                    doubt *= 1 - WEIGHTS["phrase"]
                    seen.add(other)
        expressions, permissive = [], None
        folded = data.lower()  # A-Z alone
        if any(tag in folded for tag in self.guards):
            for end, _ in self.tags.iter(folded.decode("latin-1")):
                stop = _END.search(data, end + 1)
                source = data[end + 1:stop.start() if stop else len(data)].decode("utf-8", "replace").strip()
                expressions.append(source)
                try:
                    _, terms = read_expression(source)
                except ExpressionError:
                    doubt *= 1 - WEIGHTS["broken"]
                else:
                    labels |= terms.labels
                    permissive = terms.permissive if permissive is None else permissive and terms.permissive
                    doubt *= 1 - WEIGHTS["expression"]
        return len(words), starts, base, base | labels, 1 - doubt, expressions, permissive


def scan(
    docs: DataFrame, base: Mapping[str, str] = BASE_PHRASES, phrases: Mapping[str, str] = PHRASES, tags=TAGS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Each row's id, n_words, base_places (word numbers in order), base_labels, labels (sorted arrays), score,
    expressions (as written behind the tags) and permissive (null without a readable expression).

    Whole texts are scanned. Null and empty texts have no words, labels or places and score 0. Rows are
    scanned one by one: repeated rows and null ids are kept. Other columns are left out. Behind a tag the
    longest beginning that is an expression of known identifiers counts; if there is none, no label is added.
    """
    base, phrases, tags = dict(base), dict(phrases), tuple(tags)

    def run(batches):
        scanner = Scanner(base, phrases, tags)
        for batch in batches:
            for part in slices(batch, 1024):
                found = [scanner.scan(t) for t in byte_texts(part.column(1))]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([f[0] for f in found], pa.int64()),
                    pa.array([np.sort(np.array(f[1], np.int64)) for f in found], pa.list_(pa.int64())),
                    pa.array([sorted(f[2]) for f in found], pa.list_(pa.string())),
                    pa.array([sorted(f[3]) for f in found], pa.list_(pa.string())),
                    pa.array([f[4] for f in found], pa.float64()),
                    pa.array([f[5] for f in found], pa.list_(pa.string())), pa.array([f[6] for f in found], pa.bool_()),
                ], names=[id_column, "n_words", "base_places", "base_labels", "labels", "score", "expressions", "permissive"])

    rows = pick(docs, (id_column, "long"), (text_column, "string"))
    return rows.mapInArrow(
        run, f"`{id_column}` long, n_words long, base_places array<long>, base_labels array<string>, "
             "labels array<string>, score double, expressions array<string>, permissive boolean",
    )


def digests(docs: DataFrame) -> DataFrame:
    """Counts, first and last base place and joined labels of every document."""
    places = F.col("base_places")
    return scan(docs).select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"),
        F.try_element_at(places, F.lit(1)).alias("first_word"), F.try_element_at(places, F.lit(-1)).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
        F.array_join("expressions", "\n").alias("expressions"), "permissive",
    )
