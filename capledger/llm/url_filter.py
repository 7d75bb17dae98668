"""URL filters by a sorted digest array.

Rules are pairs of a host and a path prefix. Their 64-bit xxhash keys lie sorted in one file, which each
Python worker maps into memory; the rules' full strings lie behind it in the same order. A url is
looked up by every suffix of its host at a dot, with every prefix of its path that has the length of some
rule's path. All keys of a batch are found by one vectorised binary search, and each hit counts only if
the stored string is the one looked for, so colliding digests do no harm.
"""

from __future__ import annotations

import mmap
import re
import tempfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import byte_texts, pick, slices


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"


RULES = (
    Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"),
)

#: The compiled rules are sent to every executor; larger rule sets are refused.
MAX_BYTES = 512 << 20

_URL = re.compile(rb"://([^/?#]*)([^?#]*)", re.S)


def split_url(url: bytes) -> tuple[bytes, bytes]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    found = _URL.search(url)
    return (found[1].lower(), found[2]) if found else (b"", b"")


def compile_rules(rules: Sequence[Rule], seed: int = 0, max_bytes: int = MAX_BYTES) -> bytes:
    """Header, sorted digests, string offsets, verdicts, lengths of the paths in use, strings.

    A rule stored twice keeps its first verdict.
    """
    first: dict[bytes, bool] = {}
    lengths = set()
    for rule in rules:
        path = rule.path.encode()
        first.setdefault(rule.host.lower().encode() + b"\0" + path, rule.verdict == "block")
        lengths.add(len(path))
    keyed = sorted((xxhash.xxh64_intdigest(text, seed), text) for text in first)
    texts = [text for _, text in keyed]
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    packed = b"".join([
        np.array([len(texts), len(lengths), seed], np.int64).tobytes(),
        np.array([key for key, _ in keyed], np.uint64).tobytes(), offsets.tobytes(),
        np.array(sorted(lengths), np.int64).tobytes(),
        np.array([first[t] for t in texts], np.uint8).tobytes(), b"".join(texts),
    ])
    if len(packed) > max_bytes:
        raise ValueError(f"{len(packed)} bytes of rules; at most {max_bytes} are sent to the executors")
    return packed


class DigestArray:
    """The compiled rules, mapped from a file of the worker's own that is gone with the worker."""

    def __init__(self, packed: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(packed)
            file.flush()
            self._map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        n, kinds, self.seed = (int(x) for x in np.frombuffer(self._map, np.int64, 3))
        at = 24
        self.keys = np.frombuffer(self._map, np.uint64, n, at)
        at += 8 * n
        self.offsets = np.frombuffer(self._map, np.int64, n + 1, at)
        at += 8 * (n + 1)
        self.path_lengths = np.frombuffer(self._map, np.int64, kinds, at).tolist()
        at += 8 * kinds
        self.block = np.frombuffer(self._map, np.uint8, n, at)
        self.strings = at + n

    def text(self, i: int) -> bytes:
        return self._map[self.strings + int(self.offsets[i]):self.strings + int(self.offsets[i + 1])]

    def candidates(self, host: bytes, path: bytes) -> Iterator[bytes]:
        """Every rule that would fit, as it would be stored."""
        heads = [path[:k] for k in self.path_lengths if k <= len(path)]
        while heads:
            for head in heads:
                yield host + b"\0" + head
            _, dot, host = host.partition(b".")
            if not dot:
                return

    def longest(self, urls: Sequence[tuple[bytes, bytes]]) -> list[int]:
        """For each (host, path) the longest rule that fits, or -1. Of equally long ones that with the longer host."""
        found = [-1] * len(urls)
        texts: list[bytes] = []
        owners: list[int] = []
        for i, (host, path) in enumerate(urls):
            for text in self.candidates(host, path):
                texts.append(text)
                owners.append(i)
        if not texts or not len(self.keys):
            return found
        probe = np.array([xxhash.xxh64_intdigest(t, self.seed) for t in texts], np.uint64)
        first = np.searchsorted(self.keys, probe, "left")
        last = np.searchsorted(self.keys, probe, "right")
        best = [(-1, -1)] * len(urls)
        for k in np.nonzero(last > first)[0].tolist():
            text, i = texts[k], owners[k]
            rank = (len(text), text.index(b"\0"))
            if rank > best[i]:
                for at in range(int(first[k]), int(last[k])):  # more than one only where digests collide
                    if self.text(at) == text:
                        best[i], found[i] = rank, at
        return found


def judge(
    pages: DataFrame, rules: Sequence[Rule] = RULES, default: str = "allow", id_column: str = "page_id",
    url_column: str = "url", max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """Each row's id, host, path, the rule that decides and the verdict.

    A url that no rule fits gets ``default``. A null url counts as empty: host and path are empty and no
    rule fits. Rows are judged one by one: repeated rows and null ids are kept. Other columns are left out.
    """
    packed = compile_rules(rules, max_bytes=max_bytes)
    shared = pages.sparkSession.sparkContext.broadcast(packed)

    def run(batches):
        array = DigestArray(shared.value)
        for batch in batches:
            for part in slices(batch, 4096):
                urls = [split_url(u) for u in byte_texts(part.column(1))]
                hits = array.longest(urls)
                rule = [None if i < 0 else array.text(i).replace(b"\0", b"") for i in hits]
                verdict = [default if i < 0 else ("block" if array.block[i] else "allow") for i in hits]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([h.decode() for h, _ in urls], pa.string()),
                    pa.array([p.decode() for _, p in urls], pa.string()),
                    pa.array([None if r is None else r.decode() for r in rule], pa.string()),
                    pa.array(verdict, pa.string()),
                ], names=[id_column, "host", "path", "rule", "verdict"])

    rows = pick(pages, (id_column, "long"), (url_column, "string"))
    return rows.mapInArrow(run, f"`{id_column}` long, host string, path string, rule string, verdict string")
