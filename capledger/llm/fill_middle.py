"""Fill-in-middle: documents cut at line ends and put in another order.

The ends of a text's lines form a set of boundaries in the manner of Roaring bitmaps: boundaries with equal high
16 bits share a container, which is a sorted array, a bitmap or a list of runs, whichever is smallest. Cumulative
cardinalities lead to the container of the k-th boundary, a select inside it to the boundary; two of them are
looked up for each document.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, pick, slices


@dataclass(frozen=True)
class Settings:
    #: Of a hundred documents so many are transformed, and of those so many are written suffix first.
    transformed: int = 100
    suffix_first: int = 50
    seed: int = 7
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


class Values:
    """A sorted array of 16-bit values."""

    def __init__(self, low: np.ndarray):
        self.values = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.values[k])


class Bitmap:
    """65,536 bits, with the number of bits before each word of 64."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << 16, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        word = int(self.words[at])
        for _ in range(k - int(self.before[at])):
            word &= word - 1  # drops the lowest bit
        return at << 6 | (word & -word).bit_length() - 1


class Runs:
    """First values of runs, with the number of values before each run."""

    def __init__(self, first: np.ndarray, before: np.ndarray):
        self.first, self.before = first, before

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.first[at]) + k - int(self.before[at])


def container(low: np.ndarray) -> Values | Bitmap | Runs:
    """The smallest container of sorted 16-bit values: 2 bytes a value, 4 a run or 8,192 in all."""
    starts = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    if 4 * len(starts) < min(2 * len(low), 8192):
        return Runs(low[starts], starts)
    return Values(low) if 2 * len(low) <= 8192 else Bitmap(low)


class Boundaries:
    """A set of sorted offsets from which the k-th can be had."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> 16
        starts = np.flatnonzero(np.diff(high, prepend=-1))
        self.size = len(offsets)
        self.before = starts
        self.high = high[starts]
        ends = [*starts[1:].tolist(), len(offsets)][:len(starts)]
        self.containers = [container(offsets[a:b] & 0xFFFF) for a, b in zip(starts.tolist(), ends, strict=True)]

    def select(self, k: int) -> int:
        """The k-th offset, counted from 0."""
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.high[at]) << 16 | self.containers[at].select(k - int(self.before[at]))


def line_ends(text: bytes) -> Boundaries:
    """Where each line ends: behind its line feed, and at the end of a text that ends without one."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    if text and not text.endswith(b"\n"):
        ends = np.append(ends, len(text))
    return Boundaries(ends)


def draws(seed: int, row_id: int | None) -> list[int]:
    """Four numbers of 32 bits for a row; a null id counts as empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if row_id is None else row_id}".encode()).digest()
    return [int.from_bytes(digest[at:at + 4]) for at in range(0, 16, 4)]


def characters(text: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return len(text) if text.isascii() else int(np.count_nonzero(np.frombuffer(text, np.uint8) & 0xC0 != 0x80))


def transform_text(text: bytes, row_id: int | None, settings: Settings) -> tuple[int, str, int | None, int | None, bytes]:
    """Lines, form, characters of prefix and middle, and the output for one text."""
    ends = line_ends(text)
    n = ends.size
    h1, h2, h3, h4 = draws(settings.seed, row_id)
    prefix, suffix, middle = (m.encode() for m in (settings.prefix, settings.suffix, settings.middle))
    if not text or prefix in text or suffix in text or middle in text or h3 % 100 >= settings.transformed:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    first = ends.select(low - 1) if low else 0
    second = ends.select(high - 1) if high else 0
    a, b, c = text[:first], text[first:second], text[second:]
    if h4 % 100 < settings.suffix_first:
        form, output = "spm", b"".join([suffix, c, prefix, a, middle, b])
    else:
        form, output = "psm", b"".join([prefix, a, suffix, c, middle, b])
    return n, form, characters(a), characters(b), output


def transform(
    docs: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Each row's lines, form, characters of prefix and middle, and output.

    Whole texts are cut; null counts as empty. Empty texts, and texts that hold one of the marks, stay plain, with
    null characters. Cuts depend on the row's id alone: repeated rows give equal outputs; a null id is kept and
    counts as empty text. Other columns are left out.
    """
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                rows = [
                    transform_text(text, row_id, settings)
                    for row_id, text in zip(part.column(0).to_pylist(), byte_texts(part.column(1)), strict=True)
                ]
                n, form, before, between, output = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()),
                        pa.array(between, pa.int64()), pa.array(output, pa.binary()).view(pa.string()),
                    ],
                    names=[id_column, "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    rows = pick(docs, (id_column, "long"), (text_column, "string"))
    return rows.mapInArrow(
        run, f"`{id_column}` long, n long, form string, prefix_chars long, middle_chars long, output string",
    )


def restored(output: Column, form: Column, settings: Settings = Settings()) -> Column:
    """The exact text of an output: no text that was transformed holds a mark, so the first of each kind is the real one."""
    p, s, m = (F.lit(x) for x in (settings.prefix, settings.suffix, settings.middle))
    to = {x: F.locate(mark, output) for x, mark in (("p", settings.prefix), ("s", settings.suffix), ("m", settings.middle))}

    def between(start: Column, end: Column) -> Column:
        return F.substring(output, start, end - start)

    middle = F.substring(output, to["m"] + F.length(m), F.length(output))
    psm = F.concat(between(F.length(p) + 1, to["s"]), middle, between(to["s"] + F.length(s), to["m"]))
    spm = F.concat(between(to["p"] + F.length(p), to["m"]), middle, between(F.length(s) + 1, to["p"]))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Lines, form and lengths of every document, and digests of the output and of the text restored from it."""
    return transform(docs, settings).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form"), settings).cast("binary"), 256).alias("restored_sha256"),
    )


#: DuckDB SQL for the digests with default settings.
DIGESTS_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS h FROM documents
), lines AS (
  SELECT *, length(t) - length(replace(t, chr(10), '')) + CASE WHEN t = '' OR ends_with(t, chr(10)) THEN 0 ELSE 1 END AS n FROM d
), draws AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS k1, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS k2,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
      WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
    string_split(t, chr(10)) AS parts
  FROM lines
), cuts AS (
  SELECT *,
    CASE least(k1, k2) WHEN 0 THEN '' WHEN n THEN t ELSE array_to_string(parts[1:least(k1, k2)], chr(10)) || chr(10) END AS a,
    CASE greatest(k1, k2) WHEN 0 THEN '' WHEN n THEN t ELSE array_to_string(parts[1:greatest(k1, k2)], chr(10)) || chr(10) END AS ab
  FROM draws
), pieces AS (
  SELECT doc_id, t, n, form, a, substr(ab, length(a) + 1) AS b, substr(t, length(ab) + 1) AS c FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(b) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b
    ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM pieces
"""
