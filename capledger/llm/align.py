"""Alignment of the tokens of two tokenizers by lockstep merging.

Both tokenizations of a text run over the same bytes. A merge with a pointer into each finds the offsets where
tokens of both end: the pointer whose token ends first goes on, and where both end together it emits a link and a
cut. The pointers of all documents of a window lie in two NumPy vectors and take each step together; documents
that are through leave the vectors. Long documents are merged as several lanes, parted where both tokenizers are
known to end a token, so that the vectors stay long.

Tokens come from the tokenizers' own libraries, once for each distinct stretch of text. A stretch ends before a
blank behind a character that is no white space: neither tokenizer has a token across such a place.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import UNSETTLED, byte_letters
from .common import IdRuns, Numbered, byte_texts, drop_shared, pick, shared_table, slices

#: What the second vocabulary writes for a blank.
BLANK = "▁"

#: Characters that are merged together, stretches of a lane, and stretches that a Python worker keeps.
WINDOW, LANE, KEPT = 1 << 20, 128, 600_000

#: Id pairs that are looked up in a broadcast table, the most frequent first; all others are joined by shuffling.
HOT_PAIRS = 1 << 17

#: Behind these a blank does not end a stretch: white space in the eyes of any version of Unicode.
OPEN = frozenset([*(c for c in map(chr, range(0x3001)) if c.isspace()), "\u180e", "\u200b", BLANK])
_OPEN = "".join(map(re.escape, sorted(OPEN)))
_END = re.compile(f"(?<=[^{_OPEN}]) ")
_UNSETTLED = re.compile(f" (?<=[{_OPEN}] )")


#: Fixed by byte-level vocabularies: how a text is cut into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Longer stretches are encoded one by one.
LONG = 4096


def _by_rank(model: dict) -> bool:
    """Whether the ids of merged tokens have the order of their merges."""
    vocab = model["vocab"]
    ids = [vocab["".join(pair if isinstance(pair, list) else pair.split(" "))] for pair in model["merges"]]
    return ids == sorted(set(ids))


@dataclass
class Tokenizers:
    """The two vocabularies as they are shared with the workers: JSON of a byte-level BPE and a sentencepiece model."""

    first: str
    second: bytes

    @cached_property
    def stretches(self) -> Stretches:
        """One store for all tasks of a Python worker."""
        return Stretches(self)


def read_tokenizers(first: str | None = None, second: str | None = None) -> Tokenizers:
    """Both files, read once on the driver; their size does not depend on the data."""
    import public_tokenizers

    with open(first or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        source = file.read()
    if json.loads(source)["normalizer"] is not None:
        raise ValueError("a byte-level vocabulary without a normalizer is needed")
    with open(second or public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return Tokenizers(source, file.read())


class Side(IdRuns):
    """Ids of stretches by one tokenizer, and the byte lengths of its tokens."""

    def __init__(self, tokens: list[bytes]):
        super().__init__()
        self.tokens = tokens
        self.lengths = np.array([len(t) for t in tokens], np.int64)

    def of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, lengths = super().of(places)
        return ids.astype(np.int64), lengths


class Stretches:
    """Stretches of text with the tokens of both sides."""

    def __init__(self, source: Tokenizers):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_str(source.first)
        self._a.encode_special_tokens = True
        self._a.no_truncation()
        self._a.no_padding()
        self._b = sentencepiece.SentencePieceProcessor(model_proto=source.second)
        letters = {c: b for b, c in enumerate(byte_letters())}
        texts = {i: t for t, i in self._a.get_vocab(with_added_tokens=False).items()}
        a = [bytes(letters[c] for c in texts.get(i, "")) for i in range(max(texts) + 1)]
        # The same vocabulary by ranks is faster; it is used where both libraries are sure to cut a text alike.
        self._fast = tiktoken.Encoding(
            "ranks", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(a) if t}, special_tokens={},
        ).encode_ordinary if _by_rank(json.loads(source.first)["model"]) else None
        b = []
        for i in range(self._b.get_piece_size()):
            piece = self._b.id_to_piece(i)
            b.append(bytes([int(piece[3:-1], 16)]) if self._b.is_byte(i) else piece.replace(BLANK, " ").encode())
            if not self._b.is_control(i) and re.search(f"[^{BLANK}]{BLANK}", piece):
                raise ValueError("a piece holds a blank behind another character")
        self._blank = self._b.piece_to_id(BLANK)
        self.a, self.b = Side(a), Side(b)
        self.places = Numbered()
        self.exact = np.zeros(1 << 14, bool)

    @staticmethod
    def cut(text: str) -> list[str]:
        """The stretches of a text, each without the blank before it."""
        return _END.split(text) if text[0] == " " or _UNSETTLED.search(text) else text.split(" ")

    def learn(self, stretches: Sequence[str]) -> np.ndarray:
        """The places of stretches; all are forgotten before they become too many."""
        if len(self.places) > KEPT:
            self.places = Numbered()
            self.a.clear()
            self.b.clear()
        found = self.places.of(stretches)
        new, self.places.new = self.places.new, []
        for at in range(0, len(new), 8192):
            self._encode(new[at:at + 8192])
        return found

    def _encode(self, new: list[str]) -> None:
        """Add the ids of stretches that are met for the first time.

        Those that end a stretch in any surroundings are encoded in one go: bytes tell where each one's ids end.
        """
        alone = [not s or s[-1] in OPEN or len(s) > LONG or BLANK in s or not s.isascii() and UNSETTLED.search(s) is not None for s in new]
        together = [s for s, one in zip(new, alone, strict=True) if not one]
        sizes = np.array([len(s.encode()) + 1 for s in together], np.int64)
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if together:
            text = " ".join(together)
            a = np.array(self._fast(" " + text) if self._fast else self._a.encode(" " + text, add_special_tokens=False).ids, np.int64)
            b = np.array(self._b.encode(text), np.int64)
        a_of, b_of = self._sizes(self.a, a, sizes), self._sizes(self.b, b, sizes)
        data = (" " + " ".join(together)).encode() if together else b""
        if a_of is None or b_of is None or any(b"".join(map(x.tokens.__getitem__, ids.tolist())) != data for x, ids in ((self.a, a), (self.b, b))):
            raise ValueError("the tokens do not make up the text")
        first = self.a.n
        while first + len(new) > len(self.exact):
            self.exact = np.concatenate([self.exact, np.zeros_like(self.exact)])
        if not any(alone):
            self.exact[first:first + len(new)] = True
            self.a.add(a, a_of)
            self.b.add(b, b_of)
            return
        a_at, b_at = np.cumsum(a_of) - a_of, np.cumsum(b_of) - b_of
        a_all, b_all, at = [], [], 0
        for i, (stretch, one) in enumerate(zip(new, alone, strict=True)):
            if one:
                data = (" " + stretch).encode()
                # The second tokenizer puts the blank before a stretch itself, but not before an empty one.
                x, y = self._a.encode(" " + stretch, add_special_tokens=False).ids, self._b.encode(stretch) if stretch else [self._blank]
                exact = all(b"".join(map(side.tokens.__getitem__, ids)) == data for side, ids in ((self.a, x), (self.b, y)))
                a_all.append(np.array(x, np.int64))
                b_all.append(np.array(y, np.int64))
            else:
                exact = True
                a_all.append(a[a_at[at]:a_at[at] + a_of[at]])
                b_all.append(b[b_at[at]:b_at[at] + b_of[at]])
                at += 1
            self.exact[first + i] = exact
        self.a.add(np.concatenate(a_all), np.array([len(x) for x in a_all]))
        self.b.add(np.concatenate(b_all), np.array([len(x) for x in b_all]))

    @staticmethod
    def _sizes(side: Side, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray | None:
        """How many of the ids make up each stretch; None if some stretch does not end with a token."""
        ends, wanted = np.cumsum(side.lengths[ids]), np.cumsum(sizes)
        at = np.searchsorted(ends, wanted)
        if len(wanted) and (at[-1] + 1 != len(ids) or (ends[at] != wanted).any()):
            return None
        return np.diff(at + 1, prepend=0)


@dataclass
class Part:
    """Aligned tokens of a document, or of a part of a long one: ids, and how many tokens there are to the end of each group."""

    document: int
    a: np.ndarray
    b: np.ndarray
    a_cuts: np.ndarray
    b_cuts: np.ndarray
    #: The groups as text, each with a semicolon behind it.
    text: bytes = b""
    exact: bool = True


class GroupText:
    """Groups as text: decimal ids, ``a1,a2|b1;a3|b2,b3;``."""

    def __init__(self, ids: int):
        texts = [str(i).encode() for i in range(ids)]
        if ids > 10_000_000:
            raise ValueError("ids of up to seven digits can be written")
        self.lengths = np.array([len(t) for t in texts], np.uint8)
        self.digits = np.array([int.from_bytes(t, "little") for t in texts], np.uint64)

    def of(self, a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of groups whose last tokens are given, and where the bytes of each token end; tokens of ``a`` come first in
        each group, those of ``b`` behind them."""
        a_sizes, b_sizes = np.diff(a_last, prepend=-1), np.diff(b_last, prepend=-1)
        ids = np.empty(len(a) + len(b), np.int64)
        a_at = np.arange(len(a)) + np.repeat(b_last + 1 - b_sizes, a_sizes)
        b_at = np.arange(len(b)) + np.repeat(a_last + 1, b_sizes)
        ids[a_at], ids[b_at] = a, b
        signs = np.full(len(ids), ord(","), np.uint64)
        signs[a_at[a_last]], signs[b_at[b_last]] = ord("|"), ord(";")
        lengths = self.lengths[ids]
        # Each token in eight bytes: its digits, and the sign behind them.
        words = self.digits[ids] | signs << (lengths.astype(np.uint64) << np.uint64(3))
        kept = np.arange(8, dtype=np.uint8) <= lengths[:, None]
        return words.astype("<u8").view(np.uint8).reshape(-1, 8)[kept], np.cumsum(lengths, dtype=np.int64) + np.arange(1, len(ids) + 1)


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, a_from: np.ndarray, b_from: np.ndarray, a_to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of both sides that end together, by lanes that start at tokens ``a_from`` and ``b_from``.

    Each lane's last tokens end together, so it is through when its first side is.
    """
    i, j, to = a_from.copy(), b_from.copy(), a_to
    a_cut, b_cut = np.zeros(len(a_ends), bool), np.zeros(len(b_ends), bool)
    alive = i < to
    i, j, to = i[alive], j[alive], to[alive]
    while len(i):
        x, y = a_ends[i], b_ends[j]
        together = x == y
        a_cut[i[together]] = True
        b_cut[j[together]] = True
        i += x <= y
        j += y <= x
        alive = i < to
        if not alive.all():
            i, j, to = i[alive], j[alive], to[alive]
    return np.flatnonzero(a_cut), np.flatnonzero(b_cut)


def _parts_of(text: str) -> Iterator[str]:
    """A text in parts that end before a blank behind a letter or digit."""
    at, border = 0, re.compile(r"(?<=[^\W_]) ")
    while len(text) - at > WINDOW and (found := border.search(text, at + WINDOW)):
        yield text[at:found.start()]
        at = found.end()
    yield text[at:]


def _merge(known: Stretches, window: list[tuple[int, list[str]]], texts: GroupText | None) -> Iterator[Part]:
    """The parts of a window, all merged together."""
    places = known.learn(list(itertools.chain.from_iterable(s for _, s in window)))
    sizes = np.array([len(s) for _, s in window], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    exact = np.logical_and.reduceat(known.exact[places], starts[:-1])
    places = places[np.repeat(exact, sizes)]
    sizes = sizes[exact]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    a, a_of = known.a.of(places)
    b, b_of = known.b.of(places)
    # Tokens before each stretch; both sides have equally many bytes before it.
    a_before, b_before = (np.concatenate([[0], np.cumsum(n)]) for n in (a_of, b_of))
    lanes = [np.arange(start, start + size, LANE) for start, size in zip(starts, sizes, strict=False)]
    lane = np.concatenate([*lanes, np.zeros(0, np.int64)]).astype(np.int64)
    lane_end = np.append(lane[1:], len(places)) if len(lane) else lane
    a_cut, b_cut = lockstep(
        np.cumsum(known.a.lengths[a]), np.cumsum(known.b.lengths[b]), a_before[lane], b_before[lane], a_before[lane_end],
    )
    if texts is not None:
        data, ends = texts.of(a, b, a_cut, b_cut)
    at = 0
    a_from, b_from = a_before[starts], b_before[starts]
    link = np.searchsorted(a_cut, a_from)
    empty = np.zeros(0, np.int64)
    for (document, _), whole in zip(window, exact, strict=True):
        if not whole:
            yield Part(document, empty, empty, empty, empty, exact=False)
            continue
        links = slice(link[at], link[at + 1])
        text = b""
        if texts is not None:
            first, last = a_from[at] + b_from[at], a_from[at + 1] + b_from[at + 1]
            text = data[ends[first - 1] if first else 0:ends[last - 1]].tobytes()
        yield Part(
            document, a[a_from[at]:a_from[at + 1]], b[b_from[at]:b_from[at + 1]],
            a_cut[links] - a_from[at] + 1, b_cut[links] - b_from[at] + 1, text,
        )
        at += 1


def aligned(known: Stretches, texts: Sequence[str], groups: GroupText | None = None) -> Iterator[list[Part]]:
    """For each text the parts of its alignment; none for an empty text, or one whose tokens do not make up the text."""
    def merged() -> Iterator[Part]:
        window, held = [], 0
        for document, text in enumerate(texts):
            for part in _parts_of(text) if text else ():
                window.append((document, known.cut(part)))
                held += len(part)
                if held >= WINDOW:
                    yield from _merge(known, window, groups)
                    window, held = [], 0
        if window:
            yield from _merge(known, window, groups)

    parts, ahead = merged(), None
    for document in range(len(texts)):
        own = []
        while ahead is not None or (ahead := next(parts, None)) is not None:
            if ahead.document != document:
                break
            own.append(ahead)
            ahead = None
        yield own if all(p.exact for p in own) else []


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays], dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)]).astype(np.int64)).cast(kind))


def align(
    docs: DataFrame, first: str | None = None, second: str | None = None, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Each row's ids by both tokenizers, and how many tokens of each there are up to the end of each group.

    The tokens that end a group are linked. A blank is put before a text. Texts that are null or empty, or that the
    tokens of one side do not make up (the second tokenizer's sign for a blank is in it), have no tokens. Rows are aligned
    one by one: repeated rows and null ids are kept, other columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_tokenizers(first, second))

    def run(batches):
        known = shared.value.stretches
        for batch in batches:
            for part in slices(batch, size=1 << 20):
                columns: list[list[np.ndarray]] = [[], [], [], []]
                for own in aligned(known, [t.decode() for t in byte_texts(part.column(1))]):
                    a_before = np.cumsum([0] + [len(p.a) for p in own])
                    b_before = np.cumsum([0] + [len(p.b) for p in own])
                    nothing = [np.zeros(0, np.int64)]
                    columns[0].append(np.concatenate([p.a for p in own] or nothing))
                    columns[1].append(np.concatenate([p.b for p in own] or nothing))
                    columns[2].append(np.concatenate([p.a_cuts + n for p, n in zip(own, a_before, strict=False)] or nothing))
                    columns[3].append(np.concatenate([p.b_cuts + n for p, n in zip(own, b_before, strict=False)] or nothing))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[_lists(c, pa.int32()) for c in columns]], names=[id_column, "a_ids", "b_ids", "a_cuts", "b_cuts"],
                )

    rows = pick(docs, (id_column, "long"), (text_column, "string"))
    return rows.mapInArrow(run, f"`{id_column}` long, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>")


def _links(docs: DataFrame, shared, id_column: str, text_column: str) -> DataFrame:
    """Each row's numbers of tokens and groups, the digest of its groups, and its id pairs with the links that hold them.

    A pair is one number, the first id times the second vocabulary's size plus the second id. ``row`` tells rows apart.
    """
    def run(batches):
        known = shared.value.stretches
        width = len(known.b.tokens)
        groups = GroupText(max(len(known.a.tokens), width))
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, size=1 << 20):
                numbers, digests, pairs, times = [], [], [], []
                for own in aligned(known, [t.decode() for t in byte_texts(part.column(1))], groups):
                    digest = hashlib.sha256()
                    for i, p in enumerate(own):
                        digest.update(p.text if i + 1 < len(own) else p.text[:-1])
                    codes = [p.a[p.a_cuts - 1] * width + p.b[p.b_cuts - 1] for p in own]
                    code, n = np.unique(np.concatenate([*codes, np.zeros(0, np.int64)]), return_counts=True)
                    numbers.append((row, sum(len(p.a) for p in own), sum(len(p.b) for p in own), int(n.sum())))
                    digests.append(digest.hexdigest() if own else "")
                    pairs.append(code)
                    times.append(n)
                    row += 1
                columns = [pa.array(c, pa.int64()) for c in zip(*numbers, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *columns, pa.array(digests, pa.string()), _lists(pairs, pa.int64()), _lists(times, pa.int32())],
                    names=[id_column, "row", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"],
                )

    rows = pick(docs, (id_column, "long"), (text_column, "string"))
    return rows.mapInArrow(
        run, f"`{id_column}` long, row long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<int>",
    )


def pair_counts(links: DataFrame, width: int) -> DataFrame:
    """How many links hold each pair, and whether no other pair of its second id has more."""
    counted = (
        links.select(F.inline(F.arrays_zip("pairs", "times"))).groupBy(F.col("pairs").alias("pair"))
        .agg(F.sum(F.col("times").cast("long")).alias("n"))
    )
    # A group is one id's partners: no more than the first vocabulary has.
    partners = Window.partitionBy(F.col("pair") % width)
    return counted.select("pair", "n", (F.col("n") == F.max("n").over(partners)).alias("best"))


def digests(
    docs: DataFrame, first: str | None = None, second: str | None = None, hot_pairs: int = HOT_PAIRS, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Numbers of tokens, groups and links of every document, how its links stand in the corpus, and a digest of its groups.

    ``n_best`` counts links whose pair is, with ties, the most frequent of its second id over all rows; ``count_sum``
    adds up the pairs' numbers of links. Rows without tokens have zeros and an empty digest; repeated rows count as often as
    they occur. The ``hot_pairs`` most frequent pairs, a fixed number, are broadcast; links of other pairs are joined.
    """
    spark = docs.sparkSession
    tokenizers = read_tokenizers(first, second)
    shared = spark.sparkContext.broadcast(tokenizers)
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_proto=tokenizers.second).get_piece_size()
    links = shared_table(_links(docs, shared, id_column, text_column), "links")
    counts = shared_table(pair_counts(links, width), "pairs")
    hot = counts.orderBy(F.desc("n"), "pair").limit(hot_pairs).toArrow()
    order = np.argsort(hot.column("pair").to_numpy())
    hot_table = spark.sparkContext.broadcast((
        hot.column("pair").to_numpy()[order], hot.column("n").to_numpy()[order], hot.column("best").to_numpy()[order],
    ))
    own = [id_column, "row", "n_a", "n_b", "n_groups", "groups_sha256"]

    def look_up(batches):
        pair, number, best = hot_table.value
        for batch in batches:
            lists = batch.column(len(own))
            sizes = np.diff(lists.offsets.to_numpy())
            code, times = lists.flatten().to_numpy(), batch.column(len(own) + 1).flatten().to_numpy().astype(np.int64)
            at = np.minimum(np.searchsorted(pair, code), max(len(pair) - 1, 0))
            known = pair[at] == code if len(pair) else np.zeros(len(code), bool)
            ends = np.concatenate([[0], np.cumsum(sizes)])

            def total(values: np.ndarray, ends: np.ndarray = ends) -> pa.Array:
                sums = np.concatenate([[0], np.cumsum(values)])[ends]
                return pa.array(np.diff(sums), pa.int64())

            where = at[known]
            counted, favoured = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
            counted[known], favoured[known] = number[where] * times[known], best[where] * times[known]
            rest = np.concatenate([[0], np.cumsum(~known)])[ends].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(len(own))], total(favoured), total(counted),
                    pa.ListArray.from_arrays(pa.array(rest), pa.array(code[~known], pa.int64())),
                    pa.ListArray.from_arrays(pa.array(rest), pa.array(times[~known], pa.int64())),
                ],
                names=[*own, "n_best", "count_sum", "pairs", "times"],
            )

    fields = f"`{id_column}` long, row long, n_a long, n_b long, n_groups long, groups_sha256 string"
    found = shared_table(
        links.select(*own, "pairs", "times").mapInArrow(look_up, f"{fields}, n_best long, count_sum long, pairs array<long>, times array<long>"),
        "found",
    )
    drop_shared(links)
    rest = (
        found.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair").join(counts, "pair")
        .groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum"),
        )
    )
    return found.join(rest, "row", "left").select(
        id_column, "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256",
    )
