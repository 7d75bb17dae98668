"""Token counts by heap-and-linked-list byte-pair merging, without emitting ids.

A text's characters form a linked list. Neighbours that make up a piece of the vocabulary wait in a heap by
rank, ties from left to right; the lowest is popped and joined until none is left. A merge takes one symbol
away, so the count is the number of initial symbols less the merges. A character that is no piece counts once
for each of its UTF-8 bytes.

No piece holds a blank behind another character, or a letter beside anything else but a blank in front, so merges
never cross such borders (vocabularies that have such pieces are refused). Texts are cut there, and the counts of
short stretches are kept.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, pick, slices

#: What the vocabulary writes for a blank.
BLANK = "▁"

#: Characters of a text that are cut into stretches at a time, and the rows of a slice.
WINDOW, ROWS = 1 << 20, 256

#: Stretches of up to so many characters are kept; of two generations in a Python worker, each holds so many.
KEPT_LENGTH, KEPT = 48, 1 << 19


def stretches(figures: str) -> re.Pattern:
    """Blanks with the letters, or the other characters, behind them; ``figures`` are not taken for letters."""
    odd = re.escape(figures)
    return re.compile(rf"{BLANK}*(?:[^\W\d_{odd}]+|(?:[\d_{odd}]|[^\w{BLANK}])+)|{BLANK}+")


@dataclass(frozen=True)
class Pieces:
    """Ranks of the pieces of a vocabulary: lower is merged first."""

    ranks: dict[str, float]
    #: Characters like ² that are words to a pattern, but no letters.
    figures: str = ""
    dummy_blank: bool = True

    @cached_property
    def counter(self) -> Counter:
        """One counter for all tasks of a Python worker, with what it keeps."""
        return Counter(self)


def read_pieces(path: str | None = None) -> Pieces:
    """The pieces of a sentencepiece BPE model, read once on the driver; their number does not depend on the data.

    Only what counting by merges can express is accepted: BPE with byte fallback, no normalisation but blanks,
    no pieces that users define, no blank behind another character.
    """
    from sentencepiece import sentencepiece_model_pb2 as format

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = format.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    normal, trainer = model.normalizer_spec, model.trainer_spec
    kinds = format.ModelProto.SentencePiece
    if trainer.model_type != format.TrainerSpec.BPE or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix:
        raise ValueError("only BPE models with byte fallback and leading blanks can be counted")
    if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces:
        raise ValueError("models that normalise texts cannot be counted")
    if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
        raise ValueError("models with pieces that are defined by users or unused cannot be counted")
    ranks = {p.piece: -p.score for p in model.pieces if p.type == kinds.NORMAL}
    figures = "".join(sorted({c for p in ranks for c in p if c.isalnum() and not c.isalpha() and not c.isdecimal()}))
    border = stretches(figures)
    if any(border.fullmatch(p) is None for p in ranks):
        raise ValueError("a piece crosses a border at which texts are cut")
    return Pieces(ranks, figures, normal.add_dummy_prefix)


class Counter:
    """Counts of texts; those of short stretches are kept."""

    def __init__(self, pieces: Pieces):
        self.ranks, self.dummy = pieces.ranks, pieces.dummy_blank
        #: Characters that are pieces, and those that longer pieces hold: merges cannot cross any other.
        self.plain = frozenset(p for p in self.ranks if len(p) == 1)
        self.inner = frozenset(c for p in self.ranks if len(p) > 1 for c in p)
        self.cut = stretches(pieces.figures).findall
        self.kept, self.older = _Kept(self), {}

    def symbols(self, text: str) -> int:
        """Initial symbols: characters that are pieces, and the bytes of all others."""
        plain = self.plain
        return len(text) if plain.issuperset(text) else sum(1 if c in plain else len(c.encode()) for c in text)

    def merged(self, text: str) -> int:
        """The count of a stretch: symbols less merges."""
        get, n, count = self.ranks.get, len(text), self.symbols(text)
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := get(text[i:i + 2])) is not None]
        if not heap:
            return count
        # The list: where each symbol ends, and where the one before it begins. A symbol that is gone ends at n + 1.
        ends, before, gone = list(range(1, n + 1)), list(range(-1, n)), n + 1
        ends.append(gone)
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            _, left, end = pop(heap)
            right = ends[left]
            if right == gone or ends[right] != end:
                continue  # one of the two has been merged since
            ends[left], ends[right] = end, gone
            count -= 1
            before[end] = left
            if end < n and (rank := get(text[left:ends[end]])) is not None:
                push(heap, (rank, left, ends[end]))
            if (first := before[left]) >= 0 and (rank := get(text[first:end])) is not None:
                push(heap, (rank, first, end))
        return count

    def stretch(self, text: str) -> int:
        """The count of a stretch, cut once more at characters that no longer piece holds."""
        count, at, inner = 0, 0, self.inner
        if not inner.issuperset(text):
            for i, c in enumerate(text):
                if c not in inner:
                    count += self.merged(text[at:i]) + self.symbols(c)
                    at = i + 1
        return count + self.merged(text[at:])

    def count(self, text: str) -> int:
        """The tokens of a whole text; an empty one has none."""
        if not text:
            return 0
        return sum(self._window(part) for part in _windows((" " if self.dummy else "") + text))

    def _window(self, text: str) -> int:
        if len(self.kept) >= KEPT:
            self.older, self.kept = self.kept, _Kept(self)
        return sum(map(self.kept.__getitem__, self.cut(text.replace(" ", BLANK))))


class _Kept(dict):
    """Counts of stretches; one that is met for the first time is counted, and kept if it is short."""

    def __init__(self, counter: Counter):
        super().__init__()
        self.counter = counter

    def __missing__(self, text: str) -> int:
        counter = self.counter
        if (count := counter.older.get(text)) is None:
            count = counter.stretch(text)
        if len(text) <= KEPT_LENGTH:
            self[text] = count
        return count


def _windows(text: str) -> Iterator[str]:
    """The text in parts that end before a blank behind another character."""
    at, border = 0, re.compile(f"(?<=[^ {BLANK}])(?=[ {BLANK}])")
    while len(text) - at > WINDOW and (found := border.search(text, at + WINDOW)):
        yield text[at:found.start()]
        at = found.start()
    yield text[at:]


def counts(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """UTF-8 bytes and tokens of every row's whole text, as sentencepiece counts them for the model at ``path``.

    Null and empty texts have none of both. A text of blanks only has the tokens of its blanks and of the one put
    before it. Rows are counted one by one: repeated rows and null ids are kept, other columns are left out.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_pieces(path))

    def run(batches):
        counter = shared.value.counter
        for batch in batches:
            for part in slices(batch, ROWS):
                texts = byte_texts(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([counter.count(t.decode()) for t in texts], pa.int64())],
                    names=[id_column, "n_bytes", "n_tokens"],
                )

    rows = pick(docs, (id_column, "long"), (text_column, "string"))
    return rows.mapInArrow(run, f"`{id_column}` long, n_bytes long, n_tokens long")


def over_limit(docs: DataFrame, limit: int = 4096, path: str | None = None) -> DataFrame:
    """Counts of every document and whether its tokens exceed ``limit``."""
    return counts(docs, path).withColumn("over_limit", F.col("n_tokens") > limit)
