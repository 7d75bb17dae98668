"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The corpus's frequent words are compiled into a minimal acyclic automaton over bytes: words are added in
sorted order and equal suffix states are shared. Arcs carry numbers that add up to a word's place in the
lexicon, which leads to its ids. The arrays are stored in one file that each Python worker maps into
memory; all distinct words of a batch walk through it side by side. Words the lexicon does not hold are
merged by rank, exactly.
"""

from __future__ import annotations

import heapq
import itertools
import json
import mmap
import re
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import IdRuns, Numbered, byte_texts, pick, ragged, slices

#: Words in the lexicon; its size on disk and in the broadcast is bounded by this and LONGEST_WORD.
LEXICON_WORDS = 100_000
LONGEST_WORD = 64

#: A worker keeps the ids of about so many chunks between white space, none of them longer than this.
KNOWN_CHUNKS, LONGEST_CHUNK = 500_000, 256

#: A worker counts so many distinct chunks before it hands them on.
COUNTED_CHUNKS = 200_000

_NEVER = 1 << 62

#: Fixed by the vocabulary: how a text is cut into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: The same with the white space spelt out, for texts of letters that all versions of Unicode class alike ...
_BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = regex.compile(rf"\n|'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_BLANK}\p{{L}}\p{{N}}]+")
BLANKS = re.compile(f"[{_BLANK}]+")
ASCII_WORDS = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
#: ... and what is not among them; such texts are cut by the tokenizer library's own tables.
UNSETTLED = re.compile("[^\x00-\u0557\u2010-\u2027\u202f-\u205e\u20a0-\u20bf\u2100-\u23ff\u2500-\u27ff\u3000-\u3096"
                       "\u30a0-\u30ff\u4e00-\u9fef\uac00-\ud7a3\uff01-\uffbe\U0001f300-\U0001f6d2]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself where it prints, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, further = {b: chr(b) for b in plain}, itertools.count(256)
    return [letters[b] if b in letters else chr(next(further)) for b in range(256)]


class Vocabulary:
    """Merge ranks and token texts of a vocabulary file, reduced to what encoding needs."""

    def __init__(self, source: str):
        data = json.loads(source)
        model = data["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.start = [vocab[c] for c in letters]
        self.last = [vocab[c + end] for c in letters]
        # Both sides of a pair in one number; its rank above the id it becomes in another, so that the least is due.
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a] << 20 | vocab[b]] = rank << 20 | vocab[a + b]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        texts = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.tokens = [texts.get(i, "") for i in range(max(texts) + 1)]
        self._foreign = None
        self.specials = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) or r"(?!)")

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word: of all mergeable neighbours the pair of the lowest rank, leftmost first, until none is left."""
        ids = [self.start[b] for b in word[:-1]] + [self.last[word[-1]]]
        if len(ids) > LONGEST_WORD:
            return self._merge_long(ids)
        get = self.merges.get
        due = [get(a << 20 | b, _NEVER) for a, b in zip(ids, ids[1:], strict=False)]
        while due:
            best = min(due)
            if best == _NEVER:
                break
            i, new = due.index(best), best & 0xFFFFF
            ids[i] = new
            del ids[i + 1], due[i]
            if i:
                due[i - 1] = get(ids[i - 1] << 20 | new, _NEVER)
            if i < len(due):
                due[i] = get(new << 20 | ids[i + 1], _NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a queue, so that a word of any length takes no more than a sort."""
        n, get = len(ids), self.merges.get
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [
            (found >> 20, i, found & 0xFFFFF, ids[i], ids[i + 1])
            for i in range(n - 1) if (found := get(ids[i] << 20 | ids[i + 1])) is not None
        ]
        heapq.heapify(queue)
        while queue:
            _, i, new, a, b = heapq.heappop(queue)
            j = right[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for first in (i, left[i]):
                second = right[first] if first >= 0 else n
                if second < n and (found := get(ids[first] << 20 | ids[second])) is not None:
                    heapq.heappush(queue, (found >> 20, first, found & 0xFFFFF, ids[first], ids[second]))
        return [x for x in ids if x >= 0]

    def words(self, chunks: Sequence[str]) -> tuple[list[str], list[int]]:
        """The normalised words of chunks without white space, and how many each has.

        Chunks of letters that are classed alike everywhere are cut together, parted by line feeds.
        """
        plain, settled, found = [], [], {}
        for chunk in chunks:
            if chunk.isascii():
                plain.append(chunk)
            elif UNSETTLED.search(chunk):
                found[chunk] = self._foreign_words(chunk)
            else:
                settled.append(chunk)
        for own, pattern in ((plain, ASCII_WORDS), (settled, WORDS)):
            text = "\n".join(own)
            if own is settled:
                if not unicodedata.is_normalized("NFC", text):
                    text = unicodedata.normalize("NFC", text)
                # The final form of sigma depends on its place in str.lower(); here each letter is taken by itself.
                text = text.replace("Σ", "σ")
            ended, each = pattern.findall(text.lower()), iter(own)
            at = 0
            ended.append("\n")
            for chunk in each:
                end = ended.index("\n", at)
                found[chunk] = ended[at:end]
                at = end + 1
        lists = [found[chunk] for chunk in chunks]
        return list(itertools.chain.from_iterable(lists)), [len(x) for x in lists]

    def _foreign_words(self, stretch: str) -> list[str]:
        if self._foreign is None:
            from tokenizers import Regex, normalizers, pre_tokenizers

            self._foreign = (
                normalizers.Sequence([normalizers.NFC(), normalizers.Replace(Regex(r"\s+"), " "), normalizers.Lowercase()]),
                pre_tokenizers.Split(Regex(PATTERN), "removed", invert=True),
            )
        normal, split = self._foreign
        return [word for word, _ in split.pre_tokenize_str(normal.normalize_str(stretch))]

    def chunks(self, text: str) -> list[str | int]:
        """The text between white space, and the ids of special tokens. No word crosses white space, so whatever
        is done to words can be done to distinct chunks."""
        if not self.special or not self.specials.search(text):
            return self._split(text)
        out, at = [], 0
        for found in self.specials.finditer(text):
            out += [*self._split(text[at:found.start()]), self.special[found[0]]]
            at = found.end()
        return out + self._split(text[at:])

    @staticmethod
    def _split(text: str) -> list[str]:
        # str.split() would also split at these four, which are no white space to the tokenizer.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [c for c in BLANKS.split(text) if c]
        return text.split()


def compile_lexicon(entries: Iterable[tuple[bytes, Sequence[int]]]) -> bytes:
    """The transducer of distinct words with their ids, packed for mapping.

    States are numbered in the order of their registration. A state's arcs lie together, sorted by byte; the
    number on an arc is how many words of the state come before it.
    """
    entries = sorted(entries)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    # The path of the last word: for each depth whether a word ends there and the arcs so far.
    path: list[list] = [[False, []]]

    def freeze(depth: int) -> None:
        while len(path) - 1 > depth:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            path[-1][1][-1] = (path[-1][1][-1][0], register[key])

    before = b""
    for word, _ in entries:
        common = 0
        while common < min(len(word), len(before)) and word[common] == before[common]:
            common += 1
        freeze(common)
        for byte in word[common:]:
            path[-1][1].append((byte, -1))
            path.append([False, []])
        path[-1][0] = True
        before = word
    freeze(0)
    root = len(states)
    states.append((path[0][0], tuple(path[0][1])))

    counts: list[int] = []
    keys, targets, numbers = [], [], []
    for state, (final, arcs) in enumerate(states):
        total = int(final)
        for byte, to in arcs:
            keys.append(state << 8 | byte)
            targets.append(to)
            numbers.append(total)
            total += counts[to]
        counts.append(total)
    offsets = np.zeros(len(entries) + 1, np.int64)
    np.cumsum([len(ids) for _, ids in entries], out=offsets[1:])
    return b"".join([
        np.array([root, len(states), len(keys), len(entries)], np.int64).tobytes(), np.array(keys, np.int64).tobytes(),
        offsets.tobytes(), np.array(targets, np.int32).tobytes(), np.array(numbers, np.int32).tobytes(),
        np.array([i for _, ids in entries for i in ids], np.int32).tobytes(),
        np.array([f for f, _ in states], np.uint8).tobytes(),
    ])


class Lexicon:
    """The packed transducer, mapped from a file of the worker's own that is gone with the worker."""

    def __init__(self, packed: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(packed)
            file.flush()
            self._map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        self.root, n_states, n_arcs, n_words = (int(x) for x in np.frombuffer(self._map, np.int64, 4))
        at = 32
        self.keys = np.frombuffer(self._map, np.int64, n_arcs, at)
        at += 8 * n_arcs
        self.offsets = np.frombuffer(self._map, np.int64, n_words + 1, at)
        at += 8 * (n_words + 1)
        self.targets = np.frombuffer(self._map, np.int32, n_arcs, at)
        at += 4 * n_arcs
        self.numbers = np.frombuffer(self._map, np.int32, n_arcs, at)
        at += 4 * n_arcs
        n_ids = int(self.offsets[-1])
        self.ids = np.frombuffer(self._map, np.int32, n_ids, at)
        self.final = np.frombuffer(self._map, np.uint8, n_states, at + 4 * n_ids)

    def find(self, words: Sequence[bytes]) -> np.ndarray:
        """The place of each word in the lexicon, or -1. All words take their n-th arc together."""
        places = np.full(len(words), -1, np.int64)
        lengths = np.array([len(w) for w in words], np.int64)
        if not len(self.keys) or not len(words):
            return places
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        alive = np.nonzero((lengths > 0) & (lengths <= LONGEST_WORD))[0]
        state = np.full(len(alive), self.root, np.int64)
        number = np.zeros(len(alive), np.int64)
        step = 0
        while len(alive):
            ended = lengths[alive] == step
            done = ended & (self.final[state] > 0)
            places[alive[done]] = number[done]
            alive, state, number = alive[~ended], state[~ended], number[~ended]
            if not len(alive):
                break
            key = state << 8 | data[starts[alive] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[arc] == key
            arc, alive, number = arc[there], alive[there], number[there]
            state, number = self.targets[arc].astype(np.int64), number + self.numbers[arc]
            step += 1
        return places

    def entry(self, place: int) -> list[int]:
        return self.ids[self.offsets[place]:self.offsets[place + 1]].tolist()

    def entries(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words in a row, and how many each has."""
        sizes = self.offsets[places + 1] - self.offsets[places]
        return self.ids[ragged(self.offsets[places], sizes)], sizes


class Codec:
    """Encoding by the lexicon and exact merging, decoding by token texts."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.tokens = pa.array(vocabulary.tokens, pa.string())
        self.runs = IdRuns()
        self._forget()

    def _forget(self) -> None:
        """Start with the special tokens, which are chunks of their own."""
        self.known = Numbered()
        self.runs.clear()
        own = sorted(set(self.vocabulary.special.values()))
        self.known.of(own)
        self.known.new.clear()
        self.runs.add(np.array(own, np.int64), np.ones(len(own), np.int64))

    def learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks in a row, and how many each has."""
        words, words_of = self.vocabulary.words(chunks)
        numbers = Numbered()
        place = numbers.of(words)
        keys = [w.encode() for w in numbers.new]
        found = self.lexicon.find(keys)
        there = found >= 0
        ids, sizes = self.lexicon.entries(found[there])
        merged = [self.vocabulary.merge(k) for k, known in zip(keys, there.tolist(), strict=True) if not known]
        sizes_of = np.empty(len(keys), np.int64)
        sizes_of[there], sizes_of[~there] = sizes, [len(m) for m in merged]
        flat = np.concatenate([ids, np.fromiter(itertools.chain.from_iterable(merged), np.int64)])
        starts = np.empty(len(keys), np.int64)
        order = np.concatenate([np.flatnonzero(there), np.flatnonzero(~there)])
        starts[order] = np.cumsum(sizes_of[order]) - sizes_of[order]
        tokens = flat[ragged(starts[place], sizes_of[place])]
        before = np.concatenate([[0], np.cumsum(sizes_of[place])])[np.concatenate([[0], np.cumsum(words_of, dtype=np.int64)])]
        return tokens, np.diff(before)

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts in a row, and how many each has. Chunks met for the first time are learned together; all are
        forgotten before they become too many."""
        if len(self.known) > KNOWN_CHUNKS:
            self._forget()
        cut = [self.vocabulary.chunks(t) for t in texts]
        places = self.known.of(list(itertools.chain.from_iterable(cut)))
        new, self.known.new = self.known.new, []
        for at in range(0, len(new), 1 << 16):
            self.runs.add(*self.learn(new[at:at + (1 << 16)]))
        ids, sizes = self.runs.of(places)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum([len(c) for c in cut], dtype=np.int64)])]
        if any(len(c) > LONGEST_CHUNK for c in new):
            self._forget()
        return ids, np.diff(ends)

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Token texts joined by blanks: what the vocabulary defines, as it names no decoder."""
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, self.tokens.take(ids.values)), " ")


def read_vocabulary(path: str | None = None) -> str:
    """The vocabulary file's content, read once on the driver; its size does not depend on the data."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


def frequent_words(docs: DataFrame, vocabulary: str, words: int = LEXICON_WORDS, text_column: str = "text") -> list[str]:
    """The most frequent words of all texts, ties in alphabetical order.

    Distinct chunks between white space are counted first, then cut into words.
    """
    def count(batches):
        known, totals = Vocabulary(vocabulary), Counter()

        def chunks():
            part = pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64())], names=["chunk", "n"])
            totals.clear()
            return part

        for batch in batches:
            for part in slices(batch):
                for text in byte_texts(part.column(0)):
                    totals.update(c for c in known.chunks(text.decode()) if isinstance(c, str))
                if len(totals) >= COUNTED_CHUNKS:
                    yield chunks()
        yield chunks()

    def cut(batches):
        known = Vocabulary(vocabulary)
        for batch in batches:
            totals: dict[str, int] = {}
            chunks, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            found, words_of = known.words(chunks)
            for word, k in zip(found, np.repeat(n, words_of).tolist(), strict=True):
                totals[word] = totals.get(word, 0) + k
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64())], names=["word", "n"],
            )

    chunks = pick(docs, (text_column, "string")).mapInArrow(count, "chunk string, n long")
    counted = (
        chunks.groupBy("chunk").agg(F.sum("n").alias("n")).mapInArrow(cut, "word string, n long")
        .where(F.octet_length("word") <= LONGEST_WORD).groupBy("word").agg(F.sum("n").alias("n"))
    )
    return counted.orderBy(F.desc("n"), "word").limit(words).select("word").toArrow().column(0).to_pylist()


@dataclass
class Shared:
    """Vocabulary and lexicon as they are broadcast."""

    vocabulary: str
    lexicon: bytes

    @cached_property
    def codec(self) -> Codec:
        """One codec for all tasks of a Python worker."""
        return Codec(Vocabulary(self.vocabulary), Lexicon(self.lexicon))


def encode(
    docs: DataFrame, path: str | None = None, lexicon_words: int = LEXICON_WORDS, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Each row's id, its ids and the text they decode to.

    Whole texts are encoded; null and empty texts, and texts of blanks, have no ids and decode to "". Rows are
    encoded one by one: repeated rows and null row ids are kept. Other columns are left out.
    """
    source = read_vocabulary(path)
    known = Vocabulary(source)
    lexicon = compile_lexicon(
        (w.encode(), known.merge(w.encode())) for w in frequent_words(docs, source, lexicon_words, text_column)
    )
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(Shared(source, lexicon))

    def run(batches):
        codec = shared.value.codec
        for batch in batches:
            for part in slices(batch, 1024, 2 << 20):
                ids, sizes = codec.encode([t.decode() for t in byte_texts(part.column(1))])
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists, codec.decode(lists)], names=[id_column, "ids", "decoded"],
                )

    rows = pick(docs, (id_column, "long"), (text_column, "string"))
    return rows.mapInArrow(run, f"`{id_column}` long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str | None = None, *more: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document, and further columns of ``encode``."""
    return encode(docs, path).select(
        "doc_id", *more, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
