"""Token counts, alignment and fill-in-middle against the tokenizers' libraries, plain loops and exact round trips."""

import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from capledger.llm import align, fill_middle, token_counts
from tests.compare import connect, difference

ROOT = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, Text string, n_tokens string, row long, pairs string"
LETTERS = " " * 8 + "\n\t▁abcdefghtheion,.()=<>/éèç日本😀\x00​\x1c\x85　᠎²½_٣क् 's12"
ODD = [
    "", None, " ", "   ", "a", " a", "a ", "▁", "a▁b", "<s>hi</s> <|endoftext|> <unk>", "\n\n", "<0x0A>", "x" * 3000, " " * 900,
    "a" + " " * 70 + "b", "a\n b \n c", "it's 'tis don't we'll", "²." * 9, "​ ᠎ a", "é é ÅÅ",
]


def texts(n=1500):
    rng = random.Random(5)
    return ODD + ["".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 60))) for _ in range(n)]


def docs_of(spark, values):
    rows = [(i, t, "other", "x", 0, "y") for i, t in enumerate(values)]
    return spark.createDataFrame([*rows, rows[-1], (None, values[-1], None, None, None, None)], DOCS)


@pytest.fixture(scope="module")
def pieces():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def bytewise():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def corpus(con):
    return [t for (t,) in con.execute("SELECT text FROM documents ORDER BY doc_id").fetchall()]


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(ROOT):
        pytest.skip("benchmark tables not present")
    return connect(ROOT)


# ------------------------------------------------------------------ 11 counts

def test_counts_agree_with_the_library(spark, con, pieces):
    values = texts() + corpus(con)
    got = token_counts.over_limit(docs_of(spark, values), 50).collect()
    assert len(got) == len(values) + 2
    for r in got:
        text = (values[-1] if r.doc_id is None else values[r.doc_id]) or ""
        want = len(pieces.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), want, want > 50), text[:80]
    assert token_counts.counts(docs_of(spark, ["a"]).limit(0)).count() == 0


def test_counts_do_not_depend_on_windows_or_on_what_is_kept(con, pieces, monkeypatch):
    monkeypatch.setattr(token_counts, "WINDOW", 40)
    monkeypatch.setattr(token_counts, "KEPT", 30)
    counter = token_counts.Counter(token_counts.read_pieces())
    for text in [t for t in texts() if t] + [" a b" * 500]:
        assert counter.count(text) == len(pieces.encode(text))


def test_ties_are_merged_from_the_left():
    counter = token_counts.Counter(token_counts.Pieces({"a": 9.0, "aa": 1.0, "aaa": 1.0, "b": 9.0, "ba": 1.0}, dummy_blank=False))
    # aaa -> (aa)a -> aaa; baa -> (ba)a, as the pair further left is first; four bytes for a character that is no piece
    assert [counter.count(t) for t in ("aaa", "baa", "aaaa", "a😀b")] == [1, 2, 2, 6]


def test_vocabularies_with_pieces_across_borders_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as format

    model = format.ModelProto()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model.ParseFromString(file.read())
    for piece in ("a▁", "a.b"):
        model.pieces[500].piece = piece
        (tmp_path / "m").write_bytes(model.SerializeToString())
        with pytest.raises(ValueError, match="border"):
            token_counts.read_pieces(str(tmp_path / "m"))


# ------------------------------------------------------------------ 12 alignment

def plain_alignment(text, bytewise, pieces, tokens):
    """Ids and the token counts up to each common end, by sets of offsets."""
    if not text:
        return [], [], [], []
    a, b = bytewise.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
    parts = [[tokens[0][i] for i in a], [tokens[1][i] for i in b]]
    if any(b"".join(p) != (" " + text).encode() for p in parts):
        return [], [], [], []
    ends = [np.cumsum([len(t) for t in p]).tolist() for p in parts]
    common = sorted(set(ends[0]) & set(ends[1]))
    return a, b, [ends[0].index(e) + 1 for e in common], [ends[1].index(e) + 1 for e in common]


@pytest.fixture(scope="module")
def tokens(bytewise, pieces):
    from tokenizers import decoders

    letters = {}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    vocab = {i: bytes(letters[c] for c in t) for t, i in bytewise.get_vocab(with_added_tokens=False).items()}
    assert decoders.ByteLevel().decode([bytewise.id_to_token(1000)]).encode() == vocab[1000]
    second = [
        bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()
        for i in range(len(pieces))
    ]
    return vocab, second


def test_alignment_agrees_with_sets_of_offsets(spark, con, bytewise, pieces, tokens):
    values = texts() + corpus(con)
    got = align.align(docs_of(spark, values)).collect()
    assert len(got) == len(values) + 2
    for r in got:
        text = values[-1] if r.doc_id is None else values[r.doc_id]
        assert (r.a_ids, r.b_ids, r.a_cuts, r.b_cuts) == plain_alignment(text, bytewise, pieces, tokens), (text or "")[:80]
    assert align.align(docs_of(spark, ["a"]).limit(0)).count() == 0


def test_alignment_does_not_depend_on_windows_and_lanes(con, bytewise, pieces, tokens, monkeypatch):
    monkeypatch.setattr(align, "WINDOW", 60)
    monkeypatch.setattr(align, "LANE", 2)
    monkeypatch.setattr(align, "KEPT", 50)
    known = align.Stretches(align.read_tokenizers())
    values = [t or "" for t in texts(500) + corpus(con)[:40]]
    for text, own in zip(values, align.aligned(known, values), strict=True):
        a, b, a_cuts, b_cuts = plain_alignment(text, bytewise, pieces, tokens)
        assert [i for p in own for i in p.a.tolist()] == a and [i for p in own for i in p.b.tolist()] == b
        assert sum(len(p.a_cuts) for p in own) == len(a_cuts) and sum(len(p.b_cuts) for p in own) == len(b_cuts)


@pytest.mark.parametrize("hot", [0, 40, 1 << 17])
def test_corpus_counts_of_links(spark, con, bytewise, pieces, tokens, hot):
    values = texts(200) + corpus(con)[:60]
    rows = [*enumerate(values), (len(values) - 1, values[-1]), (None, values[-1])]
    links, want = Counter(), []
    for row, text in rows:
        a, b, a_cuts, b_cuts = plain_alignment(text, bytewise, pieces, tokens)
        own = [(a[x - 1], b[y - 1]) for x, y in zip(a_cuts, b_cuts, strict=True)]
        groups = ";".join(
            ",".join(map(str, a[p:q])) + "|" + ",".join(map(str, b[r:s]))
            for p, q, r, s in zip([0, *a_cuts], a_cuts, [0, *b_cuts], b_cuts, strict=False)
        )
        links.update(own)
        want.append((row, len(a), len(b), own, hashlib.sha256(groups.encode()).hexdigest() if a else ""))
    best = defaultdict(int)
    for (_, y), n in links.items():
        best[y] = max(best[y], n)
    want = Counter(
        (row, n_a, n_b, len(own), len(own), sum(links[p] == best[p[1]] for p in own), sum(links[p] for p in own), digest)
        for row, n_a, n_b, own, digest in want
    )
    assert Counter(tuple(r) for r in align.digests(docs_of(spark, values), hot_pairs=hot).collect()) == want
    assert align.digests(docs_of(spark, ["a"]).limit(0)).count() == 0


# ------------------------------------------------------------------ 13 fill-in-middle

@pytest.mark.parametrize("kind, offsets", [
    ("Values", [1, 5, 9, 70]), ("Runs", list(range(100, 9000))), ("Bitmap", list(range(0, 40000, 3))),
    ("Values", [3, 65535, 65536, 65537, 200000, 1 << 30]), ("Runs", list(range(60000, 140000))),
    ("Bitmap", sorted(random.Random(1).sample(range(300000), 90000))),
])
def test_boundary_sets_select_every_offset(kind, offsets):
    found = fill_middle.Boundaries(np.array(offsets, np.int64))
    assert kind in {type(c).__name__ for c in found.containers}
    assert [found.select(k) for k in range(0, len(offsets), max(1, len(offsets) // 3000))] == offsets[::max(1, len(offsets) // 3000)]
    assert found.select(len(offsets) - 1) == offsets[-1]


def plain_fill(row, text, settings):
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{settings.seed}:{'' if row is None else row}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    low, high = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= settings.transformed:
        return len(lines), "plain", None, None, text
    a, b, c = "".join(lines[:low]), "".join(lines[low:high]), "".join(lines[high:])
    form, output = ("spm", f"<S>{c}<P>{a}<M>{b}") if h[3] % 100 < settings.suffix_first else ("psm", f"<P>{a}<S>{c}<M>{b}")
    return len(lines), form, len(a), len(b), output


@pytest.mark.parametrize("settings", [fill_middle.Settings(), fill_middle.Settings(transformed=40, suffix_first=90, seed=3)])
def test_fill_middle_agrees_with_plain_cuts_and_comes_back(spark, con, settings):
    values = texts(300) + corpus(con) + [
        "\n" * 5000, "".join("x" * (i % 7) + "\n" for i in range(60000)), "a\n" * 40 + "<M>", "\r\n\r\nx\x0b y", "<", "<P", "é\nü\n😀",
    ]
    rows = fill_middle.transform(docs_of(spark, values), settings)
    rows = rows.withColumn("restored", fill_middle.restored(rows.output, rows.form, settings)).collect()
    assert len(rows) == len(values) + 2
    for r in rows:
        text = (values[-1] if r.doc_id is None else values[r.doc_id]) or ""
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_fill(r.doc_id, text, settings)
        assert r.restored == text
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert fill_middle.digests(docs_of(spark, ["a"]).limit(0)).count() == 0


def test_fill_middle_agrees_with_sql(spark, con):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    assert difference(fill_middle.digests(docs), con, fill_middle.DIGESTS_SQL) is None
