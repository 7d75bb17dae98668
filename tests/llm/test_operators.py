"""Each operator against a brute-force version, with nulls, empty and repeated rows, and clashing columns."""

import base64
import gzip
import hashlib
import os
import random
import re
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from capledger.llm import bit_codes, bpe, grid_join, licenses, minhash, mixing, quality, secrets, url_filter, warc
from capledger.llm.automata import compile_all
from capledger.llm.common import components

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DOCS = "doc_id long, text string, Text string, n_tokens string"


def docs_of(spark, texts):
    """Rows with repeated and null ids, and columns that clash with results."""
    rows = [(i, t, "other", "x") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[0], (None, texts[0], None, None)], DOCS)


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 9), (9, 3), (20, 21), (7, 7)] + [(100, k) for k in range(101, 160)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**dict.fromkeys((3, 4, 5, 9), 3), 20: 20, 21: 20, **dict.fromkeys(range(100, 160), 100)}
    assert components(edges.limit(0)).count() == 0


def test_a_run_leaves_one_folder_that_can_be_removed(tmp_path):
    """In a session of its own, as others may still read what this one would remove."""
    code = """
import os, sys
from capledger.session import build_session
from capledger.llm import common, warc
spark = build_session("run", master="local[1]", spark__checkpoint__dir=sys.argv[1], spark__ui__enabled="false")
pages = spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string")
assert warc.round_trip(pages).count() == 1
assert len(os.listdir(sys.argv[1])) <= 2 and os.path.isdir(common.run_folder(spark))
common.remove_run(spark)
assert not os.path.exists(common.run_folder(spark))
print("removed")
"""
    done = subprocess.run([sys.executable, "-c", code, str(tmp_path)], capture_output=True, text=True, timeout=300, cwd=ROOT)
    assert "removed" in done.stdout, done.stderr[-2000:]


# ------------------------------------------------------------------ 1 BPE

BPE_TEXTS = [
    "Hello WORLD, it's 1999!  Don't", "", None, " \n\t", "a" * 500 + " b", "Ünïcode é ΑΣ Σ İ ß 日本語 😀​",
    "x<|endoftext|>y <|startoftext|>", "a\x1cb\x1f 'tis \x85　z", "՘࢏ ok", "hello " * 3000, "''' !'s ''s",
]


def test_bpe_agrees_with_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    got = {r.doc_id: r for r in bpe.encode(docs_of(spark, BPE_TEXTS), lexicon_words=20).collect() if r.doc_id is not None}
    for i, text in enumerate(BPE_TEXTS):
        want = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert list(got[i].ids) == want, text
        assert got[i].decoded == tokenizer.decode(want, skip_special_tokens=False)
    assert bpe.digests(docs_of(spark, BPE_TEXTS)).count() == len(BPE_TEXTS) + 2
    assert bpe.digests(docs_of(spark, BPE_TEXTS).limit(0)).count() == 0


def test_lexicon_finds_what_it_holds_and_shares_suffixes():
    words = [b"singing", b"ringing", b"ring", b"sing", b"zing", "ü".encode()]
    lexicon = bpe.Lexicon(bpe.compile_lexicon((w, [i, i + 1]) for i, w in enumerate(words)))
    places = lexicon.find([*words, b"rin", b"ringings", b"", b"q" * 100]).tolist()
    assert [lexicon.entry(p) for p in places[:6]] == [[i, i + 1] for i in range(6)]
    assert places[6:] == [-1] * 4
    assert len(lexicon.final) < sum(map(len, words))
    assert bpe.Lexicon(bpe.compile_lexicon([])).find([b"a"]).tolist() == [-1]


# ------------------------------------------------------------------ 2, 4 vectors

def vectors_of(spark, seed=1, n=400, width=16):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, width)).astype(np.float32)
    base[50:120] = base[0] + rng.standard_normal((70, width)).astype(np.float32) * rng.choice([0.001, 0.05, 0.3], (70, 1)).astype(np.float32)
    base[120:140] = base[7]
    rows = [(i, [float(x) for x in v], None if i == 60 else i % 3 if i >= 120 else 0, "x") for i, v in enumerate(base)]
    odd = [
        (1000, None, 0, ""), (1001, [0.0] * width, 0, ""), (1002, [float("nan")] * width, 0, ""), (1003, [None] * width, 0, ""),
        (1004, [1.0, 2.0], 0, ""), (1005, [1.0, 2.0], 0, ""), (1006, [], 0, ""), (None, [1.0] * width, 0, ""),
    ]
    return rows + odd, spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int, rank string")


def test_grid_join_agrees_with_all_pairs(spark):
    rows, df = vectors_of(spark)
    settings = grid_join.Settings(cosine=0.98, block_rows=8, fan=3)
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in grid_join.near_duplicates(df, settings).collect()}
    vectors = {i: np.array(v, np.float64) for i, v, label, _ in rows if i is not None and label is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    vectors = {i: np.array(np.array(v, np.float32), np.float64) for i, v in vectors.items()}
    label = {i: x for i, _, x, _ in rows}
    parent = {i: i for i, *_ in rows}
    links = dict.fromkeys(parent, 0)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, v in vectors.items():
        for j, w in vectors.items():
            if i < j and label[i] == label[j] and len(v) == len(w) and v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= 0.98:
                links[i], links[j] = links[i] + 1, links[j] + 1
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    want = {(i, links[i], root(i), root(i) == i) for i in parent if i is not None} | {(None, 0, None, True)}
    assert got == want
    assert grid_join.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("scale", [1.0, 1e160, 1e-170, 5e-324 * 2**30])
def test_grid_join_links_at_any_scale(spark, scale):
    rng = np.random.default_rng(2)
    base = rng.integers(-9, 10, (12, 8)).astype(np.float64)
    near = base.copy()
    near[:6] *= 4.0  # the same direction
    rows = [(i, (v * scale).tolist(), 1) for i, v in enumerate(np.concatenate([base, near]))] + [(3, (base[3] * scale).tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = [(r.vec_id, r.n_links, r.component_id) for r in grid_join.near_duplicates(df).collect()]
    assert sorted(got) == sorted([(i, 2 if i % 12 == 3 else 1, i % 12) for i in range(24)] + [(3, 2, 3)])


def test_grid_join_links_at_exactly_the_threshold(spark):
    # cosines 0.98, as doubles give it, and one step below
    vectors = [[1.0, 0.0], [0.98, np.sqrt(1 - 0.98**2)], [0.0, 1.0]]
    exact = lambda a, b: np.dot(a, b) / np.sqrt(np.dot(a, a)) / np.sqrt(np.dot(b, b))
    want = exact(np.array(vectors[0]), np.array(vectors[1])) >= 0.98
    df = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    assert {r.vec_id: r.n_links for r in grid_join.near_duplicates(df).collect()} == {0: int(want), 1: int(want), 2: 0}


def test_bit_codes_find_the_nearest(spark):
    rows, df = vectors_of(spark, n=600, width=32)
    found = bit_codes.search(df, lambda i: i % 20 == 0, bit_codes.Settings(query_rows=16, code_rows=64, groups=3)).collect()
    vectors = {i: np.array(np.array(v, np.float32), np.float64) for i, v, *_ in rows if i is not None and i < 1000}
    hits = 0
    for query in range(0, 600, 20):
        scores = sorted((-float(v @ vectors[query]), i) for i, v in vectors.items() if i != query)[:20]
        own = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == query)
        assert [r for r, *_ in own] == list(range(1, 21))
        assert own == sorted(own, key=lambda r: (-r[2], r[1]))
        hits += len({i for _, i in scores} & {i for _, i, _ in own})
    assert hits / 600 >= 0.95
    again = df.union(df.where("vec_id % 3 = 0"))  # repeated rows count as one
    settings = bit_codes.Settings(query_rows=16, code_rows=64, groups=3, group_tiles=2)
    key = lambda r: (r.query_id, r.rank)
    repeated = sorted(bit_codes.search(again, lambda i: i % 20 == 0, settings).collect(), key=key)
    assert [(r.query_id, r.rank, r.score) for r in repeated] == [(r.query_id, r.rank, r.score) for r in sorted(found, key=key)]
    assert bit_codes.search(df.limit(0), lambda i: i % 20 == 0).count() == 0


# ------------------------------------------------------------------ 3 mixing

def test_mixing_fills_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame(
        [("a", "en", "s1", 10), ("a", "en", "s2", 1000), ("a", "de", "s1", 1000), ("b", "en", "s3", 50)],
        "domain string, lang string, source string, available long",
    )
    got = {(r.domain, r.lang, r.source): r.budget for r in mixing.budgets(leaves, mixing.Settings(tokens=400)).collect()}
    # b lacks 150 of its 200, which go to a; inside a both languages get 175, and s2 takes what s1 lacks.
    assert got == {("a", "en", "s1"): 10, ("a", "en", "s2"): 165, ("a", "de", "s1"): 175, ("b", "en", "s3"): 50}


def test_names_that_are_not_listed_share_by_their_own_weight(spark):
    leaves = spark.createDataFrame([("d", la, "s", 1000) for la in ("en", "de", "it", mixing.NONE)], "domain string, lang string, source string, available long")
    settings = mixing.Settings(language_weights={"en": 0.6, "de": 0.2}, other_language_weight=0.1, tokens=1000)
    assert {r.lang: r.budget for r in mixing.budgets(leaves, settings).collect()} == {"en": 600, "de": 200, "it": 100, mixing.NONE: 100}
    rows = spark.createDataFrame([(7, "en", "s", "a b"), (7, "en", "s", "c d e"), (8, "en", "s", "f")], "doc_id long, lang string, source string, text string")
    for share in (0.2, 0.5, 0.9, 1.0):  # rows with equal ids are taken together or not at all
        kept = sorted(r.doc_id for r in mixing.mix(rows, mixing.Settings(share=share)).collect())
        assert kept in ([], [8], [7, 7], [7, 7, 8]) and sum({7: 2.5, 8: 1}[i] for i in kept) <= 6 * share


def test_mixing_takes_the_longest_prefix(spark):
    random.seed(3)
    rows = [(i, "w " * random.randint(0, 30), random.choice(["en", None]), random.choice(["x", "y"]), 1) for i in range(500)]
    df = spark.createDataFrame([*rows, (None, None, "en", "x", 1)], "doc_id long, text string, lang string, source string, domain int")
    settings = mixing.Settings(share=0.6, seed=5)
    kept = {r.doc_id for r in mixing.mix(df, settings).collect()}
    budgets = {(r.lang, r.source): r.budget for r in mixing.budgets(
        mixing._with_leaf(df, settings, "doc_id", "lang", "source").withColumn("t", mixing.tokens_of(F.col("text")))
        .groupBy(*mixing.LEAF).agg(F.sum("t").alias("available")), settings).collect()}
    order = {r.doc_id: r.h for r in df.select("doc_id", F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit(5).cast("long")).alias("h")).collect()}
    for (lang, source), budget in budgets.items():
        own = sorted((order[i], i or -1, len((t or "").split()), i) for i, t, la, s, _ in [*rows, (None, None, "en", "x", 1)] if (la or mixing.NONE, s) == (lang, source))
        used, want = 0, set()
        for _, _, n, i in own:
            if used + n > budget:
                break
            used += n
            want.add(i)
        assert {i for *_, i in own if i in kept} == want
    twice = mixing.mix(df, mixing.Settings(share=2.0, max_epochs=2)).count()
    assert twice >= 2 * len(rows) - 2
    assert mixing.mix(df.limit(0), settings).count() == 0


# ------------------------------------------------------------------ 5 MinHash

def shingle_set(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*[words[k:] for k in range(width)], strict=False))


@pytest.mark.parametrize("width", [2, 5])
def test_minhash_agrees_with_all_pairs(spark, width):
    random.seed(4)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = ["", None, " \t", "One", "one", "a b", "A  B"]
    for _ in range(25):
        base = random.choices(vocabulary, k=random.randint(20, 200))
        texts.append(" ".join(base))
        for _ in range(6):
            copy = [random.choice(vocabulary) if random.random() < random.choice([0, 0.01, 0.04, 0.1]) else w for w in base]
            texts.append(" ".join(copy))
    got = by_id(minhash.near_duplicates(docs_of(spark, texts), minhash.Settings(words=width)), "n_shingles", "component_id", "kept")
    sets = [shingle_set(t, width) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    for i in range(len(texts)):
        assert got[i] == (len(sets[i]), root(i), root(i) == i), texts[i]
    assert got[None][1:] == (None, True)
    kept = [r.doc_id for r in minhash.keep_one(docs_of(spark, texts), minhash.Settings(words=width)).collect()]
    assert sorted(kept, key=str) == sorted([*[i for i in range(len(texts)) if root(i) == i], None], key=str)
    assert minhash.near_duplicates(docs_of(spark, texts).limit(0)).count() == 0


# ------------------------------------------------------------------ 6 WARC

def test_warc_round_trip(spark, tmp_path):
    htmls = [
        "<p>x</p>", "<p>x</p>", None, "", "y" * 100_000, "head\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc" * 50,
        "ü" * 40_000, "y" * 100_000, "\r\nWARC/1.1\r\n",
    ]
    rows = [(i, f"http://a/{i} \n", h, "z") for i, h in enumerate(htmls)] + [(4, "http://a/4 \n", htmls[4], "z"), (None, None, "<p>x</p>", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string")
    warc.write(pages, str(tmp_path / "w"), segment_bytes=1000, chunk_bytes=300)
    got = [r.asDict() for r in warc.read(spark, str(tmp_path / "w")).collect()]
    assert len(got) == len(rows) and all(r["intact"] for r in got)
    first = {}
    for i, h in enumerate(htmls):
        first.setdefault(h or "", i)
    for row in got:
        if row["page_id"] is None:
            assert row["record_type"] == "response"
            continue
        payload = (htmls[row["page_id"]] or "").encode()
        origin = first[payload.decode()]
        assert row["payload_bytes"] == len(payload)
        assert row["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        revisit = origin != row["page_id"]
        assert (row["record_type"], row["refers_to"]) == (("revisit", origin) if revisit else ("response", None))
        assert row["payload"] == (None if revisit else payload)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_records_across_buffer_borders(spark, tmp_path):
    rows = [(i, f"http://x/{i}/WARC/1.1", "\r\n" * (i % 7) + "z" * (i * 37 % 900)) for i in range(4000)]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), str(tmp_path / "w"))
    assert warc.read(spark, str(tmp_path / "w"), payloads=False).where("intact").count() == len(rows)


def _foreign(kind, block, version="1.0", **fields):
    lines = [f"WARC-Type: {kind}", *(f"{k.replace('_', '-')}: {v}" for k, v in fields.items()), f"Content-Length: {len(block)}"]
    return f"WARC/{version}\r\n".encode() + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@pytest.mark.parametrize("packed", [True, False])
def test_warc_archives_of_other_origin(spark, tmp_path, packed):
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    inner = _foreign("response", http + b"quoted", WARC_Record_ID="<q>")
    payloads = [b"plain", b"quote\r\nWARC/1.1\r\nrest", inner, b"WARC/1.", b"", bytes(range(256)) * 9]
    records = [_foreign("warcinfo", b"software: x")]
    records += [
        _foreign("response", http + p, "1.0" if i % 2 else "1.1", WARC_Record_ID=f"<u{i}>", X_Page_ID=i, WARC_Target_URI="http://WARC/1.1/")
        for i, p in enumerate(payloads)
    ]
    whole = b"".join(records)
    cut = _foreign("response", http + b"whole payload", X_Page_ID=90)[:-12]  # the file ends in its block
    wrong = _foreign("response", http + b"x", X_Page_ID=91).replace(b"Content-Length: ", b"Content-Length: 9")
    files = {"a": whole, "b": b"".join(_foreign("response", http + b"b%d" % i, X_Page_ID=20 + i) for i in range(3)) + cut,
             "c": wrong + whole.replace(b"X-Page-ID: ", b"X-Page-ID: 4"), "d": b"no archive at all"}
    for name, data in files.items():
        # several members in one file, as others write them
        half = data.find(b"WARC/", len(data) // 2)
        packed_data = gzip.compress(data[:half]) + gzip.compress(data[half:]) if half > 0 else gzip.compress(data)
        (tmp_path / f"{name}.warc{'.gz' if packed else ''}").write_bytes(packed_data if packed else data)
    got = [(r.page_id, r.intact, r.payload and bytes(r.payload)) for r in warc.read(spark, str(tmp_path)).collect()]
    want = [(i, True, p or None) for i, p in enumerate(payloads)] + [(40 + i, True, p or None) for i, p in enumerate(payloads)]
    want += [(20 + i, True, b"b%d" % i) for i in range(3)]
    assert sorted((i, p or b"") for i, ok, p in got if ok) == sorted((i, p or b"") for i, _, p in want)
    assert sorted(i for i, ok, _ in got if not ok and i is not None) == [90, 91]
    assert sum(not ok for _, ok, _ in got) == 3  # and the file that is no archive


def test_warc_damage_is_told():
    assert warc.reassemble([(2, b"b"), (1, b"a")], 2) == b"ab"
    for segments, total in (([(1, b"a"), (3, b"b")], 2), ([(1, b"a")], 2), ([(1, b"a")], None)):
        with pytest.raises(warc.Damaged):
            warc.reassemble(segments, total)
    for body in (b"5\r\nab\r\n", b"zz\r\n", b"2\r\nabXX0\r\n\r\n"):
        with pytest.raises(warc.Damaged):
            warc.from_chunks(body)


# ------------------------------------------------------------------ 7 licenses

def test_license_places_and_expressions(spark):
    texts = [
        "MIT License. mit-license, the General Public\nLicense apache", None, "", "SPDX-License-Identifier: MIT OR (GPL-2.0-only WITH Classpath-exception-2.0)\nx",
        "SPDX-License-Identifier: MIT OR OR", "lesser general public license", "Apache License " * 2000,
    ]
    got = by_id(licenses.digests(docs_of(spark, texts)), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "permissive")
    assert got[0] == (9, 3, 0, 5, "gpl,mit", "gpl,mit", None)
    assert got[1] == got[2] == (0, 0, None, None, "", "", None)
    assert got[3][4:] == ("", "gpl,gpl-with-classpath-exception-2.0,mit", True)
    assert got[4][4:] == ("", "mit", True)
    assert got[5][1:6] == (1, 1, 1, "gpl", "gpl,lgpl")
    assert got[6][:4] == (4000, 2000, 0, 3998)
    assert licenses.postfix("a or b and c with d") == ["a", "b", "c", "d", "WITH", "AND", "OR"]
    assert max(len(licenses.IDENTIFIERS), len(licenses.EXCEPTIONS)) < 200
    assert not licenses.evaluate("MIT AND GPL-3.0-only").permissive
    for text in ("", "a b", "(a", "a)", "and a", "a with (b or c)"):
        with pytest.raises(licenses.ExpressionError):
            licenses.evaluate(text)


def _by_descent(tokens):
    """(labels, permissive, rest) of the expression at the start of tokens; a second evaluator, by recursive descent."""
    def operand(rest):
        if rest[:1] == ["("]:
            labels, ok, rest = choice(rest[1:])
            if rest[:1] != [")"]:
                raise ValueError
            return labels, ok, rest[1:], False
        if not rest or rest[0].upper() in ("AND", "OR", "WITH", ")", "(") or not licenses.is_licence(rest[0]):
            raise ValueError
        if rest[0].lower() in licenses.NOTHING:
            return frozenset(), False, rest[1:], False
        label = licenses.label_of(rest[0])
        return frozenset({label}), label in licenses.PERMISSIVE, rest[1:], True

    def excepted(rest):
        labels, ok, rest, plain = operand(rest)
        if rest and rest[0].upper() == "WITH":
            if not plain or len(rest) < 2 or not licenses.is_exception(rest[1]):
                raise ValueError
            labels, rest = labels | {f"{min(labels)}-with-{rest[1].lower()}"}, rest[2:]
        return labels, ok, rest

    def both(rest):
        labels, ok, rest = excepted(rest)
        while rest and rest[0].upper() == "AND":
            more, also, rest = excepted(rest[1:])
            labels, ok = labels | more, ok and also
        return labels, ok, rest

    def choice(rest):
        labels, ok, rest = both(rest)
        while rest and rest[0].upper() == "OR":
            more, also, rest = both(rest[1:])
            labels, ok = labels | more, ok or also
        return labels, ok, rest

    return choice(tokens)


def _longest_expression(text):
    tokens = re.findall(r"[()]|[A-Za-z0-9.+:-]+", re.match(r"[ \t]*((?:[()]|[A-Za-z0-9.+:-]+|[ \t]+)*)", text)[1])
    for end in range(len(tokens), 0, -1):
        for last in (tokens[end - 1], tokens[end - 1].rstrip(".")):
            try:
                labels, ok, rest = _by_descent([*tokens[:end - 1], *([last] if last else [])])
            except ValueError:
                continue
            if not rest:
                return labels, ok
    return None


def test_an_expression_of_many_parts_is_read_to_its_end(spark):
    text = " OR ".join(["MIT"] * 200 + ["(GPL-2.0-only WITH GCC-exception-2.0)", "Zlib"])
    assert licenses.read_expression(f"{text}. AND then prose")[0] == text
    got = by_id(licenses.digests(docs_of(spark, [f"SPDX-License-Identifier: {text}", f"SPDX-License-Identifier: {text} OR"])), "labels", "permissive")
    assert set(got.values()) == {("gpl,gpl-with-gcc-exception-2.0,mit,zlib", True)}
    many = " AND ".join(f"LicenseRef-{i}" for i in range(20_000))  # each part is read once
    assert len(licenses.read_expression(many)[1].labels) == 20_000
    assert licenses.read_expression("(MIT) AND ((BSL-1.0 OR)")[0] == "(MIT)"


def test_licenses_agree_with_plain_scans(spark):
    rng = random.Random(3)
    parts = ["MIT", "license", "License", "Apache", "LICENSE", "general", "Public", "lesser", "bsd", "é", "x1", "-", "\n", ".", "ſ", "cc by", "mit\x0blicense"]
    terms = ["MIT", "mit", "GPL-2.0-or-later", "Apache-2.0", "GPL-2.0+", "foo", "LicenseRef-own", "NOASSERTION", "Classpath-exception-2.0", "(", ")", "AND", "or", "WITH", "OR", ",", "see file", "MIT."]
    tags = ["SPDX-License-Identifier:", "spdx-LIcenSe-identifier:", "License-Expression:"]
    ends = ["\n", " */ x\n", " --> y", "\r\n", ""]
    texts = [None, "", "SPDX-LIcenSe-Identifier: MIT", "SPDX-License-Identifier: MIT, see file", "// SPDX-License-Identifier: (MIT)*/ AND x"]
    for _ in range(600):
        text = " ".join(rng.choices(parts, k=rng.randint(0, 25)))
        for _ in range(rng.randint(0, 2)):
            text += "\n" + rng.choice(tags) + " " + " ".join(rng.choices(terms, k=rng.randint(0, 7))) + rng.choice(ends)
        texts.append(text)
    texts.append("MIT License " * 30_000 + "SPDX-License-Identifier: ISC")
    got = by_id(licenses.digests(docs_of(spark, texts)), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "permissive")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for i, text in enumerate(texts):
        folded = (text or "").translate(lower)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)

        def places(phrases, words=words):
            wanted = {tuple(p.split()): label for p, label in phrases.items()}
            return [(k, wanted[w]) for n in {len(p) for p in wanted} for k in range(len(words) - n + 1) if (w := tuple(words[k:k + n])) in wanted]

        base, other = sorted(places(licenses.BASE_PHRASES)), {label for _, label in places(licenses.PHRASES)}
        labels, permissive = {label for _, label in base} | other, None
        for m in re.finditer("|".join(map(re.escape, licenses.TAGS)), folded):
            line = re.split(r"[\r\n]|\*/|-->", (text or "")[m.end():], maxsplit=1)[0]
            if (found := _longest_expression(line.strip())) is not None:
                labels |= found[0]
                permissive = found[1] if permissive is None else permissive and found[1]
        first, last = (base[0][0], base[-1][0]) if base else (None, None)
        assert got[i][:5] == (len(words), len(base), first, last, ",".join(sorted({b for _, b in base}))), text
        assert got[i][5] == ",".join(sorted(labels)) and got[i][7] == permissive, text
        assert 0 <= got[i][6] <= 1


# ------------------------------------------------------------------ 8 quality

def test_quality_separates_held_out_texts(spark):
    random.seed(6)
    good = [" ".join(random.choices(["the", "river", "runs", "slowly", "past", "old", "stones"], k=60)) for _ in range(200)]
    bad = [" ".join(random.choices(["buy!!!", "$$$", "WIN", "###", "click", "%%%"], k=60)) for _ in range(200)]
    texts = [x for pair in zip(good, bad, strict=True) for x in pair] + ["", None]
    docs = docs_of(spark, texts)
    labels = spark.createDataFrame([(i, 1 - i % 2, "x") for i in range(400)] + [(0, None, "x"), (None, 1, "x"), (1, 0, "x")], "doc_id long, quality int, score string")
    scored = by_id(quality.score(docs, quality.fit(docs, labels)).withColumn("held_out", quality.held_out("doc_id")), "score", "held_out")
    assert all((scored[i][0] >= 0.5) == (i % 2 == 0) for i in range(400) if scored[i][1])
    assert scored[400] == scored[401][:1] + (scored[400][1],)
    assert 0 <= scored[400][0] <= 1
    empty = quality.fit(docs, labels.limit(0))
    assert {s for s, _ in by_id(quality.score(docs, empty).withColumn("x", F.lit(0)), "score", "x").values()} == {0.5}
    assert quality.score(docs.limit(0), empty).count() == 0


def test_quality_survives_a_very_long_labelled_text(spark):
    rng = random.Random(6)
    good = [" ".join(rng.choices(["the", "river", "runs", "slowly", "past", "old", "stones"], k=60)) for _ in range(60)]
    bad = [" ".join(rng.choices(["buy!!!", "$$$", "WIN", "###", "click", "%%%"], k=60)) for _ in range(60)]
    texts = [x for pair in zip(good, bad, strict=True) for x in pair]
    for at in (0, 1):
        words = sorted(set(texts[at].split()))
        texts[at] = " ".join(rng.choices(words, k=13_000_000 // 5))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(120)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    assert model.slope > 0 and model.good and model.bad
    assert {r.doc_id for r in quality.keep_good(docs, model).select("doc_id").collect()} - {0} == set(range(2, 120, 2))
    long = bytes(range(256)) * 1000
    assert len(quality.sampled(long, 10_000, 2048)) == 4 * 2048
    assert quality.sampled(b"abc", 0, 2048) == b"abc" and quality.sampled(long, 10_000, 2048)[-1:] == long[-1:]
    with pytest.warns(UserWarning, match="one class"):
        assert quality.fit(docs, labels.where("quality = 1")).slope == 0


def test_quality_scores_agree_with_plain_compression(spark):
    import zstandard

    texts = ["", None, "ab" * 3000, "plain text of some words", "é" * 5000, "x" * 2048, "y" * 2049]
    model = quality.train([b"plain text of words and more words " * 40] * 9, [b"@@@@ 1234 ####" * 60] * 9)
    packers = [
        zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False)
        for d in (model.good, model.bad)
    ]
    for i, (value, score) in by_id(quality.score(docs_of(spark, texts), model), "value", "score").items():
        data = (texts[0 if i is None else i] or "").encode()
        sizes = [sum(len(p.compress(data[a:a + 2048])) for a in range(0, len(data), 2048)) for p in packers]
        want = (sizes[1] - sizes[0]) / max(1, len(data))
        assert value == want and abs(score - 1 / (1 + np.exp(-(model.slope * want + model.offset)))) < 1e-12


# ------------------------------------------------------------------ 9 URL filters

def test_url_rules(spark):
    urls = ["http://a.example.net/en/1?x", "https://NET/x", "http://net", "ftp://example.com/de/#a", "http://fr.org/fr/x", "nothing", None, "", "http://xnet/", "http://x.org/en"]
    pages = spark.createDataFrame([(i, u, "q") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages).collect()}
    assert got[0] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[1] == ("net", "/x", "net/", "block")
    assert got[2] == ("net", "", None, "allow")
    assert got[3] == ("example.com", "/de/", "example.com/de/", "block")
    assert got[4] == ("fr.org", "/fr/x", "org/fr/", "allow")
    assert got[5] == got[6] == got[7] == ("", "", None, "allow")
    assert got[8][2] is None and got[9][2] is None
    assert url_filter.judge(pages.limit(0)).count() == 0
    with pytest.raises(ValueError):
        url_filter.compile_rules(url_filter.RULES, max_bytes=10)


def test_urls_agree_with_plain_rules_when_digests_collide(spark, monkeypatch):
    rng = random.Random(2)
    names, tails = ["net", "example.net", "org", "a.org", "example.com", "b.example.com", "x", ""], ["/", "/en/", "/de/", "/fr/", "/en/x/"]
    rules = [url_filter.Rule(rng.choice(["block", "allow"]), h, p) for h in names[:-1] for p in rng.sample(tails, 3)]
    urls = [None, "", "://", "http://NET", "x" * 200_000, "http://" + "a." * 30_000 + "net/en/"]
    urls += [
        f"h://{rng.choice(['', 'w.', 'É.', '.'])}{rng.choice(names).upper() if rng.random() < 0.3 else rng.choice(names)}{rng.choice(tails + ['', '?q', '#f', '/en'])}{rng.choice(['', 'x?/en/', 'y'])}"
        for _ in range(700)
    ]
    # Every digest is one of three numbers, so each search meets many strings that are not the one looked for.
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda text, seed=0: len(text) % 3)
    array = url_filter.DigestArray(url_filter.compile_rules(rules))
    split = [url_filter.split_url((u or "").encode()) for u in urls]
    found = array.longest(split)
    monkeypatch.undo()
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(3, urls[3]), (None, urls[3])], "page_id long, url string")
    judged = url_filter.judge(pages, rules, "allow").collect()
    assert len(judged) == len(urls) + 2
    got = {r.page_id: r for r in judged if r.page_id is not None}
    first = {}
    for r in rules:
        first.setdefault((r.host, r.path), r.verdict)
    for i, url in enumerate(urls):
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
        host, path = ("".join(c.lower() if c.isascii() else c for c in m[1]), m[2]) if m else ("", "")
        fits = [(len((h + p).encode()), len(h.encode()), h, p) for h, p in first if m and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        want = (best[2] + best[3], first[best[2:]]) if best else (None, "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, *want), url[:80]
        assert (None if found[i] < 0 else array.text(found[i]).replace(b"\0", b"").decode()) == want[0]


# ------------------------------------------------------------------ 10 secrets

def test_automaton_agrees_with_re():
    random.seed(7)
    patterns = ["a+b?c", "(?i:ab|ba){2,3}", "[^a]x{2}", "a(b|c)*d"]
    combined = compile_all(patterns)
    for _ in range(2000):
        text = "".join(random.choices("abcdxAB", k=random.randint(0, 12)))
        state, seen = 0, 0
        for byte in text.encode():
            state = combined.trans[state, byte]
            seen |= int(combined.accepts[state])
        assert seen == sum(1 << k for k, p in enumerate(patterns) if re.search(p, text)), text


def test_secrets_agree_with_re(spark):
    random.seed(8)
    parts = ["token", "SECRET", "=", ": ", '"', "abcdef12", "AKIA", "ABCDEFGHIJKLMNOP12", "0123456789abcdef", "é", "\n", " ", "api_key", "password"]
    texts = ["".join(random.choices(parts, k=random.randint(1, 40))) for _ in range(400)] + ["", None, "x" * 50_000 + "token=abcdefgh" + "ü" * 9000]
    assign = re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    got = by_id(secrets.scan(docs_of(spark, texts)), "spans")
    for i, text in enumerate(texts):
        text = text or ""
        want = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[1]) >= 6]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        own = [(s["start"], secrets.BASE_KINDS.index(s["kind"]), s["end"]) for s in got[i][0] if s["kind"] in secrets.BASE_KINDS]
        assert own == sorted(want), text[:200]
    clean = by_id(secrets.redact(docs_of(spark, texts)), "text", "n_tokens")
    assert clean[401] == (None, "x") and clean[400] == ("", "x")
    assert clean[402][0] == "x" * 50_000 + "[assign]" + "ü" * 9000
    assert secrets.digests(docs_of(spark, texts).limit(0)).count() == 0
