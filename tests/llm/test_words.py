"""Spelling variants, BPE encoding and decoding, ranked search."""

import hashlib
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from crashlens.llm import bpe_codec as B
from crashlens.llm import lexical_treap as L
from crashlens.llm import queries as Q
from crashlens.llm import spelling_variants as S
from tests.conftest import SF001
from tests.llm.conftest import frame, pairs

BPE = public_tokenizers.path("byte_bpe_50k.json")


# --- spelling variants --------------------------------------------------------------------


def _words(rows):
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _variants(words):
    out, form = [], {}
    near = {a: [b for b in words if _near(a, b)] for a in words}
    for a in words:
        best = min(near[a], key=lambda b: (-words[b], b), default=None)
        form[a] = best if best and words[best] >= 2 * words[a] else None
    for a in words:
        root = a
        while form[root]:
            root = form[root]
        out.append((a, words[a], len(near[a]), form[a], words[form[a]] if form[a] else None, root))
    return sorted(out)


def _got(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


def test_word_counts_by_brute_force(odd, small, empty):
    for docs in (odd, small, empty):
        assert {r.word: r.n for r in S.word_counts(docs).collect()} == _words(pairs(docs))


def test_variants_by_brute_force(spark, odd, empty):
    rng = random.Random(3)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 8))) for _ in range(150)]
    rows = [(i, " ".join(rng.choices(stems, weights=[1.5 ** (k % 16) for k in range(150)], k=400)) + " ×÷×÷× Aaaaaa aaaaa AAAAAAA", "a") for i in range(40)]
    docs = frame(spark, rows)
    want = _variants(_words(pairs(docs)))
    assert len({r[5] for r in want}) < len(want) and any(r[3] and r[3] != r[5] for r in want)
    assert _got(S.variant_groups(docs)) == want
    assert _got(S.variant_groups(odd)) == _variants(_words(pairs(odd)))
    assert S.variant_groups(empty).collect() == []


def test_long_paths_reach_their_root(spark):
    """Counts that double along a chain of words, each one code point from the next."""
    chain = [("a" * k + "b" * (12 - k)) for k in range(0, 13)]
    forms = spark.createDataFrame([(a, b) for a, b in zip(chain, chain[1:])] + [(chain[-1], None)], "word string, form string")
    assert {r.word: r.root for r in S.roots(forms).collect()} == {w: chain[-1] for w in chain[:-1]}


def test_variants_of_a_registered_table(spark, small):
    docs = small.limit(40)
    assert _got(S.variant_groups(docs)) == _variants(_words(pairs(docs)))


def test_no_pairs_within_a_group(spark):
    """A group as large as the alphabet allows adds rows in proportion to its words."""
    letters = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]
    words = spark.createDataFrame([(f"stem{c}x", 10 + k) for k, c in enumerate(letters)], "word string, n long")
    got = {r.word: (r.n_near, r.near) for r in S.neighbours(words).collect()}
    assert set(got.values()) == {(len(letters) - 1, f"stem{letters[-1]}x"), (len(letters) - 1, f"stem{letters[-2]}x")}


# --- BPE ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def codec():
    with open(BPE, encoding="utf-8") as f:
        return B.Codec(f.read())


def _digest(rows):
    lib = Tokenizer.from_file(BPE)
    out = []
    for i, t in rows:
        ids = lib.encode(t, add_special_tokens=False).ids
        out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return sorted(out, key=str)


def test_codec_query_equals_the_library(spark, monkeypatch, odd, small, empty):
    for docs in (odd, small, empty):
        monkeypatch.setattr(Q, "table", lambda *a, docs=docs: docs)
        got = Q.op12_bpe_codec(spark, SF001)
        assert sorted((tuple(r) for r in got.collect()), key=str) == _digest(pairs(docs))


def test_odd_texts_as_the_library(codec):
    lib = Tokenizer.from_file(BPE)
    for t in ("", "<|endoftext|>", "a <|endoftext|>  b  <|endoftext|><|endoftext|>", "x" * 5000, "ab" * 3000 + "é" * 300, "࢐՘ ok", "  \n\n x's 'LL we're",
              "\U0001f600‍ x　y", "a\x1c b\x1f\t c", " lead and trail ", "tab\t space", "a" * 191 + " " + "b" * 193, "ᲊᲉ a"):
        ids = np.frombuffer(codec.encode(t), codec.width).tolist()
        assert ids == lib.encode(t, add_special_tokens=False).ids, t[:20]
        assert codec.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_classes_of_old_blocks_agree():
    """What ``regex`` cuts itself has the library's classes, code point by code point."""
    lib = Tokenizer.from_file(BPE).pre_tokenizer
    for c in range(0x20000):
        if 0xD800 <= c < 0xE000 or B.YOUNG.search(chr(c)):
            continue
        t = f"a{chr(c)}b1{chr(c)}2.{chr(c)}. {chr(c)}\n"
        assert B.PRETOKEN.findall(t) == [t[a:b] for _, (a, b) in lib.pre_tokenize_str(t)], hex(c)


def test_scan_and_heap_merge_alike(codec):
    rng = random.Random(1)
    for _ in range(500):
        w = "".join(rng.choice("etaoinshrdlué ") for _ in range(rng.randint(1, 60))).encode()
        assert codec._scanned(w) == codec._queued(w)


def test_ids_decode_as_the_library(spark, codec):
    lib, rng = Tokenizer.from_file(BPE), random.Random(2)
    rows = [(k, [rng.randrange(50257) for _ in range(30)]) for k in range(200)] + [(None, []), (3, None)]
    got = B.decoded(spark.createDataFrame(rows, "doc_id long, ids array<int>"), BPE)
    want = [(i, lib.decode(ids or [], skip_special_tokens=False)) for i, ids in rows]  # broken sequences too
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)


def test_other_tokenizers_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        B.Codec(f.read())


# --- ranked search --------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def _ranks(docs, items):
    docs = [(i, Counter(TERM.findall(_lower(t)))) for i, t in docs]
    docs = [(i, c) for i, c in docs if c]
    n, length, df = len(docs), sum(sum(c.values()) for _, c in docs), Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        found, scores = Counter(TERM.findall(_lower(text))), []
        for i, c in docs:
            m = 75 + 25 * sum(c.values()) * n // length
            score = sum(k * L.weight(n, df[t]) * (1000000000 * c[t] // (1000 * c[t] + 12 * m)) for t, k in found.items() if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:20], 1)]
    return sorted(out, key=str)


def _items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_ranks_by_brute_force(spark, monkeypatch, odd, small, empty):
    for name, value in (("BLOCK_TERMS", 1500), ("BLOCK_DOCS", 30), ("SENT_TERMS", 60), ("JOINT_TERMS", 25), ("WIDTH", 2)):
        monkeypatch.setattr(L, name, value)  # many blocks of documents and of items
    items = [r for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").limit(12).collect()]
    items = [tuple(r) for r in items] + [(None, "the THE the"), (3, None), (3, ""), (4, "漢字 größe x3000 alpha alpha, one!"), (5, "unheard-of-zz")]
    for docs in (odd, small, odd.union(odd.limit(5)), empty):
        got = L.search(docs, _items(spark, items))
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == _ranks(pairs(docs), [(i, t or "") for i, t in items])
    assert L.search(small, _items(spark, [])).collect() == []


def test_equal_scores_go_by_doc_id(spark, monkeypatch):
    monkeypatch.setattr(L, "WIDTH", 1)
    docs = frame(spark, [(k * 37 % 101, "one and the same words", "a") for k in range(90)] + [(None, "one and the same words", "a"), (500, "other terms", "b")])
    got = sorted((r.rank, r.doc_id) for r in L.search(docs, _items(spark, [(1, "same words")])).collect())
    assert got == [(k + 1, i) for k, i in enumerate(sorted(k * 37 % 101 for k in range(90))[:20])]


def test_tree_holds_every_cell():
    rng = np.random.default_rng(5)
    for rows, cols, n in ((1, 1, 1), (300, 17, 900), (5, 4000, 2000), (1 << 20, 3, 50)):
        cell = np.unique(rng.integers(0, rows * cols, n))
        r, c = np.divmod(cell, cols)
        v = rng.integers(1, 1_000_000, len(cell))
        tree = L.Tree.load(**L.build_tree(r, c, v))
        assert tree.top[0] == v.max()
        for k in rng.integers(0, len(cell), 60):
            at = 0
            for level in reversed(range(tree.depth)):
                q = int(r[k] >> level & 1) * 2 + int(c[k] >> level & 1)
                assert tree.mask[at] >> q & 1
                below = int(tree.first[at] + L._BELOW[tree.mask[at], q])
                assert tree.top[below] <= tree.top[at]
                at = below
            assert tree.top[at] == v[k]
