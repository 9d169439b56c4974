"""Suffix dedup and the n-gram join against brute force."""

import hashlib
import itertools
import random

import pytest

import corpus_pipeline
from crashlens.llm import ngram_join as J
from crashlens.llm import suffix_dedup as S
from tests.llm.conftest import frame, pairs


def _removed(rows):
    seen = {}
    for i, t in rows:
        b = t.encode()
        for p in range(len(b) - 49):
            seen.setdefault(b[p:p + 50], i)
    out = []
    for i, t in rows:
        b, c = t.encode(), bytearray(len(t.encode()))
        for p in range(len(b) - 49):
            if (seen[b[p:p + 50]] is None) != (i is None) or (i is not None and seen[b[p:p + 50]] < i):
                c[p:p + 50] = b"\1" * 50
        kept = bytes(x for x, y in zip(b, c) if not y)
        out.append((i, len(b), sum(c), sum(1 for k in range(len(c)) if c[k] and (not k or not c[k - 1])), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def _cut(docs, **how):
    return sorted((tuple(r) for r in S.removed_bytes(docs, **how).collect()), key=str)


def test_cover_is_a_difference_set():
    assert {(a - b) % S.MODULUS for a in S.COVER for b in S.COVER} == set(range(S.MODULUS))


@pytest.mark.parametrize("unit_bytes", [2000, 1 << 20])
def test_removed_bytes_by_brute_force(odd, small, unit_bytes):
    for docs in (odd, small):
        assert _cut(docs, unit_bytes=unit_bytes) == _removed(pairs(docs))


def test_repeats_at_every_offset(spark):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("ab") for _ in range(n))
    shared = word(49), word(50), word(51), word(90)
    rows = [(i, word(rng.randint(0, 60)) + rng.choice(shared) + word(rng.randint(0, 60)), "a") for i in range(60)]
    rows += [(100 + i, "é" * 40 + word(3), "a") for i in range(3)] + [(200, "z" * 500, "a"), (201, "z" * 70, "a")]
    docs = frame(spark, rows)
    assert _cut(docs, unit_bytes=500) == _removed(pairs(docs))


def test_removed_bytes_empty(empty):
    assert _cut(empty) == []


def _sets(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for i, t in rows:
        w = t.encode().decode().translate(lower).encode().split()
        out.append((i, frozenset(tuple(w[k:k + 3]) for k in range(len(w) - 2)) if len(w) > 2 else frozenset([tuple(w)] if w else [])))
    return out


def _components(rows):
    sets = _sets(rows)
    label = list(range(len(sets)))

    def find(a):
        while label[a] != a:
            a = label[a]
        return a

    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if x and y and 100 * len(x & y) >= 90 * len(x | y):
            label[max(find(a), find(b))] = min(find(a), find(b))
    return sorted(((i, len(s), sets[find(k)][0]) for k, (i, s) in enumerate(sets)), key=str)


def _joined(docs, **how):
    return sorted((tuple(r) for r in J.components_of(docs, **how).collect()), key=str)


def test_components_by_brute_force(odd, small):
    for docs in (odd, small):
        assert _joined(docs, unit_bytes=20_000) == _components(pairs(docs))


def test_near_copies_of_copies(spark):
    """A large group of copies with 1 to 5 edits, copies of copies, and chains."""
    rng = random.Random(2)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(140):
        w = list(base) if i % 3 or not rows else rows[rng.randrange(len(rows))][1].split()
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 25)}"
        rows.append((i, " ".join(w), "a"))
    docs = frame(spark, rows)
    assert _joined(docs, unit_bytes=4000) == _components(pairs(docs))


def test_a_passage_that_many_share_links_nothing(spark):
    shared = " ".join(f"s{k}" for k in range(60))
    docs = frame(spark, [(i, f"{shared} " + " ".join(f"d{i}x{k}" for k in range(40)), "a") for i in range(40)])
    assert _joined(docs) == _components(pairs(docs))


def _groups(rows, words, similarity):
    """Per row its id, its number of shingles and its component, by brute force."""
    ids, sets = [], []
    for i, t in rows:
        w = t.encode().lower().split()
        ids.append(i)
        sets.append(frozenset(tuple(w[k:k + words]) for k in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else []))
    label = list(range(len(sets)))
    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= similarity * len(x | y) and label[a] != label[b]:
            low, high = sorted((label[a], label[b]))
            label = [low if c == high else c for c in label]
    return sorted(((i, len(s), ids[c]) for i, s, c in zip(ids, sets, label)), key=str)


@pytest.mark.parametrize("words, similarity", [(5, 80), (2, 70)])
def test_words_and_similarity_are_parameters(spark, odd, small, words, similarity):
    rng = random.Random(3)
    base, rows = [f"w{k}" for k in range(150)], []
    for i in range(120):
        w = list(base) if i % 3 or not rows else rows[rng.randrange(len(rows))][1].split()
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 25)}"
        rows.append((i, " ".join(w), "a"))
    for docs in (frame(spark, rows), odd, small):
        assert _joined(docs, unit_bytes=20_000, words=words, similarity=similarity) == _groups(pairs(docs), words, similarity)


@pytest.mark.parametrize("words, similarity", [(5, 80), (3, 90)])
def test_sets_that_differ_from_their_hub_in_ways_of_their_own(spark, words, similarity):
    """Most copies have edits that no other has; some of these have copies that link with them alone."""
    rng = random.Random(9)
    base, rows = [f"w{k}" for k in range(90)], []
    for i in range(120):
        copied = i % 4 == 3
        w = rows[rng.randrange(len(rows))][1].split() if copied else list(base)
        for k in range(rng.randint(0, 2) if copied else rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"own{i}x{k}"
        rows.append((i, " ".join(w), "a"))
    docs = frame(spark, rows)
    assert _joined(docs, unit_bytes=4000, words=words, similarity=similarity) == _groups(pairs(docs), words, similarity)


def test_the_pipeline_drops_near_copies_of_five_words_and_eight_tenths(spark):
    text = [f"w{k}" for k in range(100)]
    twice = [*text[:30], "one", *text[31:70], "two", *text[71:]]  # 86 of 106 shingles of five words; 92 of 104 of three
    docs = frame(spark, [(1, " ".join(text), "a"), (2, " ".join(twice), "a"), (3, " ".join(f"x{k}" for k in range(100)), "a")])
    assert [i for i, _ in pairs(corpus_pipeline.drop_near_duplicates(spark, docs, ""))] == [1, 3]


def test_rows_without_an_id_or_with_a_repeated_one_are_told_apart_by_text(spark):
    texts = {k: [f"{k}{j}" for j in range(100)] for k in "abcde"}
    near = lambda k: " ".join([*texts[k][:50], "other", *texts[k][51:]])
    a, b, c, d, e = (" ".join(texts[k]) for k in "abcde")
    rows = [(None, a), (None, near("a")), (None, b), (None, b), (5, c), (5, d), (6, near("d")), (7, near("c")), (8, e), (8, e), (9, None), (None, "")]
    docs = frame(spark, [(i, t, "a") for i, t in rows])
    for words, similarity in ((3, 90), (5, 80)):
        assert _joined(docs, words=words, similarity=similarity) == _groups(pairs(docs), words, similarity)
    stay = pairs(corpus_pipeline.drop_near_duplicates(spark, docs, ""))
    assert len(stay) == 7 and [x for x in stay if x[0] is not None] == [(5, c), (5, d), (8, e), (9, "")]
    assert [t for i, t in stay if i is None if t != ""] in ([a, b], [near("a"), b])


def test_components_empty(empty):
    assert _joined(empty) == []


def test_labels_along_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "a long, b long")
    assert {tuple(r) for r in J.components(edges).collect()} == {(k, 0) for k in range(41)} | {(100, 100), (101, 100)}
