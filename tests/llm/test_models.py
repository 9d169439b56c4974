"""Language model, toxicity and decontamination."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from crashlens.llm import context_mixing as C
from crashlens.llm import latent_decontamination as L
from crashlens.llm import toxicity as X
from crashlens.llm.common import fold_of, setting
from tests.conftest import SF001, SF01
from tests.llm.conftest import frame, pairs


def _base(rows):
    key = lambda i: -(2**63) if i is None else i
    words = [(i, [*t.encode().lower().split(), None]) for i, t in rows]
    count = Counter(w for i, ws in words if fold_of(key(i), 7) != 2 for w in ws)
    n, v = sum(count.values()), len(count)
    return sorted(((i, fold_of(key(i), 7) == 2, len(ws), sum(count[w] > 0 for w in ws), n,
                    round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in words), key=str)


@pytest.mark.parametrize("unit_bytes", [3000, 1 << 20])
def test_base_score_by_brute_force(odd, small, unit_bytes):
    for docs in (odd, small):
        rows = C.scores(docs, unit_bytes).collect()
        got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=str)
        assert got == _base(pairs(docs))
        assert all(r.score < 0 for r in rows)


def test_model_beats_plainer_ones_on_held_out_text(spark):
    """Word counts where a new word is spelled byte by byte, and counts after two bytes: as the
    model's score, both are chances of the text itself (the base score leaves new words unspelled)."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = [r for r in C.scores(docs).collect() if r.held_out]
    texts = {i: t.encode() for i, t in pairs(docs)}
    train, held = ([t for i, t in texts.items() if (fold_of(i, 7) == 2) == own] for own in (False, True))
    count = Counter(w for t in train for w in [*t.lower().split(), None])
    total, byte = sum(count.values()) + len(count) + 1, Counter(b"".join(train))
    spell = lambda w: sum(math.log2((byte[c] + 1) / (byte.total() + 256)) for c in w + b" ")
    words = sum(math.log2((count[w] + 1) / total) + (0 if count[w] else spell(w)) for t in held for w in t.lower().split())
    pair, after = Counter(), Counter()
    for t in train:
        pair.update(zip(t, t[1:], t[2:]))
        after.update(zip(t, t[1:]))
    two = sum(math.log2((pair[x] + 0.05) / (after[x[:2]] + 0.05 * 256)) for t in held for x in zip(t, t[1:], t[2:]))
    score = sum(r.score for r in got) / C.LOG10_2
    assert score > words and score > two


def _model(texts, shards):
    """Shared tables, a mixer and the lexicon's shards, as ``scores`` builds them."""
    count = Counter(c for t in texts for c in C.chunks_of(t))
    dealt = {k: (own, np.array([count[c] for c in own], np.int64)) for k, own in C._by_bucket(set(count), shards).items()}
    tables = np.zeros((2, int(C.FIRST[-1])), np.float32)
    mixer = C.Mixer.fresh()
    for own, counts in dealt.values():
        C._count(tables, own, counts, True)
    for own, counts in dealt.values():
        mixer.learn(tables, C._local(tables, own, counts), own, counts)
    return tables, mixer, dealt


def test_probabilities_add_up(monkeypatch):
    """The chances of all ways to go on add up to one: the code's leaves after any context."""
    tables, mixer, dealt = _model((b"the cat sat. The dog ran", b"a cat and the dog"), 1)
    own = C._local(tables, *dealt[0])
    monkeypatch.setattr(C, "_local", lambda *a: own)
    bits = lambda chunk: mixer.bits(tables, [chunk], np.ones(1, np.int64))[0]
    for prefix in (b"", b"c", b"xq", b"xqabcd"):
        ways = [bits(prefix + bytes([c])) - (bits(prefix) if prefix else 0) for c in range(256) if c != C.START[0]]
        assert abs(np.exp2(-np.array(ways)).sum() - 1) < 5e-3


def test_known_chunks_share_one_probability(small):
    """However the lexicon is dealt, the chances of all its chunks add up to one at most."""
    texts = [t.encode() for _, t in pairs(small)[:60]]
    for shards in (1, 8, 64, 200):
        tables, mixer, dealt = _model(texts, shards)
        total = {True: 0.0, False: 0.0}
        for own, counts in dealt.values():
            for c, bits in zip(own, mixer.bits(tables, own, counts)):
                total[c.startswith(C.START)] += 2.0 ** -bits
        assert 0.2 < total[False] <= 1 and 0 < total[True] <= 1, (shards, total)


def test_scores_do_not_depend_on_the_cluster(spark, monkeypatch, small):
    monkeypatch.setattr(C, "SHARD_BYTES", 100_000)
    seen = []
    for partitions, unit_bytes in (("3", 1 << 20), ("11", 40_000)):
        with setting(spark, "spark.sql.shuffle.partitions", partitions):
            seen.append(sorted((r.doc_id, r.score) for r in C.scores(small, unit_bytes).collect()))
    assert seen[0] == seen[1]


def test_chunk_numbers_give_the_texts_back(spark, small):
    """Units keep their documents as chunk numbers, so the last step sums without cutting texts again."""
    unit = C.make_units(small, 1 << 20).toArrow().slice(0, 1)
    found, n, numbers = C._numbered(unit, 7)
    chunks = [c for own, _ in found.values() for c in own]
    texts = [C.chunks_of(t) for _, t in C._documents(unit)]
    assert list(found) == sorted(found) and n.tolist() == list(map(len, texts))
    assert [chunks[k] for k in C._unpacked_numbers(C._packed(numbers))] == [c for t in texts for c in t]
    training = Counter(c for (i, _), t in zip(C._documents(unit), texts) if fold_of(i, C.FOLDS) != C.HELD_OUT for c in t)
    assert [k for _, counts in found.values() for k in counts] == [training[c] for c in chunks]
    assert "payload" not in C.scores(small)._jdf.queryExecution().optimizedPlan().toString()


def test_scores_empty(empty):
    assert C.scores(empty).collect() == []


def _toxic_rows(seed, n):
    rng = random.Random(seed)
    syllables = "ba ce di fo gu la me ni po ru sa te vi".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows = []
    for _ in range(n):
        w, toxic = [word() for _ in range(40)], rng.random() < 0.4
        if toxic:
            w[rng.randrange(40)] = rng.choice(("idiot", "scumbag", "worthless", "krzdum"))
        rows.append((" ".join(w) + ".", int(toxic)))
    return rows


def test_toxicity_on_held_out_texts_and_gaps():
    train, test = _toxic_rows(1, 400), _toxic_rows(2, 300)
    model = X.fit([t for t, y in train if y], [t for t, y in train if not y])
    score = X.Scorer(model)
    wrong = sum((score([t])[0] >= 0.5) != y for t, y in test)
    assert wrong <= 6
    clean = score(["ba ce di fo gu"])[0]
    for gapped in ("idixot", "i d i o t", "worth*less", "wortthless"):
        assert score([f"ba ce {gapped} fo gu"])[0] > clean
    assert 0 <= score([""])[0] < 0.5 and score(["x" * 5000])[0] < 0.5


def test_kernel_is_that_of_all_subsequences():
    def slow(a, b):
        def features(w):
            w = "\1" + w + "\2"
            out = Counter()
            for i in range(len(w)):
                for j in range(i + 1, len(w)):
                    for k in range(j + 1, min(len(w), i + 3 + X.GAP)):
                        out[w[i], w[j], w[k]] += X.DECAY ** (k - i - 2)
            return out
        x, y = features(a), features(b)
        dot = lambda p, q: sum(p[k] * q[k] for k in p)
        return dot(x, y) / math.sqrt(dot(x, x) * dot(y, y))

    # Both edge signs share a code with nothing else in these words.
    for a, b in (("idiot", "idixot"), ("idiot", "idiot"), ("scum", "clown"), ("abc", "xyz")):
        basis = np.stack([X._dense(b)])
        assert abs(X._kernel([a], basis)[0, 0] - slow(a, b)) < 0.02


def test_toxicity_without_labels_and_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = X.train(odd, labels)
    assert {r.score for r in X.toxicity(odd, model).collect()} == {X.NOTHING.score(np.array([X.FLOOR]))[0]}
    assert X.toxicity(odd, model).count() == odd.count() and X.toxicity(empty, model).count() == 0
    assert X.accepted(odd, model).columns == odd.columns and X.accepted(odd, model).count() == odd.count()


def test_labels_of_held_out_rows_are_not_read(spark, small):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    held = X.labelled_sample(small, labels.where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"), 1, 10)
    assert held == []


def test_leaks_are_found_and_clean_documents_left(spark):
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("ara", "elo", "ino", "otu", "uza", "e", "i")]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [text(40) + ". " + " ".join(f"ans{k}{j}" for j in range(4)) + "." for k in range(30)] + ["two words", None, ""]
    rows, leaked = [], set()
    for i in range(200):
        t = text(rng.randint(0, 400))
        if i % 9 == 0:
            k = i % 30
            w = items[k].split()
            if i % 2:  # a paraphrase: some words dropped, some put in
                w = [x for j, x in enumerate(w) if j % 6 or x.startswith("ans")]
                w.insert(7, "so")
            at = rng.randint(0, len(t))
            t = t[:at] + " " + " ".join(w).upper() + " " + t[at:]
            leaked.add((i, k))
        rows.append((i, t, "a"))
    rows.append((200, None, None))
    docs = frame(spark, rows)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in L.leaks(docs, bench).collect()}
    assert got == leaked
    assert L.leaks(docs.limit(0), bench).count() == 0 and L.leaks(docs, bench.limit(0)).count() == 0


def test_short_items_by_brute_force(spark):
    rng = random.Random(6)
    vocabulary = ["ka", "lo", "mi", "ne", "pu"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.randint(1, 5))) for k in range(40)] + [(None, "Ka, lo: mi ne"), (3, "pu pu pu pu"), (50, "?! -"), (51, None), (52, "absent")]
    rows = [(i, text(rng.randint(0, 12)), "a") for i in range(120)] + [(None, "PU pu (pu) pu", "a"), (7, "ka lo", "a"), (8, None, "a"), (9, " ", "a")]
    lists = lambda t: L.plain_words(t or "")
    want = {(d, t, k) for d, t, _ in rows for k, x in items if lists(x)
            and any(lists(t)[i:i + len(lists(x))] == lists(x) for i in range(len(lists(t))))}
    bench = spark.createDataFrame(items, "item_id long, text string")
    numbered = spark.createDataFrame([(i, t) for i, (_, t, _) in enumerate(rows)], "doc_id long, text string")
    found = L.leaks(numbered, bench).collect()
    got = {(rows[r.doc_id][0], rows[r.doc_id][1], r.item_id) for r in found}
    assert got == want and all((r.cosine, r.lcs_share, r.answer) == (1.0, 1.0, True) for r in found)
    assert len(found) == len({(r.doc_id, r.item_id) for r in found})
    assert {(r.doc_id, r.item_id) for r in L.leaks(frame(spark, rows), bench).collect()} == {(d, k) for d, _, k in want}


def test_leaks_in_blocks_and_stretches(spark, small, monkeypatch):
    """Blocks of a few items, texts far longer than a stretch and items without an id."""
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text")
    whole = {(r.doc_id, r.item_id) for r in L.leaks(small, bench).collect()}
    monkeypatch.setattr(L, "BLOCK_ITEMS", 4)
    assert {(r.doc_id, r.item_id) for r in L.leaks(small, bench).collect()} == whole
    monkeypatch.undo()
    some = bench.orderBy("item_id").limit(4).collect()
    filler = " ".join(f"w{i % 977}" for i in range(3 * L.STRETCH))
    docs = frame(spark, [(1, f"{filler} {some[2].text} {filler}", "a"), (2, filler, "a")])
    unnamed = spark.createDataFrame([(None, r.text) for r in some], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in L.leaks(docs, bench).collect()} == {(1, some[2].item_id)}
    assert [(r.doc_id, r.item_id) for r in L.leaks(docs, unnamed).collect()] == [(1, None)]


def test_candidates_against_exact_search(spark, small):
    """Items cut from the texts, a fifth of their words dropped; a cosine of -2 checks all pairs."""
    rng = random.Random(8)
    cut = []
    for _, t in pairs(small) * 2:
        w = t.split()
        at = rng.randint(0, max(0, len(w) - 40))
        cut.append(" ".join(x for x in w[at:at + rng.randint(14, 59)] if rng.random() > 0.2))
    bench = spark.createDataFrame(list(enumerate(cut)), "item_id long, text string")
    some = small.orderBy("doc_id").limit(40)
    got, exact = ({(r.doc_id, r.item_id) for r in L.leaks(some, bench, cosine=c).collect()} for c in (L.COSINE, -2.0))
    assert got <= exact and len(exact) >= 60 and len(got) >= 0.9 * len(exact)


def test_planted_benchmark_passages(spark, small):
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    items = {r.item_id: b" ".join(L.plain_words(r.text)) for r in bench.collect()}
    want = {(i, k) for i, t in pairs(small) for k, x in items.items() if x in b" ".join(L.plain_words(t))}
    assert want and {(r.doc_id, r.item_id) for r in L.leaks(small, bench).collect()} == want


def test_lcs():
    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    rng = random.Random(4)
    for _ in range(100):
        a, b = ([rng.randrange(6) for _ in range(rng.randint(1, 20))] for _ in range(2))
        masks = {}
        for i, w in enumerate(a):
            masks[w] = masks.get(w, 0) | (1 << i)
        assert L.lcs_words(masks, len(a), np.array(b)) == slow(a, b)
