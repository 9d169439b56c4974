"""Id shards, source mixing and the pipeline."""

import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from crashlens.llm import id_shards as I
from crashlens.llm import mixing as M
from crashlens.llm.common import setting, table
from crashlens.llm.queries import op10_mixing
from tests.conftest import SF001
from tests.llm.conftest import frame, pairs
from tests.llm.test_duplicates import _groups

PATH = public_tokenizers.path("word_bpe_49k.json")


def _digests(rows):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for i, t in rows:
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def test_digests_match_the_library(odd, small, empty):
    for docs in (odd, small, empty):
        assert sorted((tuple(r) for r in I.stored_digests(docs, PATH).collect()), key=str) == _digests(pairs(docs))


def test_odd_texts_encode_as_the_library():
    import json

    tokenizer = Tokenizer.from_file(PATH)
    words = I.WordIds(open(PATH, encoding="utf-8").read(), "<u2")
    for t in ("", " ", "\n", "A\t B  c\x1cd", "a<|endoftext|>b <|startoftext|> x<|endoftext|>. ", "é ́a \r\n 漢字 \U0001F600", "x" * 300,
              "don't 123 it's", " 's ΑΣ ΑΣ. İi. İ. a., .a ,, it's.", json.dumps({"k": "v,"}),
              "İstanbul İ. İ. ΣΑΣ, \u0958! \ufb1d. Erin erin, ERIN!? erin### a\u0338= b!\u0301? d_e_ " + "A" * 300 + "!!!"):
        assert np.frombuffer(words.encode(t), "<u2").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_access_by_key(spark, small):
    store = I.write_store(small, PATH)
    tokenizer = Tokenizer.from_file(PATH)
    rows = dict(pairs(small))
    for key in (0, 7, max(rows)):
        assert store.get(key) == [*tokenizer.encode(rows[key], add_special_tokens=False).ids, 2]
    assert store.get(10**12) is None


def test_access_opens_one_file_of_each_table(spark, small, monkeypatch):
    """Every other file is made unreadable first."""
    monkeypatch.setattr(I, "BUCKET_KEYS", 16)
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        store = I.write_store(small, PATH)
    tokenizer = Tokenizer.from_file(PATH)
    key = 7
    bucket = int(I.bucket_of(np.array([key], np.int64), store.buckets)[0])
    part = store.locate(spark.createDataFrame([(key,)], "key long")).first()["part"]
    needed = {r["file"] for r in store.files.collect() if (r["kind"], r["number"]) in (("ids", part), ("index", bucket))}
    others = [f for t in (store.ids, store.index) for f in t.inputFiles() if f.rsplit("/", 1)[1] not in needed]
    assert len(needed) == 2 and len(others) > 4 and len(store.files.inputFiles()) == 1
    for f in others:
        with open(f.replace("file://", ""), "wb") as out:
            out.write(b"unreadable")
    assert store.get(key) == [*tokenizer.encode(dict(pairs(small))[key], add_special_tokens=False).ids, 2]


def test_access_to_an_empty_store(empty):
    assert I.write_store(empty, PATH).get(1) is None


@pytest.mark.parametrize("n", [1, 2, 5, 1000, 20000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(-(2**62), 2**62, n))
    slots = I.slots_of(keys, I.build_mph(keys), len(keys))
    assert sorted(slots.tolist()) == list(range(len(keys)))


def _targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > 3 * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = 3.0 * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= set(over)
    return out


def _check_mix(docs):
    rows = M.mix(docs).collect()
    assert len(rows) == docs.count()
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        assert r.position is None or 0 <= r.position <= 1
    targets = _targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - targets[r.source]) < 1e-6 * (1 + r.target)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 0.5 * largest[s] + 1e-6
    return rows


def test_mix(small, odd):
    rows = _check_mix(small)
    assert sorted(map(tuple, M.mix(small).collect())) == sorted(map(tuple, rows))
    _check_mix(odd)


def test_small_sources_fill_up(spark):
    rows = [(i, "w " * 10, "a") for i in range(3)] + [(10 + i, "w " * 20, "b") for i in range(100)] + [(200 + i, "w " * 5, None) for i in range(40)]
    _check_mix(frame(spark, rows))


def test_sizes_of_nothing(spark, empty):
    assert M.mix(empty).collect() == []
    assert [(r.size, r.taken, r.target) for r in M.mix(frame(spark, [(1, None, "a"), (2, " ", None)])).collect()] == [(0, 0, 0.0)] * 2


def test_training_order_follows_the_schedules(spark):
    docs = frame(spark, [(i, "w " * 10, s) for s, a in (("a", 0), ("b", 1000), ("c", 2000)) for i in range(a, a + 400)])
    order = M.training_order(docs, slopes=(0.9, -0.9, 0.0), weights=(1.0, 1.0, 1.0))
    assert order.columns == docs.columns
    sources = [r.source for r in order.select("source").collect()]
    assert len(sources) == 1200
    half = sources[:600]  # a: integral of 1 + 0.9 (2u - 1) up to the middle
    assert abs(half.count("c") - 200) < 30 and half.count("a") < 150 and half.count("b") > 250


def test_positions_invert_the_integrated_schedule(spark):
    """Copies and their times by summing the schedule step by step; the rows come in that order."""
    rows = [(i, "w " * (1 + i % 7), s) for s, a, n in (("a", 0, 40), ("b", 1000, 300), (None, 2000, 200)) for i in range(a, a + n)] + [(3000, " ", "a")]
    with setting(spark, "spark.sql.shuffle.partitions", "5"):
        got = M.mix(frame(spark, rows)).collect()
    u = np.linspace(0, 1, 20_001)
    for source, slope in (("a", 0.0), ("b", 0.6), (None, -0.6)):
        own = [r for r in got if r.source == source]
        rate = own[0].target * (1 + slope * (2 * u - 1))
        demand = np.r_[0, np.cumsum((rate[1:] + rate[:-1]) / 2 * (u[1] - u[0]))]
        for r in own:
            words = [r.before + r.size / 2 + k * r.source_size for k in range(3)] if r.size else []
            times = [np.interp(w, demand, u) for w in words if w <= r.target]
            assert np.allclose(r.positions, times, atol=1e-4) and len(r.positions) == r.copies and r.taken == r.copies * r.size
            assert r.position == (r.positions[0] if r.positions else None)
    order = [(r.position is None, r.position or 0, r.doc_id) for r in got]
    assert len(got) == len(rows) and {len(r.positions) for r in got} >= {0, 1, 3} and order == sorted(order)


def test_query_is_range_sorted(spark):
    got = op10_mixing(spark, SF001).select("position", "doc_id").collect()
    order = [(r.position is None, r.position or 0) for r in got]
    assert len(got) > 50 and order == sorted(order)


def test_pipeline_by_brute_force(spark):
    docs = table(spark, SF001, "documents")
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF001)
        frames[name] = (docs, out)
        if name != "token_ids":
            assert out.columns == docs.columns
        docs = out.cache()
    toxic_in, toxic_out = frames["toxicity"]
    assert 0 < toxic_out.count() < toxic_in.count()
    near_in, near_out = frames["near_duplicates"]
    assert {r.doc_id for r in near_out.collect()} == {i for i, _, c in _groups(pairs(near_in), 5, 80) if i == c}
    leak_in, leak_out = frames["decontamination"]
    gone = {r.doc_id for r in leak_in.select("doc_id").collect()} - {r.doc_id for r in leak_out.select("doc_id").collect()}
    words = lambda t: re.findall("[a-z0-9]+", (t or "").lower())
    items = [words(r.text) for r in table(spark, SF001, "benchmark").collect()]
    whole = {r.doc_id for r in leak_in.select("doc_id", "text").collect() for w in [" " + " ".join(words(r.text)) + " "] if any(" " + " ".join(x) + " " in w for x in items if len(x) >= 6)}
    assert whole and whole <= gone and len(gone) <= 3 * len(whole)
    mix_in, mix_out = frames["mixing"]
    copies = {r.doc_id: r.copies for r in M.mix(mix_in).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in mix_out.groupBy("doc_id").count().collect()} == copies
    ids_in, ids_out = frames["token_ids"]
    assert sorted((tuple(r) for r in ids_out.collect()), key=str) == _digests(pairs(ids_in))


def test_leaks_go_by_their_own_text(spark, odd, empty):
    """Rows without an id, or of one id, are judged one by one."""
    item = table(spark, SF001, "benchmark").orderBy("item_id").first().text
    rows = [(None, f"Something before. {item} Something after."), (None, "a clean row without an id"), (7, item), (7, "a clean row of the same id"), (8, None), (8, "")]
    docs = frame(spark, [(i, t, "a") for i, t in rows])
    kept = corpus_pipeline.drop_leaks(spark, docs, SF001)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([rows[1], rows[3], rows[4], rows[5]], key=str)
    assert corpus_pipeline.drop_leaks(spark, odd, SF001).count() == odd.count()
    assert corpus_pipeline.drop_leaks(spark, empty, SF001).collect() == []


def test_pipeline_on_odd_rows(spark, odd, empty):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF001)
        assert docs.select(F.count("doc_id")).first()[0] >= 0
