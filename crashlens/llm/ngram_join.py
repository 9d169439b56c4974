"""Jaccard join of word n-gram sets by vertical partitioning, and its groups (operator 3).

Two documents link if ``100 * |A and B| >= similarity * |A or B|`` for their sets of distinct
shingles of ``words`` words (op3: 3 words, 90); the answer is a class per document, so equal
sets count once and links that join what is joined already need not be looked for. Below, q
is similarity / 100.

1. Order. Every shingle gets its frequency (units of documents send their distinct shingle
   fingerprints once, buckets count, see ``suffix_dedup``); the global order is rare first.
   A document with less than q of its shingles found elsewhere too links with nothing.
2. Classes. Equal sets collapse; a class goes by its set's fingerprint, not by a doc_id.
3. Stars. Linked sets share one of their first ``n - ceil(q n) + 1`` shingles. All
   that share one make a group; its hub is the set with the most common shingles. Only
   pairs with the hub are counted: a group of m sets gives m pairs, not m^2.
4. Overlaps. The order of fingerprints is cut into ``FRAGMENTS``; a pair's overlap is
   counted in each fragment apart and summed per pair.
5. Differences. Let D_x be the shingles in which x and the hub differ. With S = |x| + |y|,
   x and y link just if |D_x| + |D_y| - 2 |D_x and D_y| <= r S, r = (1 - q) / (1 + q). If D_x
   and D_y have nothing in common, that makes both link with the hub, so the pair adds
   nothing. Else one of them isn't linked with the hub and they share at least
   ``t = (|D_x| + |D_y| - r S) / 2`` differences, hence one of the first
   ``|D| - t + 1`` of each, rare first. What they share there bounds what they can share
   at all; pairs that may reach t, few, are counted as in 4. Differences that no other member
   has, u of them, part x from all: u_x + u_y <= r S, so one of the two is light,
   ``u <= r |x|``. Sets that all differ from the hub in ways of their own are heavy, and heavy
   sets are not compared with each other.
6. Components of the links, by smallest label with pointer jumping.

Fingerprints have 64 bits. Defined cases: null or empty text, or one without words: an
empty set that links with nothing; fewer than ``words`` words: the whole sequence as one
shingle. Rows that repeat a doc_id, or have none, are one document each, linked by their
texts alone; component_id is the smallest doc_id of a component, a null one counts as the
smallest. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crashlens.llm.common import parallelism, release_memory, scratch, worker_cache, written
from crashlens.llm.suffix_dedup import BUCKET_BYTES, _buckets_of, _pack, _unpack, make_units

WORDS, SIMILARITY = 3, 90  # of op3
FRAGMENTS = 8
UNIT_BYTES = 2 << 20
_MUL = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
REMEMBERED = 200_000
NULL_ID = -(2**63)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < REMEMBERED and len(word) <= 64:
            self[word] = h
        return h


def text_key(text: Column) -> Column:
    """A fingerprint that tells rows of one doc_id apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Shingles:
    """Distinct shingles of a unit's documents: ``doc`` (its number) and ``key``, sorted by both."""

    def __init__(self, row: pa.Table, n: int):
        release_memory()
        self.unit = row.column("unit")[0].as_py()
        self.ids = np.frombuffer(row.column("ids")[0].as_py(), "<i8")
        lengths = np.frombuffer(row.column("lengths")[0].as_py(), "<i8")
        text = zstandard.ZstdDecompressor().decompress(row.column("payload")[0].as_py(), max_output_size=max(1, int(lengths.sum())))
        at, words, counts, self.text_key = 0, [], [], []
        for size in lengths.tolist():
            raw = text[at:at + size]
            self.text_key.append(int(np.uint64(xxhash.xxh64_intdigest(raw, 42)).astype(np.int64)))  # as text_key() has it
            own = raw.lower().split()
            counts.append(len(own))
            words += own
            at += size
        counts = np.array(counts)
        h = np.fromiter(map(worker_cache("shingle words", _Words).__getitem__, words), np.uint64, len(words))
        doc = np.repeat(np.arange(len(counts)), counts)
        h = np.concatenate([h, np.zeros(n, np.uint64)])
        key = h[:-n] * _MUL[0]
        for k in range(1, n):
            key = _finish(key) * _MUL[k % len(_MUL)] + h[k:len(h) - n + k]
        left = np.repeat(np.cumsum(counts), counts) - np.arange(len(doc))
        whole = left >= n
        for d in np.flatnonzero((counts > 0) & (counts < n)):  # few words: all of them as one
            first = int(counts[:d].sum())
            key[first] = np.uint64(xxhash.xxh64_intdigest(b" ".join(words[first:first + counts[d]])))
            whole[first] = True
        key, doc = _finish(key[whole]), doc[whole]
        order = np.lexsort((key, doc))
        key, doc = key[order], doc[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        self.key, self.doc = key[new], doc[new]
        self.n = np.bincount(self.doc, minlength=len(counts))


def _frequencies(units: DataFrame, bits: int, buckets: int, words: int) -> DataFrame:
    """For every unit, the frequency class (bits of the number of units) of its distinct shingles."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                s = Shingles(pa.Table.from_batches([b.slice(i, 1)]), words)
                keys = np.unique(s.key >> np.uint64(64 - bits))
                edges = _buckets_of(keys, bits, buckets)
                full = np.flatnonzero(np.diff(edges))
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(full.astype(np.int32)), "unit": pa.array(np.full(len(full), s.unit, np.int64)),
                    "blob": pa.array([_pack(keys[edges[k]:edges[k + 1]]) for k in full], pa.binary())})

    def answer(rows: pa.Table) -> pa.Table:
        keys = [_unpack(x) for x in rows.column("blob").to_pylist()]
        every, counts = np.unique(np.concatenate(keys), return_counts=True)
        classes = np.frexp(counts.astype(float))[1].astype(np.uint8)  # 1: one unit, 2: two or three, ...
        squeeze = zstandard.ZstdCompressor(level=1)
        out = [squeeze.compress(classes[np.searchsorted(every, k)].tobytes()) for k in keys]
        return pa.table({"unit": rows.column("unit"), "bucket": rows.column("bucket"), "blob": pa.array(out, pa.binary())})

    sent = units.mapInArrow(send, "bucket int, unit long, blob binary")
    return written(sent.groupBy("bucket").applyInArrow(answer, "unit long, bucket int, blob binary"), "shingle-classes")


def _sets(units: DataFrame, classes: DataFrame, bits: int, words: int, similarity: int) -> DataFrame:
    """One row per document: id, text_key, n, fingerprint of its set (class) and, where it may link at all, its
    fragments, its first shared shingles and how common its shingles are."""

    def build(unit: pa.Table, answers: pa.Table) -> pa.Table:
        s = Shingles(unit, words)
        short = s.key >> np.uint64(64 - bits)
        keys, inverse, counts = np.unique(short, return_inverse=True, return_counts=True)
        parts = answers.sort_by("bucket").column("blob").to_pylist()
        found = np.frombuffer(b"".join(zstandard.ZstdDecompressor().decompress(x, max_output_size=len(keys) + 1) for x in parts), np.uint8)
        if len(found) != len(keys):
            raise ValueError(f"{len(found)} answers to {len(keys)} shingles of a unit")
        rank = found[inverse]
        shared = (rank > 1) | (counts[inverse] > 1)
        bounds = np.searchsorted(s.doc, np.arange(len(s.ids) + 1))
        enough = 100 * np.bincount(s.doc, weights=shared, minlength=len(s.ids)) >= similarity * s.n
        signed = s.key.view(np.int64)
        out: dict[str, list] = {k: [] for k in ("id", "text_key", "n", "class", "fragments", "prefix", "common")}
        for d in range(len(s.ids)):
            own = slice(bounds[d], bounds[d + 1])
            n = int(s.n[d])
            out["id"].append(int(s.ids[d]))
            out["text_key"].append(s.text_key[d])
            out["n"].append(n)
            if not n or not enough[d]:
                for k in ("class", "fragments", "prefix", "common"):
                    out[k].append(None)
                continue
            k, r = s.key[own], rank[own]
            order = np.lexsort((k, r))[: n - -(-similarity * n // 100) + 1]
            order = order[shared[own][order]]
            cuts = np.searchsorted(k >> np.uint64(61), np.arange(1, FRAGMENTS))
            out["class"].append(xxhash.xxh3_64_intdigest(k.tobytes()) >> 1)
            out["fragments"].append(np.split(signed[own], cuts))
            out["prefix"].append(signed[own][order])
            out["common"].append(float(r.astype(float).mean()))
        return pa.table(out, schema=pa.schema([("id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("class", pa.int64()), ("fragments", pa.list_(pa.list_(pa.int64()))),
                                               ("prefix", pa.list_(pa.int64())), ("common", pa.float64())]))

    assert FRAGMENTS == 8  # the upper three bits of a fingerprint
    return units.groupBy("unit").cogroup(classes.groupBy("unit")).applyInArrow(
        build, "id long, text_key long, n long, class long, fragments array<array<long>>, prefix array<long>, common double")


def overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """a, b, overlap: each fragment's overlap is counted apart, then summed per pair."""
    a = segments.select(F.col("id").alias("a"), "fragment", F.col("keys").alias("ka"))
    b = segments.select(F.col("id").alias("b"), "fragment", F.col("keys").alias("kb"))
    both = pairs.select("a", "b").join(a, "a").join(b, ["b", "fragment"])
    return both.select("a", "b", F.size(F.array_intersect("ka", "kb")).alias("part")).groupBy("a", "b").agg(F.sum("part").alias("overlap"))


def _linked(overlap: Column, na: Column, nb: Column, similarity: int) -> Column:
    return overlap * 100 >= (na + nb - overlap) * similarity


def links(sets: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Links (a, b) between classes that join all that any links join. ``sets``: one row per
    class with id, n, fragments, prefix, common."""
    share = (100 - similarity) / (100 + similarity)  # of both sizes: most shingles that linked sets differ in
    sizes = sets.select("id", "n")
    segments = sets.select("id", F.posexplode("fragments").alias("fragment", "keys"))
    members = sets.select("id", "common", F.explode("prefix").alias("g"))
    hubs = members.groupBy("g").agg(F.max(F.struct("common", -F.col("id"), "id")).alias("top"), F.count(F.lit(1)).alias("m")).where("m > 1").select("g", F.col("top.id").alias("hub"))
    stars = members.join(hubs, "g").where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    na, nb = sizes.select(F.col("id").alias("a"), F.col("n").alias("na")), sizes.select(F.col("id").alias("b"), F.col("n").alias("nb"))
    stars = written(stars, "stars")
    counted = stars.join(overlaps(stars, segments), ["a", "b"], "left").na.fill(0, ["overlap"]).join(na, "a").join(nb, "b")
    counted = written(counted.withColumn("near", _linked(F.col("overlap"), F.col("na"), F.col("nb"), similarity)), "star-overlaps")
    near = counted.where("near").select("a", "b")

    # Differences from the hub; a difference is a shingle that just one of the two has.
    ka = segments.select(F.col("id").alias("a"), "fragment", F.col("keys").alias("ka"))
    kb = segments.select(F.col("id").alias("b"), "fragment", F.col("keys").alias("kb"))
    some = counted.where(~F.col("near")).select("a").distinct()  # hubs that have all their members near are done
    open_ = counted.join(some, "a", "left_semi")
    apart = open_.join(ka, "a").join(kb, ["b", "fragment"]).select(
        "a", "b", "na", "nb", "near", (F.col("na") + F.col("nb") - 2 * F.col("overlap")).alias("d"),
        F.explode(F.concat(F.array_except("ka", "kb"), F.array_except("kb", "ka"))).alias("e"))
    # Fewest differences to share with any partner that matters (see above), at least one.
    least = F.when(F.col("near"), (F.col("d") + (F.col("na") - F.col("nb")) * share) / 2.0).otherwise(
        (F.col("d") + 1 - (F.col("nb") + F.floor(F.col("nb") * 100 / similarity)) * share) / 2.0)
    apart = written(apart.withColumn("t", F.greatest(F.lit(1), F.ceil(least - 1e-9))), "differences")
    rarity = apart.groupBy("a", "e").agg(F.count(F.lit(1)).alias("f"), F.max((~F.col("near")).cast("int")).alias("open")).where("f > 1 and open = 1")
    # Of each document: its differences, those that nobody shares or that only near ones share first.
    ranked = apart.join(rarity, ["a", "e"], "left").groupBy("a", "b", "near", "nb", "d", "t").agg(
        F.count("f").alias("s"),
        F.slice(F.sort_array(F.collect_list(F.struct(F.coalesce("f", F.lit(0)).alias("f"), "e"))), F.lit(1), F.greatest(F.lit(0), (F.col("d") - F.col("t") + 1)).cast("int")).alias("first"))
    # s differences are shared with others; of two sets that link, one is light (see above).
    light = F.col("d") - F.col("s") <= F.col("nb") * share + 1e-9
    ranked = ranked.select("a", "b", "near", "nb", "d", "t", "s", light.alias("light"), F.explode("first").alias("x")).where("x.f > 0").withColumn("e", F.col("x.e")).drop("x")
    ranked = written(ranked, "first-differences")

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("a", "e", F.col("b").alias(name), *[F.col(c).alias(f"{k}{name}") for c, k in (("nb", "n"), ("d", "d"), ("t", "t"), ("s", "s"), ("near", "near_"), ("light", "light_"))])

    # Sizes within the limit, and few enough differences even if all that the smaller side shares is common to both.
    both = F.col("nx") + F.col("ny")
    fits = (F.col("nx") * 100 >= F.col("ny") * similarity) & (F.col("ny") * 100 >= F.col("nx") * similarity) & (F.col("dx") + F.col("dy") - 2 * F.least("sx", "sy") <= both * share + 1e-9)
    once = F.col("near_y") | ~F.col("light_y") | (F.col("x") < F.col("y"))
    met = side(ranked.where("light and not near"), "x").join(side(ranked, "y"), ["a", "e"]).where((F.col("x") != F.col("y")) & fits & once).unionByName(
        side(ranked.where("not light and not near"), "x").join(side(ranked.where("light and near"), "y"), ["a", "e"]).where(fits))
    pairs = met.groupBy("a", "x", "y").agg(F.count(F.lit(1)).alias("seen"), *[F.first(c).alias(c) for c in ("nx", "ny", "dx", "dy", "tx", "ty")])
    # Differences shared but not seen lie behind the first ones of that of the two whose first ones end earlier.
    needed = (F.col("dx") + F.col("dy") - (F.col("nx") + F.col("ny")) * share) / 2.0
    pairs = pairs.where(F.col("seen") + F.greatest("tx", "ty") - 1 >= needed - 1e-9)
    pairs = written(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "difference-pairs")
    more = overlaps(pairs, segments).join(na, "a").join(nb, "b").where(_linked(F.col("overlap"), F.col("na"), F.col("nb"), similarity)).select("a", "b")
    return written(near.unionByName(more), "links")


def components(edges: DataFrame) -> DataFrame:
    """v, c: the smallest node each node of the links can reach. Labels are written after
    each round; rounds grow with the logarithm of a component's length."""
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("w")).unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("w"))).distinct()
    both = written(both, "edges")
    labels = written(both.groupBy("v").agg(F.least(F.col("v"), F.min("w")).alias("c")), "labels")
    while True:
        seen = both.join(labels.select(F.col("v").alias("w"), F.col("c").alias("cw")), "w").groupBy("v").agg(F.min("cw").alias("m"))
        stepped = labels.join(seen, "v").select("v", F.col("c").alias("old"), F.least("c", "m").alias("c"))
        up = labels.select(F.col("v").alias("c"), F.col("c").alias("up"))
        new = written(stepped.join(up, "c").select("v", F.least("c", "up").alias("c"), (F.least("c", "up") != F.col("old")).cast("long").alias("changed")), "labels")
        labels = new.select("v", "c")
        if not new.agg(F.sum("changed")).first()[0]:
            return labels


def components_of(docs: DataFrame, unit_bytes: int = UNIT_BYTES, words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, by shingles of so many words and a
    similarity of so many hundredths. The result is written; what it was
    made from is deleted."""
    with scratch(docs.sparkSession):
        rows = _components_of(docs, unit_bytes, words, similarity)
        return written(rows.select(F.nullif("id", F.lit(NULL_ID)).alias("doc_id"), F.col("n").alias("n_shingles"), F.nullif("component_id", F.lit(NULL_ID)).alias("component_id")),
                       "components", keep=True)


def representatives(docs: DataFrame, unit_bytes: int = UNIT_BYTES, words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id and text_key of one document of each component: that of the smallest doc_id.
    Documents that link with nothing are all there."""
    with scratch(docs.sparkSession):
        rows = _components_of(docs, unit_bytes, words, similarity).where("stays")
        return written(rows.select(F.nullif("id", F.lit(NULL_ID)).alias("doc_id"), "text_key").distinct(), "representatives", keep=True)


def _components_of(docs: DataFrame, unit_bytes: int, words: int, similarity: int) -> DataFrame:
    """Per document: id, text_key, n, component_id, and whether it is its component's representative."""
    units = make_units(docs, unit_bytes)
    size = 4 * (units.agg(F.sum(F.octet_length("payload"))).first()[0] or 0)
    buckets = max(parallelism(docs.sparkSession), size // BUCKET_BYTES + 1)
    bits = min(64, max(34, math.ceil(math.log2(size / 6 + 1)) + 10))
    sets = written(_sets(units, _frequencies(units, bits, buckets, words), bits, words, similarity), "sets")
    rows = sets.select("id", "text_key", "n", "class")
    first = rows.where(F.col("class").isNotNull()).groupBy("class").agg(F.min(F.struct("id", "text_key")).alias("first"))
    classes = written(first.select("class", F.col("first.id").alias("id"), F.col("first.text_key").alias("text_key")), "class-firsts")
    leaders = sets.join(classes, ["class", "id", "text_key"], "left_semi").dropDuplicates(["class"])
    leaders = written(leaders.select(F.col("class").alias("id"), "n", "fragments", "prefix", "common"), "classes")
    labels = components(links(leaders, similarity))
    labelled = classes.join(labels, F.col("class") == F.col("v"), "left").select("class", F.coalesce("c", "class").alias("c"), F.struct("id", "text_key").alias("first"))
    tops = labelled.groupBy("c").agg(F.min("first").alias("top"))
    tops = written(labelled.select("class", "c").join(tops, "c").select("class", "top"), "tops")
    rows = rows.join(tops, "class", "left")
    return rows.select("id", "text_key", "n", F.coalesce("top.id", "id").alias("component_id"),
                       (F.col("top").isNull() | ((F.col("top.id") == F.col("id")) & (F.col("top.text_key") == F.col("text_key")))).alias("stays"))
