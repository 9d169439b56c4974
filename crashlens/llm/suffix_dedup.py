"""Removal of repeated 50-byte strings by blockwise suffix sorting (operator 1).

A suffix array of the whole corpus would need a shuffled record per byte. The blockwise
construction over a difference cover needs far less, and bounded memory per task:

* Cover. ``D`` is a perfect difference set modulo ``v`` = 21: for any two places i, j there
  is a shift d < v that puts both i + d and j + d on places whose remainder is in ``D``.
  Two equal 50-byte strings therefore hold a pair of cover places at the same shift, with
  30 equal bytes behind it. Only cover suffixes (5 in 21) are sorted.
* Ranks. Cover suffixes are dealt into buckets by the fingerprint of their first 30 bytes
  and a bucket is sorted by one task at a time; equal neighbours get the same rank. A cover
  suffix whose rank is its own alone is out: no 50-byte string through it repeats.
* Long ties. Suffixes of a shared rank are sorted again, bucket by bucket, by the
  fingerprint of all that strings through them can touch (20 bytes before, 50 after, with
  the text's ends). Equal: every string through them is equal, and those of the smallest
  document stay. Ranks whose members differ there are contested.
* Strings through contested cover suffixes are compared one by one, in a last sorting pass.

Documents are cut into units of ``UNIT_BYTES`` in doc_id order, so the order of units
settles which of two is smaller and no ids travel. A unit sends a distinct fingerprint once
(a passage that fills a third of the table costs one entry per unit); the answer is a bit
string in the order of what was sent. Fingerprints: equality in the second pass is that of
76 bits or more, in the third of 64 bits; a false hit among n strings has a chance of
n^2 / 2^65 at most.

Defined cases: a null text is the empty one. Rows that repeat a doc_id are no smaller than
each other, so nothing is removed between them. A null doc_id counts as the smallest. Texts
below 50 bytes keep everything. An empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlens.llm.common import drop_caches, parallelism, release_memory, texts, written

LENGTH = 50
UNIT_BYTES = 2 << 20
BUCKET_BYTES = 16 << 20
#: A perfect difference set: each remainder modulo 21 is a difference of two members.
MODULUS, COVER = 21, (0, 1, 4, 14, 16)
REACH = MODULUS - 1  # the largest shift
NAME = LENGTH - REACH  # bytes that a cover suffix is ranked by
UNIT_SCHEMA = "unit long, ids binary, lengths binary, payload binary"
SENT = "bucket int, unit long, blob binary"
ANSWER = "unit long, pass int, bucket int, blob binary"
_MUL = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
_BYTE = np.random.default_rng(50).integers(0, 2**64, 257, dtype=np.uint64)  # 256: beyond a text's end


def _join(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    h = a * _MUL[k]
    h += b
    h ^= h >> np.uint64(29)
    return h


class Unit:
    """The documents of a unit, with ``LENGTH`` empty places before, between and after them."""

    def __init__(self, row: pa.Table, bits: int):
        self.bits = bits
        self.unit = row.column("unit")[0].as_py()
        self.ids = np.frombuffer(row.column("ids")[0].as_py(), "<i8")
        self.lengths = np.frombuffer(row.column("lengths")[0].as_py(), "<i8")
        self.text = zstandard.ZstdDecompressor().decompress(row.column("payload")[0].as_py(), max_output_size=max(1, int(self.lengths.sum())))
        n = len(self.lengths)
        self.starts = np.cumsum(self.lengths + LENGTH) - self.lengths  # padded places
        self.size = int(self.lengths.sum() + (n + 1) * LENGTH)
        self.rank = np.cumsum(np.r_[False, self.ids[1:] != self.ids[:-1]])
        place = np.repeat(self.starts - (np.cumsum(self.lengths) - self.lengths), self.lengths) + np.arange(int(self.lengths.sum()))
        h = np.full(self.size, _BYTE[256])
        h[place] = _BYTE[np.frombuffer(self.text, np.uint8)]
        step, self.h = 1, {}
        for k in range(5):  # fingerprints of 2, 4, 8, 16, 32 places
            h = _join(h, np.concatenate([h[step:], np.full(step, _BYTE[256])]), k)
            step *= 2
            if step >= 16:
                self.h[step] = h
        local = place - np.repeat(self.starts, self.lengths)
        left = np.repeat(self.lengths, self.lengths) - local
        cover = np.zeros(MODULUS, bool)
        cover[list(COVER)] = True
        chosen = cover[local % MODULUS] & (left >= NAME) & (np.repeat(self.lengths, self.lengths) >= LENGTH)
        self.cover = place[chosen]
        self.doc = np.repeat(np.arange(n), self.lengths)[chosen]
        self.valid = np.zeros(self.size, bool)
        self.valid[place[left >= LENGTH]] = True
        h16 = self.h[16]
        self.name = _join(h16[self.cover], h16[self.cover + (NAME - 16)], 5) >> np.uint64(64 - bits)

    def names(self):
        """Distinct ranks keys in order, their counts, and the key number of each cover place."""
        keys, inverse, counts = np.unique(self.name, return_inverse=True, return_counts=True)
        return keys, inverse, counts

    def contexts(self, at: np.ndarray) -> np.ndarray:
        h32 = self.h[32]
        return _join(_join(h32[at - REACH], h32[at - REACH + 32], 0), h32[at + LENGTH - 32], 1)

    def strings(self, at: np.ndarray) -> np.ndarray:
        h32 = self.h[32]
        return _join(h32[at], h32[at + LENGTH - 32], 2)


def _buckets_of(keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Borders of the buckets within sorted keys: equal ranges of the key space."""
    edges = [min((b << bits) // buckets, 2**64 - 1) for b in range(1, buckets)]
    return np.r_[0, np.searchsorted(keys, np.array(edges, np.uint64)), len(keys)]


def _pack(keys: np.ndarray) -> bytes:
    """Sorted keys as gaps of equal width."""
    gaps = np.diff(keys, prepend=np.uint64(0)) if len(keys) else keys
    first, gaps = (int(gaps[0]), gaps[1:]) if len(keys) else (0, gaps)
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    raw = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + first.to_bytes(8, "little") + raw.tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    width = blob[0]
    raw = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, width)
    gaps = np.zeros((len(raw) + 1, 8), np.uint8)
    gaps[1:, :width] = raw
    gaps = gaps.view("<u8").ravel()
    gaps[0] = int.from_bytes(blob[1:9], "little")
    return np.cumsum(gaps, dtype=np.uint64)


def _sent(unit: int, keys: np.ndarray, bits: int, buckets: int, more: np.ndarray | None = None) -> pa.Table:
    """A row for each bucket that gets something; ``more``: six bytes beside each key."""
    edges = _buckets_of(keys, bits, buckets)
    full = np.flatnonzero(np.diff(edges))
    blobs = []
    for b in full:
        own = slice(edges[b], edges[b + 1])
        if more is None:
            blobs.append(_pack(keys[own]))
        else:
            head = _pack(keys[own])
            blobs.append(len(head).to_bytes(4, "little") + head + more[own].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes())
    return pa.table({"bucket": pa.array(full.astype(np.int32)), "unit": pa.array(np.full(len(full), unit, np.int64)), "blob": pa.array(blobs, pa.binary())})


def _answers(rows: pa.Table, number: int, blobs: list[bytes]) -> pa.Table:
    n = rows.num_rows
    return pa.table({"unit": rows.column("unit"), "pass": pa.array(np.full(n, number, np.int32)), "bucket": rows.column("bucket"), "blob": pa.array(blobs, pa.binary())})


def _answered(rows: pa.Table, number: int, n: int, flags: int = 1) -> np.ndarray:
    """Flags of the n sent entries, from a unit's answers in bucket order."""
    picked = rows.filter(pa.compute.equal(rows.column("pass"), number)).sort_by("bucket")
    parts = []
    for blob in picked.column("blob").to_pylist():
        m = int.from_bytes(blob[:4], "little")
        parts.append(np.unpackbits(np.frombuffer(blob, np.uint8, offset=4), count=m * flags).reshape(m, flags).astype(bool))
    out = np.concatenate(parts) if parts else np.zeros((0, flags), bool)
    if len(out) != n:
        raise ValueError(f"{len(out)} answers to {n} entries of a unit")
    return out


def _flagged(flags: np.ndarray) -> bytes:
    return len(flags).to_bytes(4, "little") + np.packbits(flags.ravel()).tobytes()


def _spread(n: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(n)), n)


def make_units(docs: DataFrame, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """Documents in doc_id order, packed into units; written, so that later passes read the same units."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        part, seq, held, ids, found = TaskContext.get().partitionId(), 0, 0, [], []
        squeeze = zstandard.ZstdCompressor(level=3)

        def unit():
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + seq], pa.int64()), pa.array([np.array(ids, "<i8").tobytes()]),
                 pa.array([np.array([len(x) for x in found], "<i8").tobytes()]), pa.array([squeeze.compress(b"".join(found))])],
                names=["unit", "ids", "lengths", "payload"])

        for b in batches:
            for i, raw in zip(b.column("id").to_pylist(), b.column("raw").to_pylist()):
                if held >= unit_bytes and i != ids[-1]:
                    yield unit()
                    seq, held, ids, found = seq + 1, 0, [], []
                ids.append(i)
                found.append(raw)
                held += len(raw) + LENGTH
        if ids:
            yield unit()
        ids, found = [], []
        release_memory()

    rows = texts(docs).select(F.coalesce("doc_id", F.lit(-(2**63))).alias("id"), F.encode("text", "UTF-8").alias("raw"))
    rows = rows.repartitionByRange(parallelism(docs.sparkSession), "id").sortWithinPartitions("id")
    return written(rows.mapInArrow(pack, UNIT_SCHEMA), "units")


# --- the three passes -------------------------------------------------------------------


def _selected(u: Unit, answers: pa.Table):
    """Cover places of a shared rank: key and context of each distinct pair, in order, the
    pair of each place, and whether a smaller document of the unit has the same pair."""
    keys, inverse, counts = u.names()
    shared = _answered(answers, 1, len(keys))[:, 0] | (counts > 1)
    pick = shared[inverse]
    at, doc, key = u.cover[pick], u.doc[pick], u.name[pick]
    context = u.contexts(at) >> np.uint64(16)
    order = np.lexsort((at, context, key))
    key, context, at, doc = key[order], context[order], at[order], doc[order]
    new = np.r_[True, (key[1:] != key[:-1]) | (context[1:] != context[:-1])] if len(key) else np.zeros(0, bool)
    pair = np.cumsum(new) - 1
    lead = u.rank[doc[new]] if len(key) else np.zeros(0, np.int64)
    behind = u.rank[doc] > lead[pair] if len(key) else np.zeros(0, bool)
    return key[new], context[new], pair, at, behind


def _contested(u: Unit, answers: pa.Table):
    """Starts of removed strings, and the distinct fingerprints, places and lead of contested ones."""
    keys, _, pair, at, behind = _selected(u, answers)
    flags = _answered(answers, 2, len(keys), 2)
    removed, open_ = np.zeros(u.size, bool), np.zeros(u.size, bool)
    gone = flags[pair, 0] | behind
    for mask, rows in ((removed, at[gone]), (open_, at[flags[pair, 1] & ~gone])):
        for d in range(REACH + 1):
            mask[rows - d] = True
    removed &= u.valid
    places = np.flatnonzero(open_ & u.valid & ~removed)
    strings, first, inverse = np.unique(u.strings(places), return_index=True, return_inverse=True)
    return removed, places, strings, first, inverse


def _smaller(units: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort entries by keys, then unit: the order, where a new key starts, and whether an entry isn't its key's first."""
    order = np.lexsort((units, *reversed(keys)))
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
        for k in keys:
            new[1:] |= k[order][1:] != k[order][:-1]
    return order, new, ~new


def removed_bytes(docs: DataFrame, unit_bytes: int = UNIT_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    units = make_units(docs, unit_bytes)
    total = units.agg(F.sum(F.octet_length("lengths")), F.sum(F.octet_length("payload"))).first()
    # Sizes follow the input: about four text bytes to a compressed one at most.
    size = 4 * (total[1] or 0) + LENGTH * (total[0] or 0) // 8
    buckets = max(parallelism(docs.sparkSession), size // bucket_bytes + 1)
    bits = min(64, max(34, math.ceil(math.log2(size / 4 + 1)) + 10))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                u = Unit(pa.Table.from_batches([b.slice(i, 1)]), bits)
                yield from _sent(u.unit, u.names()[0], bits, buckets).to_batches()

    def shared_ranks(rows: pa.Table) -> pa.Table:
        keys = [_unpack(x) for x in rows.column("blob").to_pylist()]
        every = np.sort(np.concatenate(keys))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        out = []
        for k in keys:
            at = np.searchsorted(twice, k)
            at[at == len(twice)] = 0
            out.append(_flagged(twice[at] == k if len(twice) else np.zeros(len(k), bool)))
        return _answers(rows, 1, out)

    def ties(own: pa.Table, answers: pa.Table) -> pa.Table:
        u = Unit(own, bits)
        keys, contexts, *_ = _selected(u, answers)
        return _sent(u.unit, keys, bits, buckets, contexts)

    def resolve(rows: pa.Table) -> pa.Table:
        keys, contexts = [], []
        for blob in rows.column("blob").to_pylist():
            head = int.from_bytes(blob[:4], "little")
            keys.append(_unpack(blob[4:4 + head]))
            raw = np.zeros((len(keys[-1]), 8), np.uint8)
            raw[:, :6] = np.frombuffer(blob, np.uint8, offset=4 + head).reshape(-1, 6)
            contexts.append(raw.view("<u8").ravel())
        sizes = np.array([len(k) for k in keys])
        rank_of = np.argsort(np.argsort(rows.column("unit").to_numpy(), kind="stable"), kind="stable")
        key, context, unit = np.concatenate(keys), np.concatenate(contexts), rank_of[_spread(sizes)]
        order, new, behind = _smaller(unit, key, context)
        k = key[order]
        group = np.cumsum(np.r_[True, k[1:] != k[:-1]]) - 1  # entries of a rank
        several = np.bincount(group, weights=new)[group] > 1
        flags = np.zeros((len(order), 2), bool)
        flags[order, 0], flags[order, 1] = behind, several
        return _answers(rows, 2, [_flagged(x) for x in np.split(flags, np.cumsum(sizes)[:-1])])

    def contested(own: pa.Table, answers: pa.Table) -> pa.Table:
        u = Unit(own, bits)
        return _sent(u.unit, _contested(u, answers)[2], 64, buckets)

    def compare(rows: pa.Table) -> pa.Table:
        keys = [_unpack(x) for x in rows.column("blob").to_pylist()]
        sizes = np.array([len(k) for k in keys])
        rank_of = np.argsort(np.argsort(rows.column("unit").to_numpy(), kind="stable"), kind="stable")
        order, _, behind = _smaller(rank_of[_spread(sizes)], np.concatenate(keys))
        flags = np.zeros(len(order), bool)
        flags[order] = behind
        return _answers(rows, 3, [_flagged(x) for x in np.split(flags, np.cumsum(sizes)[:-1])])

    def cut(own: pa.Table, answers: pa.Table) -> pa.Table:
        u = Unit(own, bits)
        removed, places, strings, first, inverse = _contested(u, answers)
        if len(places):
            doc = np.searchsorted(u.starts, places, side="right") - 1
            behind = u.rank[doc] > u.rank[doc[first]][inverse]
            removed[places[behind | _answered(answers, 3, len(strings))[:, 0][inverse]]] = True
        ends = np.zeros(u.size + 1, np.int32)
        at = np.flatnonzero(removed)
        ends[at] += 1
        ends[at + LENGTH] -= 1
        covered = np.cumsum(ends)[:-1] > 0
        text = np.frombuffer(u.text, np.uint8)
        out, base = {"n_removed": [], "n_spans": [], "kept_sha256": []}, 0
        for start, n in zip(u.starts.tolist(), u.lengths.tolist()):
            c = covered[start:start + n]
            whole = text[base:base + n]
            out["n_removed"].append(int(c.sum()))
            out["n_spans"].append(int(c[:1].sum() + (c[1:] & ~c[:-1]).sum()))
            out["kept_sha256"].append(hashlib.sha256(whole[~c].tobytes() if out["n_removed"][-1] else whole.tobytes()).hexdigest())
            base += n
        return pa.table({"id": pa.array(u.ids), "n_bytes": pa.array(u.lengths), **{k: pa.array(v, pa.string() if k == "kept_sha256" else pa.int64()) for k, v in out.items()}})

    answers = None
    for number, (ask, answer) in enumerate(((rank, shared_ranks), (ties, resolve), (contested, compare)), 1):
        sent = units.mapInArrow(ask, SENT) if answers is None else units.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(ask, SENT)
        got = written(sent.groupBy("bucket").applyInArrow(answer, ANSWER), f"answers-{number}")
        answers = got if answers is None else answers.unionByName(got)
    rows = units.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(
        cut, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return rows.select(F.nullif("id", F.lit(-(2**63))).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
