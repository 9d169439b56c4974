"""Token-id shards with a minimal perfect hash index (operator 9).

Written tables:

* ``ids``: one row per shard: ``part, seq`` (ascending in doc_id order), ``n_docs``,
  ``n_ids``, ``keys`` (64-bit little-endian document keys), ``lengths`` (32-bit) and
  ``payload``, the raw ids of all its documents one after the other (16-bit little-endian
  where the vocabulary allows, else 32-bit). A shard closes at ``SHARD_IDS`` ids.
* ``index``: one row per hash bucket of keys: ``bucket, n, seeds, slots``. ``seeds`` is a
  hash-and-displace minimal perfect hash over the bucket's keys; slot i holds the key's
  32-bit fingerprint, its shard, its record within the shard and the id offset there.

* ``files``: which file holds a part of ``ids`` or a bucket of ``index``: ``kind, number, file``,
  a row per part and one per ``BUCKET_KEYS`` documents, in one file ordered by them.

Access by key costs one bucket row, two hashes, one slot, one shard row, and opens three files:
the list, one of ``index`` and one of ``ids``, whatever the size of the tables; a key that isn't
there is told by its fingerprint (a wrong hit has a chance of 2^-32).

Defined cases: a null text is the empty text (only the end id); rows that repeat a doc_id
are written one after the other and the key leads to the first of them, reading yields all;
a null doc_id sorts first under the key -2^63. A very long document makes one long shard.
An empty table gives empty tables. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from string import punctuation
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crashlens.llm.common import parallelism, release_memory, texts, worker_cache, written

END_ID = 2
SHARD_IDS = 1 << 19
BUCKET_KEYS = 1 << 15
#: A worker remembers the ids of so many words of at most so many characters.
REMEMBERED, LONGEST = 400_000, 64
AT_ONCE = 250
NULL_KEY = -(2**63)
SLOT = np.dtype([("fingerprint", "<u4"), ("part", "<i4"), ("seq", "<i4"), ("record", "<i4"), ("offset", "<i8")])


class WordIds:
    """Ids of texts as raw bytes, word by word. The tokenizer's normalizer and pre-tokenizer
    drop white space and never join across it, so a text is the chain of its words' ids.

    Words that aren't known yet are encoded together, once per batch of texts: those of
    letters alone are one pre-token each, so their ids part behind every word-end string;
    should the numbers not agree (a letter whose lower case has a mark), one by one."""

    def __init__(self, tokenizer_json: str, width: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.width = Tokenizer.from_str(tokenizer_json), width
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known = {"": b""}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.width)

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """The ids of words. Signs behind letters are pre-tokens of their own, and A-Z are
        lower-cased by the tokenizer, so words that differ in these alone are encoded once."""
        parts, known = {}, self.known
        for w in words:
            stem = w.rstrip(punctuation)
            if stem.isascii():
                parts[w] = (stem.lower(), w[len(stem):]) if stem.isalpha() else (w, "")
            elif stem.isalpha() and (stem == w or normalize("NFC", stem).lower()[-1].isalpha()):
                parts[w] = stem, w[len(stem):]
            else:  # a mark at the stem's end would join the signs
                parts[w] = w, ""
        got = {p: known.get(p) for pair in parts.values() for p in pair}
        missing = sorted(p for p, ids in got.items() if ids is None)
        letters = [p for p in missing if p.isalpha()]
        for at in range(0, len(letters), 4096):
            some = letters[at:at + 4096]
            ids = self._ids(" ".join(some))
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(some):
                raw, bounds = ids.tobytes(), [0, *(cuts * ids.itemsize).tolist()]
                got.update(zip(some, (raw[i:j] for i, j in zip(bounds, bounds[1:]))))
        for p in missing:
            if got[p] is None:
                got[p] = self._ids(p).tobytes()
        found = {w: got[stem] + got[signs] for w, (stem, signs) in parts.items()}
        if len(known) < REMEMBERED:
            for new in (found, {p: got[p] for p in missing}):
                known.update(new if max(map(len, new), default=0) <= LONGEST else {w: ids for w, ids in new.items() if len(w) <= LONGEST})
        return found

    def encode_all(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        get = self.known.get
        out = [list(map(get, ws)) for ws in split]
        missing = {w for ws, got in zip(split, out) if None in got for w, x in zip(ws, got) if x is None}
        found = self._learn(missing) if missing else {}
        return [b"".join(got if None not in got else [found[w] if x is None else x for w, x in zip(ws, got)]) for ws, got in zip(split, out)]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def _word_ids(tokenizer_json: str, width: str) -> WordIds:
    """One per Python worker: later tasks of a worker go on with what it knows."""
    return worker_cache(("word ids", zlib.crc32(tokenizer_json.encode())), lambda: WordIds(tokenizer_json, width))


def _id_width(tokenizer_json: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_str(tokenizer_json).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def write_shards(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Encode, append ``end_id`` to each document and write the ``ids`` table."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    width = _id_width(tokenizer_json)
    end = np.array([end_id], width).tobytes()
    size = len(end)

    def encoded(texts: pa.Array, words: WordIds) -> Iterator[bytes]:
        for at in range(0, len(texts), AT_ONCE):  # few texts are Python strings at once
            yield from words.encode_all(texts.slice(at, AT_ONCE).to_pylist())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, seq = _word_ids(tokenizer_json, width), TaskContext.get().partitionId(), 0
        keys: list[int] = []
        payloads: list[bytes] = []
        held = 0

        def shard():
            lengths = np.array([len(p) // size for p in payloads], "<u4")
            return pa.RecordBatch.from_pylist(
                [{"part": part, "seq": seq, "n_docs": len(keys), "n_ids": int(lengths.sum()), "keys": np.array(keys, "<i8").tobytes(),
                  "lengths": lengths.tobytes(), "payload": b"".join(payloads)}], schema=ids_schema)

        for b in batches:
            for key, ids in zip(b.column("key").to_pylist(), encoded(b.column("text"), words)):
                if held >= SHARD_IDS and key != keys[-1]:
                    yield shard()
                    seq, keys, payloads, held = seq + 1, [], [], 0
                keys.append(key)
                payloads.append(ids + end)
                held += len(payloads[-1]) // size
        if keys:
            yield shard()
        keys, payloads = [], []
        release_memory()

    ids_schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                            ("keys", pa.binary()), ("lengths", pa.binary()), ("payload", pa.binary())])
    spark = docs.sparkSession
    rows = texts(docs).select(F.coalesce("doc_id", F.lit(NULL_KEY)).alias("key"), "text")
    rows = rows.repartitionByRange(parallelism(spark), "key").sortWithinPartitions("key")
    shards = rows.mapInArrow(encode, "part int, seq int, n_docs long, n_ids long, keys binary, lengths binary, payload binary")
    return written(shards, "ids")


# --- minimal perfect hash ---------------------------------------------------------------


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finalizer; wraps on overflow."""
    x = x.view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (_mix(keys, 1) % np.uint64(buckets)).astype(np.int64)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 2) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _group(keys: np.ndarray, n: int) -> np.ndarray:
    return (_mix(keys, 3) % np.uint64(max(1, n // 3))).astype(np.int64)


def _displaced(keys: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    """Slots of keys under displacement d (broadcast against each other)."""
    return (_mix(_mix(keys, 4) + d.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 5) % np.uint64(n)).astype(np.int64)


def build_mph(keys: np.ndarray) -> np.ndarray:
    """Seeds of a minimal perfect hash over distinct keys: hash and displace, the largest
    groups first; a group of one key gets a free slot written as ``-slot - 1``."""
    n = len(keys)
    group = _group(keys, n)
    seeds = np.zeros(max(1, n // 3), np.int32)
    order = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[order], np.arange(len(seeds) + 1))
    taken = np.zeros(n, bool)
    sizes = np.diff(bounds)
    singles = []
    for g in np.argsort(-sizes, kind="stable"):
        if sizes[g] == 0:
            break
        if sizes[g] == 1:
            singles.append(g)
            continue
        own, step = keys[order[bounds[g]:bounds[g + 1]]], 8
        d = np.arange(step)
        while True:  # a few displacements at once, more as slots get rare
            slots = _displaced(own[:, None], d[None, :], n)
            fits = ~taken[slots].any(axis=0)
            for j in np.flatnonzero(fits):
                if len(set(slots[:, j].tolist())) == len(own):
                    break
            else:
                step = min(1024, step * 4)
                d = np.arange(d[-1] + 1, d[-1] + 1 + step)
                continue
            taken[slots[:, j]] = True
            seeds[g] = d[j]
            break
    free = np.flatnonzero(~taken)
    seeds[singles] = -free[: len(singles)] - 1
    return seeds


def slots_of(keys: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    d = seeds[_group(keys, n)].astype(np.int64)
    return np.where(d < 0, -d - 1, _displaced(keys, np.maximum(d, 0), n))


# --- index and access -------------------------------------------------------------------


def write_index(shards: DataFrame, n_docs: int) -> tuple[DataFrame, int]:
    """The ``index`` table over the written shards and its number of buckets."""
    buckets = max(1, -(-n_docs // BUCKET_KEYS))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, seq, keys, lengths in zip(*(b.column(c).to_pylist() for c in ("part", "seq", "keys", "lengths"))):
                k, n = np.frombuffer(keys, "<i8"), np.frombuffer(lengths, "<u4").astype(np.int64)
                first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket_of(k[first], buckets)), pa.array(k[first]), pa.array(np.full(len(first), part, np.int32)),
                     pa.array(np.full(len(first), seq, np.int32)), pa.array(first.astype(np.int32)), pa.array((np.cumsum(n) - n)[first])],
                    names=["bucket", "key", "part", "seq", "record", "offset"])

    def build(rows: pa.Table) -> pa.Table:
        k = rows.column("key").to_numpy()
        seeds = build_mph(k)
        slots = np.zeros(len(k), SLOT)
        at = slots_of(k, seeds, len(k))
        slots["fingerprint"][at] = fingerprints(k)
        for c in ("part", "seq", "record", "offset"):
            slots[c][at] = rows.column(c).to_numpy()
        return pa.table({"bucket": [rows.column("bucket")[0].as_py()], "n": pa.array([len(k)], pa.int64()), "seeds": [seeds.astype("<i4").tobytes()], "slots": [slots.tobytes()]})

    flat = shards.select("part", "seq", "keys", "lengths").mapInArrow(records, "bucket long, key long, part int, seq int, record int, offset long")
    return written(flat.groupBy("bucket").applyInArrow(build, "bucket long, n long, seeds binary, slots binary"), "index"), buckets


def write_files(ids: DataFrame, index: DataFrame) -> DataFrame:
    """The ``files`` table, from the numbers alone."""
    def of(rows: DataFrame, kind: str, number: str) -> DataFrame:
        return rows.select(F.lit(kind).alias("kind"), F.col(number).cast("long").alias("number"), F.col("_metadata.file_name").alias("file"))

    listed = of(ids, "ids", "part").distinct().unionByName(of(index, "index", "bucket"))
    return written(listed.coalesce(1).sortWithinPartitions("kind", "number"), "files")


@dataclass(frozen=True)
class IdStore:
    """The written tables, read back."""

    ids: DataFrame
    index: DataFrame
    files: DataFrame
    buckets: int
    width: str

    def locate(self, keys: DataFrame) -> DataFrame:
        """key, part, seq, record, offset of each distinct key of ``keys`` that is in the store."""
        buckets = self.buckets

        def with_bucket(batches):
            for b in batches:
                k = b.column("key").to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(bucket_of(k, buckets)), pa.array(k)], names=["bucket", "key"])

        def look_up(keys: pa.Table, index: pa.Table) -> pa.Table:
            out = {c: [] for c in ("part", "seq", "record", "offset")}
            k = np.unique(keys.column("key").to_numpy())
            if index.num_rows and len(k):
                n = index.column("n")[0].as_py()
                slots = np.frombuffer(index.column("slots")[0].as_py(), SLOT)
                hit = slots[slots_of(k, np.frombuffer(index.column("seeds")[0].as_py(), "<i4"), n)]
                there = hit["fingerprint"] == fingerprints(k)
                k, out = k[there], {c: hit[c][there].astype(SLOT[c]) for c in out}
            else:
                k = k[:0]
            return pa.table({"key": pa.array(k, pa.int64()), **{c: pa.array(v, pa.int64() if c == "offset" else pa.int32()) for c, v in out.items()}})

        asked = keys.mapInArrow(with_bucket, "bucket long, key long")
        return asked.groupBy("bucket").cogroup(self.index.groupBy("bucket")).applyInArrow(look_up, "key long, part int, seq int, record int, offset long")

    def starts(self) -> DataFrame:
        """part, seq, start: ids before each shard. One row per shard; sums per part first."""
        meta = self.ids.select("part", "seq", "n_ids")
        parts = meta.groupBy("part").agg(F.sum("n_ids").alias("n"))
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
        inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
        return meta.select("part", "seq", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("inside")).join(parts, "part").select(
            "part", "seq", (F.col("base") + F.col("inside")).alias("start"))

    def digests(self, keys: DataFrame) -> DataFrame:
        """Read the documents of ``keys`` through the index: key, start, n_tokens, ids_crc32."""
        width = self.width
        size = np.dtype(width).itemsize

        def read(at: pa.Table, shard: pa.Table) -> pa.Table:
            out = {"key": [], "start": [], "n_tokens": [], "ids_crc32": []}
            if at.num_rows and shard.num_rows:
                lengths = np.frombuffer(shard.column("lengths")[0].as_py(), "<u4")
                stored = np.frombuffer(shard.column("keys")[0].as_py(), "<i8")
                payload = memoryview(shard.column("payload")[0].as_py())
                base = shard.column("start")[0].as_py()
                for key, record, offset in zip(*(at.column(c).to_pylist() for c in ("key", "record", "offset"))):
                    while record < len(stored) and stored[record] == key:  # repeated rows lie one after the other
                        n = int(lengths[record])
                        ids = np.frombuffer(payload[offset * size:(offset + n) * size], width).astype("<u4")
                        for c, v in zip(out, (key, base + offset, n, zlib.crc32(ids))):
                            out[c].append(v)
                        record, offset = record + 1, offset + n
            return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

        shards = self.ids.join(self.starts(), ["part", "seq"])
        return self.locate(keys).groupBy("part", "seq").cogroup(shards.groupBy("part", "seq")).applyInArrow(
            read, "key long, start long, n_tokens long, ids_crc32 long")

    def _in_file(self, rows: DataFrame, kind: str, number: int) -> DataFrame | None:
        """The rows of the one file that holds a part or bucket; the others are not opened."""
        entry = self.files.where((F.col("kind") == kind) & (F.col("number") == number)).first()
        return None if entry is None else rows.where(F.col("_metadata.file_name") == entry["file"])

    def get(self, key: int) -> list[int] | None:
        """The ids of one document: one index row, one slot, one shard row."""
        k = np.array([key], np.int64)
        bucket = int(bucket_of(k, self.buckets)[0])
        rows = self._in_file(self.index, "index", bucket)
        if rows is None:
            return None
        row = rows.where(F.col("bucket") == bucket).first()
        slot = np.frombuffer(row["slots"], SLOT)[slots_of(k, np.frombuffer(row["seeds"], "<i4"), row["n"])[0]]
        if slot["fingerprint"] != fingerprints(k)[0]:
            return None
        rows = self._in_file(self.ids, "ids", int(slot["part"]))
        shard = rows.where((F.col("part") == int(slot["part"])) & (F.col("seq") == int(slot["seq"]))).select("lengths", "payload").first()
        n = int(np.frombuffer(shard["lengths"], "<u4")[slot["record"]])
        return np.frombuffer(shard["payload"], self.width)[slot["offset"]:slot["offset"] + n].tolist()


def write_store(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> IdStore:
    with open(tokenizer_path, encoding="utf-8") as f:
        width = _id_width(f.read())
    ids = write_shards(docs, tokenizer_path, end_id)
    n_docs = ids.agg(F.sum("n_docs")).first()[0] or 0
    index, buckets = write_index(ids, n_docs)
    return IdStore(ids, index, write_files(ids, index), buckets, width)


def stored_digests(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write the store, then read every document back by its key: doc_id, start, n_tokens, ids_crc32."""
    store = write_store(docs, tokenizer_path, end_id)
    keys = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY)).alias("key"))
    return store.digests(keys).select(F.nullif("key", F.lit(NULL_KEY)).alias("doc_id"), "start", "n_tokens", "ids_crc32")
