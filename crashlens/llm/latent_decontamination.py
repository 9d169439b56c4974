"""Benchmark decontamination by latent semantic retrieval (operator 7).

Passages are windows of ``2 * HALF`` words every ``HALF`` words, of documents and benchmark
items alike. Their TF-IDF matrix A has a column per word of the benchmark that isn't too common
(no other word can add to a cosine with an item; see ``MAX_SHARE``). A randomised SVD finds its leading right singular
space: each task adds up ``A_i^T (A_i W)`` for a random W over its passages, the sum of
these small matrices is orthonormalised, and A's rows are projected onto it. Cosines there
give the candidates; cosines do not depend on how the space is rotated, so the small SVD
behind is not needed.

Each candidate is then checked on the words around the passage. They must hold ``COVERED``
of the item's TF-IDF weight (chance candidates fail here, all at once), and the longest
common subsequence must hold ``LCS_SHARE`` of the item's words; for a paraphrase
``PARAPHRASE_SHARE`` will do if ``PARAPHRASE_COVERED`` of the weight of the item's words is
there and so is its answer, the last sentence (``ANSWER_SHARE`` of its words).

An item of fewer than ``MIN_WORDS`` words says too little for cosines and subsequences: its
words are sought as they stand, one after the other, by a trie of all such items.

Items are taken in blocks of half a ``BLOCK_ITEMS`` pieces of ``PIECE_WORDS`` words, and a block
holds its words as lists, never as a matrix of pieces by vocabulary: what is broadcast
(vocabulary, projection, items) follows the words of a block, whatever the benchmark's size.
For each block the documents are read once into columns of its vocabulary, which are written;
the sketch and the search read these. All passages of all documents are counted, projected and
compared; nothing is shuffled but the partial sums and nothing is cut off.

Defined cases: null or empty texts and items, and those of signs alone, match nothing; words are
compared in lower case (A-Z) without signs. Repeated documents each give their own rows; items
that repeat an id give one row a document with the best figures, and so do all items without an
id together (item_id is null there). Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlens.llm.common import drop_caches, release_memory, scratch, texts, written

HALF = 20
PIECE_WORDS, MIN_WORDS, BLOCK_ITEMS = 64, 6, 4096
RANK, SEED, WINDOWS = 128, 7, 2048
COVERED, PARAPHRASE_COVERED = 0.3, 0.6
COSINE, LCS_SHARE, PARAPHRASE_SHARE, ANSWER_SHARE = 0.4, 0.6, 0.45, 0.8
GROUP, STRETCH = 40_000, 1 << 16
FOUND = "doc_id long, item_id long, cosine double, lcs_share double, answer boolean"
#: Columns of the latent space: words in at most this share of passages (commoner ones tell
#: passages of one language alike), and the rarest words of each item whatever their share.
MAX_SHARE, RAREST = 0.003, 8
_SIGNS = bytes(c for c in range(128) if not chr(c).isalnum())
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _SIGNS, b"abcdefghijklmnopqrstuvwxyz" + b" " * len(_SIGNS))
SENTENCE = re.compile(r"(?<=[.!?])\s+")


def plain_words(text: str) -> list[bytes]:
    """Words in UTF-8: A-Z in lower case, ASCII signs and white space between words."""
    return text.encode().translate(_PLAIN).split()


def _columns(vocabulary: dict[bytes, int], found: list[str]) -> list[np.ndarray]:
    """Columns of all words of some texts; the number of columns for a word outside."""
    other = repeat(len(vocabulary))
    out = []
    for t in found:
        words = plain_words(t)
        out.append(np.fromiter(map(vocabulary.get, words, other), np.int32, len(words)))
    return out


def _halves(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The half-window each word of some texts lies in, and the first half-window of each text
    and behind the last."""
    first = np.r_[0, np.cumsum(-(-lengths // HALF))]
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.repeat(first[:-1], lengths) + place // HALF, first


def _stored(batch: pa.RecordBatch, width: str) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Ids, columns and numbers of words of a few documents at once."""
    blobs = batch.column("columns")
    size = np.dtype(width).itemsize
    offsets = np.int64 if pa.types.is_large_binary(blobs.type) else np.int32
    ends = np.frombuffer(blobs.buffers()[1], offsets, len(blobs) + 1, blobs.offset * np.dtype(offsets).itemsize) // size
    if not len(blobs) or ends[-1] == ends[0]:
        return
    values = np.frombuffer(blobs.buffers()[2], width, ends[-1])
    ids, at = batch.column("doc_id").to_pylist(), 0
    while at < len(ids):
        to = min(len(ids), max(at + 1, int(np.searchsorted(ends, ends[at] + GROUP))))
        yield ids[at:to], values[ends[at]:ends[to]].astype(np.int64), np.diff(ends[at:to + 1]).astype(np.int64)
        at = to


def _groups(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    at, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        held += n // 6
        if held >= GROUP:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(lengths):
        yield at, len(lengths)


def _add(out: np.ndarray, to: np.ndarray, matrix: np.ndarray, rows: np.ndarray) -> None:
    """Adds matrix rows to the rows ``to`` of out, which ascend; so many at a time, so that a
    long text does not need a matrix row per word."""
    for s in range(0, len(to), STRETCH):
        t, picked = to[s:s + STRETCH], matrix[rows[s:s + STRETCH]]
        starts = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
        out[t[starts]] += np.add.reduceat(picked, starts, axis=0)


def _projected(columns: np.ndarray, half: np.ndarray, n: int, matrix: np.ndarray) -> np.ndarray:
    """Sum of the matrix rows of each half-window's words; the matrix's first row is zero and
    stands for all words that have none."""
    use = columns > 0
    out = np.zeros((n, matrix.shape[1]), np.float32)
    _add(out, half[use], matrix, columns[use])
    return out


def _windows(halves: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Passages: each half-window with the next one of the same text."""
    out = halves.copy()
    if len(halves) > 1:
        joins = np.ones(len(halves) - 1, bool)
        joins[first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(halves))] - 1] = False
        out[:-1][joins] += halves[1:][joins]
    return out


def lcs_words(masks: dict[int, int], size: int, other: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel; ``masks``: places of each word."""
    full = (1 << size) - 1
    v = full
    for w in other.tolist():
        m = masks.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return size - v.bit_count()


class Items:
    """A block of benchmark items: vocabulary, pieces with the columns of their words and their
    answers, and the trie of the items that are too short for a piece."""

    def __init__(self, rows: list[tuple[int | None, str]]):
        self.vocabulary: dict[bytes, int] = {}
        self.pieces, self.ids, self.answers, short = [], [], [], []
        for item, text in rows:
            words = plain_words(text)
            columns = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            if len(columns) < MIN_WORDS:
                short.append((item, columns))
                continue
            answer = plain_words([x for x in SENTENCE.split(text.strip()) if plain_words(x)][-1])
            tail = [self.vocabulary[w] for w in answer if w in self.vocabulary]
            count = -(-len(columns) // PIECE_WORDS)
            size = -(-len(columns) // count)
            for k in range(count):
                self.pieces.append(np.array(columns[k * size:(k + 1) * size], np.int32))
                self.ids.append(item)
                self.answers.append(frozenset(tail) if k == count - 1 else frozenset())
        self.masks = []
        for p in self.pieces:
            m: dict[int, int] = {}
            for i, w in enumerate(p.tolist()):
                m[w] = m.get(w, 0) | (1 << i)
            self.masks.append(m)
        self._trie(short)

    def _trie(self, short: list[tuple[int | None, list[int]]]) -> None:
        """``edges`` (node * words + column, ascending) lead to ``nodes``; items end at ``ends``."""
        edges, self.ends, self.words = {}, {}, len(self.vocabulary) + 1
        for item, columns in short:
            node = 0
            for c in columns:
                node = edges.setdefault(node * self.words + c, len(edges) + 1)
            self.ends.setdefault(node, []).append(item)
        self.edges = np.array(sorted(edges), np.int64)
        self.nodes = np.array([edges[e] for e in self.edges.tolist()], np.int64)
        self.ending = np.zeros(len(edges) + 1, bool)
        self.ending[list(self.ends)] = True

    def short_in(self, columns: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int | None]]:
        """(text, item) where the words of a short item stand one after the other within a text;
        ``doc``: the text each word lies in."""
        if not len(self.edges):
            return
        at, node, step = np.arange(len(columns)), np.zeros(len(columns), np.int64), 0
        found = []
        while len(at):
            code = node * self.words + columns[at + step]
            edge = np.minimum(np.searchsorted(self.edges, code), len(self.edges) - 1)
            on = self.edges[edge] == code
            at, node, step = at[on], self.nodes[edge[on]], step + 1
            full = self.ending[node]
            found.append(np.unique(doc[at[full]] * len(self.ending) + node[full]))
            on = at + step < len(columns)
            at, node = at[on], node[on]
            on = doc[at] == doc[at + step]
            at, node = at[on], node[on]
        for code in np.concatenate(found).tolist():
            for item in self.ends[code % len(self.ending)]:
                yield code // len(self.ending), item

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """Piece and column of each word of the pieces."""
        lengths = [len(p) for p in self.pieces]
        return np.repeat(np.arange(len(lengths)), lengths), np.concatenate(self.pieces).astype(np.int64)


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    rows = benchmark.select(F.col("item_id").cast("long").alias("i"), F.col("text").cast("string").alias("t")).where("t is not null").orderBy("i", "t")
    held, words = [], 0
    for r in rows.toLocalIterator():
        n = len(plain_words(r["t"]))
        if n == 0:
            continue
        held.append((r["i"], r["t"]))
        words += n
        if words >= BLOCK_ITEMS * PIECE_WORDS // 2:
            yield Items(held)
            held, words = [], 0
    if held:
        yield Items(held)


def _sum_of(rows: DataFrame, shape: tuple[int, ...], ranges: int = 16) -> np.ndarray:
    """Sum of the matrices that tasks yield, added up per range on the executors."""

    def cut(batches):
        for b in batches:
            for blob in b.column("blob").to_pylist():
                for k, part in enumerate(np.array_split(np.frombuffer(blob, np.float64), ranges)):
                    yield pa.RecordBatch.from_pydict({"k": pa.array([k], pa.int32()), "blob": [part.tobytes()]})

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float64) for x in rows.column("blob").to_pylist())
        return pa.table({"k": rows.column("k").slice(0, 1), "blob": pa.array([total.tobytes()])})

    parts = {r["k"]: r["blob"] for r in rows.mapInArrow(cut, "k int, blob binary").groupBy("k").applyInArrow(add, "k int, blob binary").collect()}
    if not parts:
        return np.zeros(shape)
    return np.concatenate([np.frombuffer(parts[k], np.float64) for k in sorted(parts)]).reshape(shape)


class Space:
    """The latent space of a block: a row per column with a place in it, and the pieces there."""

    def __init__(self, items: Items, idf: np.ndarray, df: np.ndarray, n_passages: float, rank: int):
        self.items, self.piece, self.column = items, *items.places()
        chosen = df <= MAX_SHARE * n_passages
        for p in items.pieces:
            words = np.unique(p)
            chosen[words[np.argsort(df[words], kind="stable")[:RAREST]]] = True
        latent_columns = np.flatnonzero(chosen)
        self.row_of = np.zeros(len(idf) + 1, np.int32)  # 0: no column of the latent space
        self.row_of[latent_columns] = 1 + np.arange(len(latent_columns))
        self.weight = idf[latent_columns]
        shape = len(self.weight), min(rank, len(self.weight))
        self.start = (np.random.default_rng(SEED).standard_normal(shape) * self.weight[:, None]).astype(np.float32)

    def with_zero(self, matrix: np.ndarray) -> np.ndarray:
        return np.vstack([np.zeros((1, matrix.shape[1]), np.float32), matrix])

    def pieces_in(self, matrix: np.ndarray) -> np.ndarray:
        return _projected(self.row_of[self.column], self.piece, len(self.items.pieces), self.with_zero(matrix))

    def basis(self, sketched: np.ndarray) -> np.ndarray:
        """From the documents' part of A^T (A W) to the weighted orthonormal basis."""
        rows = self.row_of[self.column]
        order = np.argsort(rows, kind="stable")
        own = np.zeros((len(self.weight) + 1, self.start.shape[1]))
        _add(own, rows[order], self.pieces_in(self.start), self.piece[order])
        return np.linalg.qr((sketched + own[1:]) * self.weight[:, None])[0].astype(np.float32) * self.weight[:, None]


def _block_matches(docs: DataFrame, items: Items, rank: int, cosine: float) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    size = len(items.vocabulary)
    width = "<u2" if size < 1 << 16 else "<i4"
    shared = sc.broadcast(items)
    stored_schema = pa.schema([("doc_id", pa.int64()), ("columns", pa.binary()), ("counts", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The columns of each text; at the end of a task its passages' counts."""
        drop_caches()
        words, total = shared.value.vocabulary, np.zeros(size + 2)
        for b in batches:
            doc_ids, found = b.column("doc_id"), b.column("text")
            lengths = pc.utf8_length(found).to_numpy(zero_copy_only=False)
            for a, e in _groups(lengths):
                own = _columns(words, found.slice(a, e - a).to_pylist())
                n_words = np.array([len(c) for c in own], np.int64)
                columns, (half, first) = np.concatenate(own), _halves(n_words)
                use = columns < size
                pair = np.unique(half[use] * size + columns[use])
                total[:size] += np.bincount(pair % size, minlength=size)[:size]
                total[size + 1] += first[-1]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.slice(a, e - a), pa.array([c.astype(width).tobytes() for c in own], pa.binary()), pa.nulls(e - a, pa.binary())], schema=stored_schema)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.tobytes()], pa.binary())], schema=stored_schema)
        release_memory()

    stored = written(docs.mapInArrow(encode, "doc_id long, columns binary, counts binary"), "columns")
    columns_of = stored.where("columns is not null").select("doc_id", "columns")
    counted = _sum_of(stored.where("counts is not null").select(F.col("counts").alias("blob")), (size + 2,))
    space, idf, targets, projection = None, np.zeros(size, np.float32), None, None
    if items.pieces:
        piece, column = items.places()
        df = counted[:size] + np.bincount(np.unique(piece * size + column) % size, minlength=size)
        n_passages = counted[size + 1] + len(items.pieces)
        idf = np.log((1.0 + n_passages) / (1.0 + df)).astype(np.float32) + np.float32(1e-3)
        space = Space(items, idf, df, n_passages, rank)
        sketch_start = sc.broadcast((space.row_of, space.with_zero(space.start)))

        def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            drop_caches()
            rows_of, w = sketch_start.value
            total = np.zeros(w.shape)
            for b in batches:
                for _, columns, n_words in _stored(b, width):
                    half, first = _halves(n_words)
                    n, columns = int(first[-1]), rows_of[columns]
                    z = _windows(_projected(columns, half, n, w), first)
                    back = z.copy()  # a half-window's words are in the passage it starts and in the one before
                    if n > 1:
                        inner = np.ones(n, bool)
                        inner[first[first < n]] = False
                        back[1:][inner[1:]] += z[:-1][inner[1:]]
                    use = np.flatnonzero(columns > 0)
                    use = use[np.argsort(columns[use], kind="stable")]
                    _add(total, columns[use], back, half[use])
            yield pa.RecordBatch.from_pydict({"blob": [total[1:].tobytes()]})
            release_memory()

        basis = space.basis(_sum_of(columns_of.mapInArrow(sketch, "blob binary"), space.start.shape))
        latent = space.pieces_in(basis)
        latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
        projection = space.with_zero(basis)
        targets = latent, space.row_of
    searched = sc.broadcast((projection, targets, idf))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        own, (m, t, idf) = shared.value, searched.value
        if own.pieces:
            t, row_of = t
            piece, column = own.places()
            codes = np.unique(piece * (size + 1) + column)  # the words of each piece, and their weights
            weights = idf[codes % (size + 1)]
            least = np.array([COVERED * idf[p].sum() for p in own.pieces], np.float32)

        def covered(columns, lo, hi, k):
            """Whether the words lo to hi of a candidate hold enough of its piece, by TF-IDF weight."""
            out = np.zeros(len(k), bool)
            for s in range(0, len(k), STRETCH // HALF):
                part = slice(s, s + STRETCH // HALF)
                place = lo[part, None] + np.arange(4 * HALF)
                inside = place < hi[part, None]
                asked = k[part, None] * (size + 1) + columns[np.minimum(place, len(columns) - 1)]
                at = np.minimum(np.searchsorted(codes, asked), len(codes) - 1)
                out[part] = (weights[at] * (inside & (codes[at] == asked))).sum(axis=1) >= least[k[part]]
            return out

        for b in batches:
            for doc_ids, columns, n_words in _stored(b, width):
                best: dict[tuple, tuple] = {}
                for d, item in own.short_in(columns, np.repeat(np.arange(len(doc_ids)), n_words)):
                    best[d, item] = (1.0, 1.0, True)
                half, first = _halves(n_words)
                n = int(first[-1]) if own.pieces else 0
                if n:
                    word_at = np.searchsorted(half, np.arange(n + 1))
                    z = _windows(_projected(row_of[columns], half, n, m), first)
                    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
                for s in range(0, n, WINDOWS):
                    near = z[s:s + WINDOWS] @ t.T
                    w, k = np.nonzero(near >= cosine)
                    if not len(w):
                        continue
                    doc = np.searchsorted(first, s + w, side="right") - 1
                    lo, hi = np.maximum(first[doc], s + w - 1), np.minimum(first[doc + 1], s + w + 3)
                    fits = covered(columns, word_at[lo], word_at[hi], k)
                    for w, k, d, lo, hi in zip(*(x[fits].tolist() for x in (w, k, doc, word_at[lo], word_at[hi]))):
                        around = columns[lo:hi]
                        share = lcs_words(own.masks[k], len(own.pieces[k]), around) / len(own.pieces[k])
                        answer = own.answers[k]
                        answered = bool(answer) and len(answer.intersection(around.tolist())) >= ANSWER_SHARE * len(answer)
                        words = np.unique(own.pieces[k])
                        there = idf[words[np.isin(words, around)]].sum() >= PARAPHRASE_COVERED * idf[words].sum()
                        if share >= LCS_SHARE or (answered and there and share >= PARAPHRASE_SHARE):
                            key = (d, own.ids[k])
                            best[key] = max(best.get(key, (0.0, 0.0, False)), (share, float(near[w, k]), answered))
                if best:
                    keys = sorted(best, key=lambda x: (x[0], x[1] is not None, x[1] or 0))
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array([doc_ids[d] for d, _ in keys], pa.int64()), "item_id": pa.array([i for _, i in keys], pa.int64()),
                        "cosine": pa.array([best[k][1] for k in keys], pa.float64()), "lcs_share": pa.array([best[k][0] for k in keys], pa.float64()),
                        "answer": pa.array([best[k][2] for k in keys], pa.bool_())})
        release_memory()

    return columns_of.mapInArrow(search, FOUND)


def leaks(docs: DataFrame, benchmark: DataFrame, rank: int = RANK, cosine: float = COSINE) -> DataFrame:
    """One row per document and benchmark item it holds: doc_id, item_id, cosine, lcs_share, answer.

    The matches of each block are written; the columns they were found in are deleted."""
    rows = texts(docs)
    out = docs.sparkSession.createDataFrame([], FOUND)
    for items in _blocks(benchmark):
        with scratch(docs.sparkSession):
            found = written(_block_matches(rows, items, rank, cosine), "leaks", keep=True)
        out = out.unionByName(found)
    return out
