"""Ranked lexical search over a K2-treap of the term-document grid (operator 13).

Index (``write_index``): documents are dealt into blocks of bounded size. A block is a grid
with a row for each of its terms and a column for each of its documents, in doc_id order; a
cell holds the impact of the term in the document. The grid is stored as a K2-treap: each
level halves rows and columns, a cell that holds anything has a bit in its parent's mask of
four, and its impact maximum is kept as the difference to the parent's. A cell without
siblings has no difference, so its maximum costs nothing. All blocks and all terms are
indexed; nothing in the index depends on the queries.

Search (``ranked``): in every block the rows of an item's terms go down the tree together, by
ranges of documents. The bound of a range is the sum of weight times cell maximum over the
rows that still have a cell there. The ranges of greatest bound go first, a few of each item
in one step; a range whose bound is below the item's 20th score is done with. At one document
the bound is its score. A task takes its scores along from block to block; the best of all
tasks are merged by rank. Items are taken in blocks of bounded size, each sent to the tasks
with the weights of its terms.

Defined cases: a null text and one without terms have no postings and aren't counted in N;
rows that repeat a doc_id are documents of their own, a null doc_id comes after all others
among equal scores; repeated items are ranked each for itself, an item without a known term
has no rows; long texts are taken whole; empty tables give an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crashlens.llm.common import release_memory, scratch, texts, written

#: A block closes at so many term occurrences or documents.
BLOCK_TERMS, BLOCK_DOCS = 1_500_000, 1 << 14
#: Term occurrences of the items that are sent to the tasks at once, and taken down a tree together.
SENT_TERMS, JOINT_TERMS = 200_000, 4_000
#: Ranges of an item that are split in one step.
WIDTH = 24
TOP = 20
LAST = np.iinfo(np.int64).max

#: UTF-8 bytes: A-Z to a-z, 0-9, a-z and all bytes of other scripts as they are, the rest to spaces.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 0x80 else 32 for b in range(256))
_BITS = np.array([bin(m).count("1") for m in range(16)], np.int64)
#: Of a mask's bits, those below bit q.
_BELOW = np.array([[bin(m & ((1 << q) - 1)).count("1") for q in range(4)] for m in range(16)], np.int64)


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERMS).split()


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def norm(n: np.ndarray, docs: int, length: int) -> np.ndarray:
    return 75 + 25 * n * docs // length


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


# --- the tree -------------------------------------------------------------------------------


def _spread(x: np.ndarray) -> np.ndarray:
    """Bit i to bit 2 i."""
    x = x.astype(np.uint64)
    for shift, keep in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(keep)
    return x


def build_tree(rows: np.ndarray, cols: np.ndarray, values: np.ndarray) -> dict:
    """Masks and differences from the root down, of distinct cells (at least one)."""
    depth = max(1, int(max(rows.max(), cols.max())).bit_length())
    code = _spread(rows) << np.uint64(1) | _spread(cols)
    order = np.argsort(code)
    code, top = code[order], values[order].astype(np.int64)
    masks, less = [], []
    for _ in range(depth):
        parent = code >> np.uint64(2)
        start = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
        n = np.diff(np.r_[start, len(code)])
        masks.append(np.bitwise_or.reduceat(np.uint8(1) << (code & np.uint64(3)).astype(np.uint8), start))
        above = np.maximum.reduceat(top, start)
        several = np.repeat(n > 1, n)
        less.append((np.repeat(above, n)[several] - top[several]).astype("<u4"))
        code, top = parent[start], above
    return {"depth": depth, "root": int(top[0]), "masks": np.concatenate(masks[::-1]).tobytes(), "less": np.concatenate(less[::-1]).tobytes()}


@dataclass
class Tree:
    """All cells of a tree, level after level: mask, first child, maximum."""

    depth: int
    mask: np.ndarray
    first: np.ndarray
    top: np.ndarray

    @staticmethod
    def load(depth: int, root: int, masks: bytes, less: bytes) -> "Tree":
        masks, less = np.frombuffer(masks, np.uint8), np.frombuffer(less, "<u4")
        tops, firsts, at, taken, below = [np.array([root], np.int64)], [], 0, 0, 1
        for _ in range(depth):
            top = tops[-1]
            n = _BITS[masks[at:at + len(top)]]
            firsts.append(below + np.cumsum(n) - n)
            child = np.repeat(top, n)
            several = np.flatnonzero(np.repeat(n > 1, n))
            child[several] -= less[taken:taken + len(several)]
            taken, at, below = taken + len(several), at + len(top), below + len(child)
            tops.append(child)
        return Tree(depth, masks, np.concatenate(firsts), np.concatenate(tops))


# --- index ----------------------------------------------------------------------------------


class _Vocabulary(dict):
    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self)
        return n


@dataclass(frozen=True)
class Index:
    """``blocks``: the written trees; ``docs``: N, ``length``: L."""

    blocks: DataFrame
    docs: int
    length: int


def _bytes_of(docs: DataFrame) -> DataFrame:
    return texts(docs).select("doc_id", F.col("text").cast("binary").alias("text"))


def totals(docs: DataFrame) -> tuple[int, int]:
    """N and L: documents with a term, and all their terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = length = 0
        for b in batches:
            n = [len(terms(t)) for t in b.column("text").to_pylist()]
            docs, length = docs + len(n) - n.count(0), length + sum(n)
        yield pa.RecordBatch.from_pylist([{"docs": docs, "length": length}])

    row = _bytes_of(docs).mapInArrow(count, "docs long, length long").agg(F.sum("docs"), F.sum("length")).first()
    return row[0] or 0, row[1] or 0


def _block(ids: list[int | None], n: array, at: array, vocabulary: dict, docs: int, length: int) -> pa.RecordBatch:
    n, at = np.array(n, np.int64), np.frombuffer(at, np.uint32).astype(np.int64)
    keys = np.array([LAST if i is None else i for i in ids], np.int64)
    order = np.lexsort(([i is None for i in ids], keys))
    column = np.empty(len(ids), np.int64)
    column[order] = np.arange(len(ids))
    cell, tf = np.unique(at * len(ids) + np.repeat(column, n), return_counts=True)
    row, col = np.divmod(cell, len(ids))
    df = np.bincount(row, minlength=len(vocabulary))
    frequent = np.argsort(-df, kind="stable")  # rows of like frequency lie side by side
    rank = np.empty(len(df), np.int64)
    rank[frequent] = np.arange(len(df))
    tree = build_tree(rank[row], col, impacts(tf, norm(n[order], docs, length)[col]))
    words = list(vocabulary)
    return pa.RecordBatch.from_pylist([tree | {
        "ids": keys[order].astype("<i8").tobytes(), "no_id": sum(i is None for i in ids),
        "terms": b" ".join([words[i] for i in frequent.tolist()]), "df": df[frequent].astype("<u4").tobytes()}], schema=_SCHEMA)


_SCHEMA = pa.schema([("depth", pa.int32()), ("root", pa.int64()), ("masks", pa.binary()), ("less", pa.binary()),
                     ("ids", pa.binary()), ("no_id", pa.int64()), ("terms", pa.binary()), ("df", pa.binary())])


def write_index(docs: DataFrame) -> Index:
    n_docs, length = totals(docs)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, ids, n, at = _Vocabulary(), [], array("q"), array("I")
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                found = terms(text)
                if found:
                    ids.append(doc_id)
                    n.append(len(found))
                    at.extend(map(vocabulary.__getitem__, found))
                if len(at) >= BLOCK_TERMS or len(ids) >= BLOCK_DOCS:
                    yield _block(ids, n, at, vocabulary, n_docs, length)
                    vocabulary, ids, n, at = _Vocabulary(), [], array("q"), array("I")
        if ids:
            yield _block(ids, n, at, vocabulary, n_docs, length)
        release_memory()

    kinds = "depth int, root long, masks binary, less binary, ids binary, no_id long, terms binary, df binary"
    return Index(written(_bytes_of(docs).mapInArrow(build, kinds), "treap"), n_docs, length)


# --- search ---------------------------------------------------------------------------------


@dataclass
class Best:
    """The best documents of each item so far, best first: item, score, key, null (of the doc_id)."""

    item: np.ndarray
    score: np.ndarray
    key: np.ndarray
    null: np.ndarray

    @staticmethod
    def none() -> "Best":
        return Best(*(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, bool))

    def add(self, item, score, key, null) -> "Best":
        item, score, key, null = (np.concatenate(x) for x in zip((self.item, self.score, self.key, self.null), (item, score, key, null)))
        order = np.lexsort((null, key, -score, item))
        order = order[_rank(item[order]) < TOP]
        return Best(item[order], score[order], key[order], null[order])

    def bar(self, items: int) -> np.ndarray:
        """The score of each item's last place, 1 while there is room."""
        out = np.ones(items, np.int64)
        last = _rank(self.item) == TOP - 1
        out[self.item[last]] = self.score[last]
        return out


def _rank(group: np.ndarray) -> np.ndarray:
    """Positions within runs of equal values."""
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
    return np.arange(len(group)) - np.repeat(start, np.diff(np.r_[start, len(group)]))


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())


def descend(tree: Tree, item: np.ndarray, row: np.ndarray, weights: np.ndarray, items: int, ids: np.ndarray, null: np.ndarray, best: Best) -> Best:
    """Joint descent of the rows of several items; ``item`` ascends over the given rows."""
    # a node of the frontier: its item, bound, first column, level; its rows' cells lie together
    own, start, n = np.unique(item, return_index=True, return_counts=True)
    node = {"item": own, "bound": np.full(len(own), LAST), "col": np.zeros(len(own), np.int64), "level": np.full(len(own), tree.depth)}
    slot, cell = np.arange(len(item)), np.zeros(len(item), np.int64)
    while len(node["item"]):
        bar = best.bar(items)
        alive = node["bound"] >= bar[node["item"]]
        order = np.lexsort((node["col"], -node["bound"], node["item"]))
        order = order[alive[order]]
        go = _rank(node["item"][order]) < WIDTH
        go, wait = order[go], order[~go]
        at = _ranges(start[go], n[go])
        of, s, c = np.repeat(np.arange(len(go)), n[go]), slot[at], cell[at]
        level = node["level"][go] - 1
        mask, base, half = tree.mask[c], tree.first[c], (row[s] >> level[of] & 1) * 2
        parts = [({k: v[wait] for k, v in node.items()}, n[wait], slot[w := _ranges(start[wait], n[wait])], cell[w])]
        for right in (0, 1):
            q = half + right
            has = np.flatnonzero(mask >> q & 1)
            child = base[has] + _BELOW[mask[has], q[has]]
            count = np.bincount(of[has], minlength=len(go))
            total = np.r_[0, np.cumsum(tree.top[child] * weights[s[has]])]
            end = np.cumsum(count)
            bound = total[end] - total[end - count]
            col = node["col"][go] + (right << level)
            new = {"item": node["item"][go], "bound": bound, "col": col, "level": level}
            done = (level == 0) & (bound >= np.maximum(bar[new["item"]], 1))
            if done.any():
                best = best.add(new["item"][done], bound[done], ids[col[done]], null[col[done]])
            on = (level > 0) & (bound >= bar[new["item"]])
            parts.append(({k: v[on] for k, v in new.items()}, count[on], s[has][np.repeat(on, count)], child[np.repeat(on, count)]))
        node = {k: np.concatenate([p[0][k] for p in parts]) for k in node}
        n, slot, cell = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
        start = np.cumsum(n) - n
    return best


def _frequencies(index: Index, wanted: set[bytes]) -> dict[bytes, int]:
    """df of the terms of one block of items."""
    spark = index.blocks.sparkSession
    shared = spark.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for found, df in zip(b.column("terms").to_pylist(), b.column("df").to_pylist()):
                n = np.frombuffer(df, "<u4")
                for i, term in enumerate(found.split(b" ")):
                    if term in shared.value:
                        total[term] += int(n[i])
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.binary()), pa.array(total.values(), pa.int64())], names=["term", "df"])

    counts = index.blocks.select("terms", "df").mapInArrow(count, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = {bytes(r["term"]): r["df"] for r in counts.collect()}
    shared.unpersist()
    return out


def _search(index: Index, items: list[tuple[int | None, Counter]]) -> DataFrame:
    """Ranks of one block of items: each is its item_id and its terms."""
    df = _frequencies(index, set().union(*(found for _, found in items)))
    weighed = [[(t, n * w) for t, n in found.items() if (w := weight(index.docs, df.get(t, 0))) > 0] for _, found in items]
    shared = index.blocks.sparkSession.sparkContext.broadcast([([t for t, _ in x], [w for _, w in x]) for x in weighed])
    names = [item_id for item_id, _ in items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, best = shared.value, Best.none()
        for batch in batches:
            for k in range(batch.num_rows):
                b = batch.slice(k, 1).to_pylist()[0]
                tree = Tree.load(b["depth"], b["root"], b["masks"], b["less"])
                ids = np.frombuffer(b["ids"], "<i8")
                null = np.arange(len(ids)) >= len(ids) - b["no_id"]
                place = {t: i for i, t in enumerate(b["terms"].split(b" "))}.get
                item, row, weights = [], [], []
                for i, (found, w) in enumerate(wanted):
                    for t, x in zip(found, w):
                        if (r := place(t)) is not None:
                            item.append(i)
                            row.append(r)
                            weights.append(x)
                    if len(item) >= JOINT_TERMS or item and i == len(wanted) - 1:
                        best = descend(tree, *(np.array(x, np.int64) for x in (item, row, weights)), len(wanted), ids, null, best)
                        item, row, weights = [], [], []
        if len(best.item):
            yield pa.RecordBatch.from_arrays([pa.array(best.item), pa.array([names[i] for i in best.item], pa.int64()), pa.array(best.key, pa.int64(), mask=best.null), pa.array(best.score)],
                                             names=["item", "item_id", "doc_id", "score"])
        release_memory()

    found = index.blocks.drop("df").mapInArrow(run, "item long, item_id long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP).select("item_id", "rank", "doc_id", "score")


def ranked(index: Index, items: DataFrame) -> DataFrame:
    """item_id, rank, doc_id, score: the best documents for each row of ``items`` (item_id, text)."""
    spark = items.sparkSession
    out, held, size = None, [], 0
    rows = items.select(F.col("item_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    for item_id, text in rows.toLocalIterator():  # a partition at a time
        found = Counter(terms(text.encode()))
        held.append((item_id, found))
        size += len(found)
        if size >= SENT_TERMS:
            part = written(_search(index, held), "ranked")
            out, held, size = part if out is None else out.unionByName(part), [], 0
    if held and index.docs:
        part = _search(index, held)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Index ``docs``, rank them for ``items``, and delete the index."""
    with scratch(docs.sparkSession):
        return written(ranked(write_index(docs), items), "ranks", keep=True)
