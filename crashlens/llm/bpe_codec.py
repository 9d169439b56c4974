"""BPE encoding and decoding by a contiguous rank array (operator 12).

A text is cut at the strings of added tokens, the rest into words by the byte-level
pre-token rule. A short word is merged in place: one array holds its part boundaries, a
second one the ranks of adjacent parts; the least rank is sought by a scan, the boundary
between its two parts is deleted, and the ranks to its left and right are looked up anew.
A word beyond ``SHORT`` bytes goes by a heap over linked parts, as a scan per merge would
take time with the square of its length; both yield the same ids. A worker remembers the
ids of words it has merged, up to a fixed number, and merges the others again.

Defined cases: a null text is the empty text, which has no ids and decodes to the empty
text. Special strings inside a text become their token, as the library does by default.
Whole texts of any length are taken, rows are encoded one by one (repeats and null ids
included), an empty table gives an empty result, extra columns are ignored. Ids that the
vocabulary lacks are an error when decoding; bytes that aren't UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlens.llm.common import release_memory, texts, worker_cache

#: The byte-level pre-token rule, a fixed value of the tokenizer's format.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Characters of blocks that have grown in recent versions of Unicode: ``regex`` and the
#: library may class them differently, so texts with any are cut by the library's own rule.
YOUNG = regex.compile("[^\\x00-\\u0557\\u2000-\\u206f\\u20a0-\\u20bf\\u2190-\\u21ff\\u3000-\\u303f\\u3041-\\u3096\\u30a1-\\u30fa\\u4e00-\\u9fa5\\uac00-\\ud7a3\\uff01-\\uff5e\\ufffd\\U0001f300-\\U0001f64f]")
BEFORE_SPACE = regex.compile(r"[\s\x1c-\x1f] ")
SHORT = 192
#: A worker remembers the ids of so many words of at most so many characters.
REMEMBERED, LONGEST = 400_000, 48
LEFT = (1 << 16) - 1
NONE = 1 << 60
AT_ONCE = 500


def byte_letters() -> dict[str, int]:
    """The format's letter of each byte: printable bytes of Latin-1 stand for themselves, the
    others for the code points from 256 on, in their order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Text to ids and back by the merges of a byte-level BPE tokenizer file."""

    def __init__(self, tokenizer_json: str):
        spec = json.loads(tokenizer_json)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space") or spec["normalizer"] or model["ignore_merges"]:
            raise ValueError("not a byte-level BPE tokenizer of the plain form")
        letters = byte_letters()
        raw = lambda token: bytes(map(letters.__getitem__, token))
        self.id_of = {raw(t): i for t, i in model["vocab"].items()}
        pairs = [tuple(map(raw, m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        # by the merged string: the rank, and in the lower bits the length of the left part
        self.rank_of = {a + b: r << 16 | len(a) for r, (a, b) in enumerate(pairs)}
        if len(self.rank_of) < len(pairs) or any(len(a) + len(b) > LEFT for a, b in pairs):
            raise ValueError("a token that is made in two ways, or one of 64 kB")
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take their surroundings aren't supported")
        self.added = added
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.bytes_of = {i: t for t, i in self.id_of.items()} | {i: t.encode() for t, i in added.items()}
        self.width, self.code = ("<u2", "H") if max(self.bytes_of) < 1 << 16 else ("<u4", "I")
        self.known: dict[str, bytes] = {}  # by word
        self.spaced: dict[str, bytes] = {}  # by what stands between two spaces, the first one included in the ids
        self.json, self._library = tokenizer_json, None

    # --- merging --------------------------------------------------------------------------

    def parts(self, word: bytes) -> list[bytes]:
        return self._scanned(word) if len(word) <= SHORT else self._queued(word)

    def _scanned(self, word: bytes) -> list[bytes]:
        rank = self.rank_of.get
        bound = list(range(len(word) + 1))
        ranks = [rank(word[i:i + 2], NONE) for i in range(len(word) - 1)]
        while ranks:
            least = min(ranks)
            if least == NONE:
                break
            i = ranks.index(least)
            del bound[i + 1], ranks[i]
            a, b = bound[i], bound[i + 1]
            if i < len(ranks):
                r = rank(word[a:bound[i + 2]], NONE)
                ranks[i] = r if r & LEFT == b - a else NONE
            if i:
                before = bound[i - 1]
                r = rank(word[before:b], NONE)
                ranks[i - 1] = r if r & LEFT == a - before else NONE
        return [word[a:b] for a, b in zip(bound, bound[1:])]

    def _queued(self, word: bytes) -> list[bytes]:
        rank, n = self.rank_of.get, len(word)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts at i
        queue = []

        def offer(i: int) -> None:
            b = end[i]
            if b < n and (r := rank(word[i:end[b]], NONE)) & LEFT == b - i:
                heapq.heappush(queue, (r, i, b, end[b]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, b, c = heapq.heappop(queue)
            if end[i] != b or before[b] != i or end[b] != c:
                continue  # one of the two has changed
            end[i], before[b], end[b] = c, -2, -1
            if c < n:
                before[c] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(word[i:end[i]])
            i = end[i]
        return out

    # --- texts ----------------------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        if not YOUNG.search(text):
            return PRETOKEN.findall(text)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.json).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def _word(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            ids = array(self.code, map(self.id_of.__getitem__, self.parts(word.encode()))).tobytes()
            if len(word) <= LONGEST and len(self.known) < REMEMBERED:
                self.known[word] = ids
        return ids

    def _words(self, text: str) -> bytes:
        return b"".join(map(self._word, self.words(text)))

    def _behind_space(self, piece: str) -> bytes:
        ids = self._words(" " + piece)
        if len(piece) <= LONGEST and len(self.spaced) < REMEMBERED:
            self.spaced[piece] = ids
        return ids

    def _segment(self, text: str) -> bytes:
        """Without white space before a space, each space starts a word, so what lies between
        spaces has the same ids wherever it stands."""
        if BEFORE_SPACE.search(text) or YOUNG.search(text):
            return self._words(text)
        first, *rest = text.split(" ")
        got = list(map(self.spaced.get, rest))
        return b"".join([self._words(first), *(got if None not in got else [self._behind_space(p) if x is None else x for p, x in zip(rest, got)])])

    def encode(self, text: str) -> bytes:
        """The ids of a text as raw little-endian integers of ``width``."""
        out = []
        for i, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if i % 2:
                out.append(array(self.code, [self.added[part]]).tobytes())
            elif part:
                out.append(self._segment(part))
        return b"".join(out)

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def codec(tokenizer_json: str) -> Codec:
    """One per Python worker: later tasks of a worker go on with what it knows."""
    return worker_cache(("codec", hash(tokenizer_json)), lambda: Codec(tokenizer_json))


def _shared(spark: SparkSession, tokenizer_path: str):
    """The tokenizer file, read on the driver and sent once (a file of fixed size, whatever the input)."""
    with open(tokenizer_path, encoding="utf-8") as f:
        text = f.read()
    Codec(text)  # raises here if the file doesn't fit
    return spark.sparkContext.broadcast(text)


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*values, np.zeros(0, np.int32)]).astype(np.int32)))


def encoded(docs: DataFrame, tokenizer_path: str, decode: bool = False) -> DataFrame:
    """doc_id and ids (array of int) of every row; with ``decode`` also ``text``, decoded from
    those ids. One narrow pass, no shuffle."""
    shared = _shared(docs.sparkSession, tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, AT_ONCE):
                b = whole.slice(at, AT_ONCE)
                ids = [np.frombuffer(own.encode(t), own.width) for t in b.column("text").to_pylist()]
                out = [b.column("doc_id"), _lists(ids)]
                if decode:
                    out.append(pa.array([own.decode(x.tolist()) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "ids", "text"][:len(out)])
        release_memory()

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>" + (", text string" if decode else ""))


def decoded(rows: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; null ids are no ids."""
    shared = _shared(rows.sparkSession, tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([own.decode(x or []) for x in b.column("ids").to_pylist()], pa.string())], names=["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")
