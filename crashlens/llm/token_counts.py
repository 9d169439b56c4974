"""Token counts by the whole-token shortcut (operator 4).

A byte-fallback BPE model never merges across the start of a run of spaces or across a
line feed if no vocabulary string has either inside. ``prove`` checks that offline, on the
vocabulary, and collects the strings that encode alone as one token. Counting then is a
table lookup per pre-token; only a pre-token outside the table is merged (by the library),
once per worker, and remembered.

Defined cases: a null text is the empty text (0 tokens). Texts of any length are taken
whole, rows are counted one by one (repeats included), an empty table gives an empty
result, extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlens.llm.common import texts

SPACE = "▁"  # how the model writes a space
#: A line feed, a run of spaces with what follows, or what follows a line feed.
PRETOKEN = re.compile(r"\n| +[^ \n]*|[^ \n]+")
#: A worker forgets merged pre-tokens beyond this many; longer ones than LONGEST are not kept.
REMEMBERED, LONGEST = 500_000, 64
LIMIT = 4096


@dataclass(frozen=True)
class Proof:
    """``whole``: pre-tokens that encode alone as one token."""

    model: bytes
    whole: frozenset[str]


def _merged(model: sentencepiece.SentencePieceProcessor, pretoken: str) -> int:
    """Tokens of a pre-token as it stands inside a text: behind a line feed, whose tokens are taken off."""
    return len(model.encode("\n" + pretoken)) - len(model.encode("\n"))


def prove(model_path: str) -> Proof:
    """Read the model and prove the shortcut on its vocabulary, or raise ValueError."""
    with open(model_path, "rb") as f:
        model_bytes = f.read()
    model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes)
    whole = set()
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        if SPACE in piece.lstrip(SPACE) or "\n" in piece:
            raise ValueError(f"the vocabulary string {piece!r} crosses a pre-token border")
        text = piece.replace(SPACE, " ")
        if PRETOKEN.fullmatch(text) and _merged(model, text) == 1:
            whole.add(text)
    for probe in ("a b", " a", "a  b\n\n c", "x\ty \n"):
        if sum(_merged(model, t) if t != "\n" else 1 for t in PRETOKEN.findall(" " + probe)) != len(model.encode(probe)):
            raise ValueError("the model's normalizer changes texts: the shortcut doesn't hold")
    return Proof(model_bytes, frozenset(whole))


class Counter(dict):
    """Pre-token to count; merges what it doesn't know."""

    def __init__(self, proof: Proof):
        super().__init__(dict.fromkeys(proof.whole, 1))
        self["\n"] = 1
        self.kept = len(self) + REMEMBERED
        self.proof = proof
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proof.model)

    def __missing__(self, pretoken: str) -> int:
        n = _merged(self.model, pretoken)
        if len(pretoken) <= LONGEST and len(self) < self.kept:
            self[pretoken] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        return sum(map(self.__getitem__, PRETOKEN.findall(" " + text.replace(SPACE, " "))))


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row. One narrow pass: no shuffle; the proof (the
    model and its 32 k strings, whatever the input) travels with the tasks."""
    proof = prove(model_path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(proof)
        for b in batches:
            n = [counter.count(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_bytes"), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = texts(docs).select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
