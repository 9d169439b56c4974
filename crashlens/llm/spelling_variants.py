"""Spelling variant grouping by a trie-node pair dictionary (operator 11).

1. Every word run of every text is counted (``word_counts``).
2. The nodes of the trie of all words are numbered, and those of the trie of the reversed
   words (``trie_nodes``): a node of the first stands for a prefix, one of the second for a
   suffix, so two integers say exactly what is left of a word when a position is skipped.
3. Each word goes into the dictionary under the pair (prefix node, suffix node) of every
   skipped position and, nothing skipped, of every position where a code point could be
   inserted. Words that skip to the same pair differ by a replaced code point; a word whose
   split has the pair that another one skips to lacks that code point. No other words are
   near, and no candidate has to be verified (``neighbours``).
4. A pair of nodes holds one word that is split there, as the pair spells it, and at most one
   skipping word for each code point of the alphabet. Counts and the best partner are taken
   from the group's size and its two best members; pairs of words are never written out. A
   deletion is counted only at the first of a run of equal code points, for it yields the
   same word at each of them.
5. ``forms`` takes the near word of largest count where it has at least ``RATIO`` times the
   word's own, ``roots`` follows forms to the last. A count grows by that ratio with each
   step, so paths are short and doubling them ends after a few rounds.

Defined cases: null and empty texts have no words; a null doc_id counts as the empty text in
the rule that deletes a code point; repeated rows count again; long texts are taken whole;
an empty table gives an empty result; extra columns are ignored. Equal counts are settled by
the code-point order of the words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlens.llm.common import release_memory, scratch, texts, written

MIN_LENGTH, MIN_COUNT = 5, 3
#: One of so many (document, run) hashes loses a code point.
DELETED = 97
RATIO = 2
#: A task passes on what it has counted beyond this many different words.
HELD = 400_000

#: Latin-1 bytes: A-Z to a-z, letters of the runs [A-Za-zÀ-ÿ] as they are, the rest to spaces.
_RUNS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def _runs(text: str) -> list[bytes]:
    """The runs of a text, a byte for each code point; what Latin-1 lacks is no letter here."""
    return text.encode("latin-1", "replace").translate(_RUNS).split()


def _thinned(run: bytes, prefix: int) -> bytes:
    """The run, less one code point where the hash of ``<doc_id>:<run>`` says so."""
    h = crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if h % DELETED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of all words of the texts. Tasks add up before the shuffle, which carries a row
    for each word and task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                prefix = crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in Counter(_runs(text)).items():
                    if len(run) >= min_length:
                        word = _thinned(run, prefix)
                        if len(word) >= min_length:
                            total[word] = total.get(word, 0) + n
                if len(total) > HELD:
                    yield flush()
        yield flush()
        release_memory()

    counted = texts(docs).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _numbered(parts: DataFrame, name: str) -> DataFrame:
    """Numbers for the distinct strings of ``parts``; written, so that a number never changes."""
    return written(parts.distinct().withColumn("node", F.monotonically_increasing_id() + 1), name)


def trie_nodes(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(prefix, node) and (suffix, node) of all words. The empty string is the root of either
    trie and has number 0 without a row."""
    at = words.select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("i"))
    return (_numbered(at.select(F.expr("substring(word, 1, i)").alias("prefix")), "prefixes"),
            _numbered(at.select(F.expr("substring(word, i)").alias("suffix")), "suffixes"))


def pair_dictionary(words: DataFrame) -> DataFrame:
    """One row for each word, position and kind of entry: p, s (the nodes), word, n, and
    ``skip``: null at a split, else whether the skipped code point is the first of its run."""
    prefixes, suffixes = trie_nodes(words)
    length = F.length("word")
    split = words.select("word", "n", F.explode(F.sequence(F.lit(0), length)).alias("i"), F.lit(0).alias("gap"))
    skip = words.select("word", "n", F.explode(F.sequence(F.lit(0), length - 1)).alias("i"), F.lit(1).alias("gap"))
    entry = split.unionByName(skip).selectExpr(
        "word", "n", "substring(word, 1, i) AS prefix", "substring(word, i + gap + 1) AS suffix",
        "CASE WHEN gap = 1 THEN i = 0 OR substring(word, i, 1) <> substring(word, i + 1, 1) END AS skip")
    # a root is no row of the tables: its entries, one in each word, meet nothing and stay 0
    entry = entry.join(prefixes.withColumnRenamed("node", "p"), "prefix", "left").join(suffixes.withColumnRenamed("node", "s"), "suffix", "left")
    return entry.select(F.coalesce("p", F.lit(0)).alias("p"), F.coalesce("s", F.lit(0)).alias("s"), "word", "n", "skip")


def neighbours(words: DataFrame) -> DataFrame:
    """word, n_near (how many words are near), near_n and near (the one of largest count)."""
    member = F.struct((-F.col("n")).alias("less"), F.col("word").alias("word"))  # the least is the best

    def is_skip():
        return F.col("skip").isNotNull()

    groups = pair_dictionary(words).groupBy("p", "s").agg(
        F.array_sort(F.collect_list(F.when(is_skip(), member))).alias("skips"),  # one for each code point of the alphabet at most
        F.array_sort(F.collect_list(F.when(F.col("skip"), member))).alias("firsts"),
        F.min(F.when(~is_skip(), member)).alias("whole"),
    ).where((F.size("skips") > 1) | (F.size("firsts") > 0) & F.col("whole").isNotNull())
    # replaced: of a group's skipping words all others are near; the best of them is the first or second
    replaced = groups.where(F.size("skips") > 1).select(
        F.explode("skips").alias("m"), (F.size("skips") - 1).alias("near"), F.col("skips")[0].alias("a"), F.col("skips")[1].alias("b")).select(
        F.col("m.word").alias("word"), "near", F.when(F.col("m") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("best"))
    both = groups.where((F.size("firsts") > 0) & F.col("whole").isNotNull())
    longer = both.select(F.col("whole.word").alias("word"), F.size("firsts").alias("near"), F.col("firsts")[0].alias("best"))
    shorter = both.select(F.explode("firsts").alias("m"), "whole").select(F.col("m.word").alias("word"), F.lit(1).alias("near"), F.col("whole").alias("best"))
    found = replaced.unionByName(longer).unionByName(shorter).groupBy("word").agg(F.sum("near").cast("long").alias("n_near"), F.min("best").alias("best"))
    return found.select("word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.word").alias("near"))


def forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form and form_n of every word. A ratio above 1 keeps paths from closing."""
    if ratio <= 1:
        raise ValueError("the ratio must be above 1")
    near = words.join(neighbours(words), "word", "left")
    takes = F.col("near_n") >= ratio * F.col("n")
    return near.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                       F.when(takes, F.col("near")).alias("form"), F.when(takes, F.col("near_n")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root of the words that have a form: the end of their path. Each round goes
    twice as far as the one before and ends when no path grows."""
    path = written(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "paths")
    while True:
        on = path.select(F.col("word").alias("root"), F.col("root").alias("next"))
        path = written(path.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("grew")), "paths")
        if path.where("grew").isEmpty():
            return path.drop("grew")
        path = path.drop("grew")


def variant_groups(docs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the texts."""
    with scratch(docs.sparkSession):
        words = written(word_counts(docs), "words")
        with_form = written(forms(words), "forms")
        groups = with_form.join(roots(with_form), "word", "left").withColumn("root", F.coalesce("root", "word"))
        return written(groups, "variants", keep=True)
