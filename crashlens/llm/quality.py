"""Quality rules: a threshold table compiled into one projection (operator 2).

``RULES`` names a measure, a lower and an upper bound. ``quality_flags`` compiles the
table into Catalyst expressions over the measures of ``quality_measures``: no user
function, no shuffle, one pass over the texts. A document passes if every measure lies
within its bounds.

Defined cases: a null text is the empty text, it has no words and fails ``n_words``;
measures that divide by zero are 0. Repeated rows are judged one by one, an empty table
gives an empty result, and extra columns are ignored. Words of any length and texts of
any length are taken whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crashlens.llm.common import WORD_BREAKS, texts, words

#: Low bits of a sorted window that hold its place: texts of up to 2^26 words.
PLACE_BITS = 26
SYMBOLS = "#*$%&|<>"
# Frequent words of the four languages; running text has some of them.
STOP_WORDS = (
    "the and that have with this was are for from not you his they which of to in is it "
    "der die und das ist nicht mit ein eine von den zu auf für sich auch dem des "
    "le la les et des est une dans pour que qui sur pas avec du au en un "
    "el los las que del por con una para no su al se es y de"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high``; None leaves a side open."""

    measure: str
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        parts = [F.lit(True)]
        if self.low is not None:
            parts.append(F.col(self.measure) >= F.lit(self.low))
        if self.high is not None:
            parts.append(F.col(self.measure) <= F.lit(self.high))
        out = parts[0]
        for p in parts[1:]:
            out = out & p
        return out


#: The production table. Percentages are integers so that both engines agree to the bit.
RULES = (
    Rule("n_words", low=50),
    Rule("mean_word_chars", low=2.0, high=10.0),
    Rule("symbol_pct", high=10.0),
    Rule("stop_word_pct", low=2.0),
    Rule("dup_line_pct", high=50.0),
    Rule("repeat_word_pct", high=50.0),
)


def _pct(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) * F.lit(100.0) / F.col(whole)).otherwise(F.lit(0.0))


def quality_measures(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and the measures the rules use.

    Words in repeated 3-word windows are found inside the row: each window becomes one
    long of hash and place, the longs are sorted, neighbours with equal hash bits and equal
    words are repeats, and the union of their three places each is counted.
    """
    strip = F.translate(F.col("text"), WORD_BREAKS, "")
    base = texts(docs).select(
        "doc_id",
        words(F.col("text")).alias("w"),
        F.filter(F.split(F.col("text"), "\n"), lambda x: F.translate(x, WORD_BREAKS, "") != "").alias("lines"),
        F.length(strip).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate(F.col("text"), SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    grams = F.expr(
        "if(size(w) < 4, cast(array() as array<bigint>), sort_array(transform(sequence(0, size(w) - 3),"
        f" i -> shiftleft(xxhash64(w[i], w[i + 1], w[i + 2]), {PLACE_BITS}) + i)))"
    )
    sized = base.select(
        "doc_id", "w", "word_chars", "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("w", lambda x: F.lower(x).isin(*sorted(set(STOP_WORDS))))).cast("long").alias("n_stop_words"),
        grams.alias("g"),
    )
    same = f"shiftright(g[k] ^ g[k + 1], {PLACE_BITS}) = 0"
    place = f"cast(g[{{}}] & {(1 << PLACE_BITS) - 1} as int)"
    words_at = "w[{0}] = w[{1}] and w[{0} + 1] = w[{1} + 1] and w[{0} + 2] = w[{1} + 2]"
    twins = F.expr(
        f"if(size(g) < 2, cast(array() as array<int>), filter(sequence(0, size(g) - 2), k -> {same} and "
        + words_at.format(place.format("k"), place.format("k + 1")) + "))"
    )
    starts = F.expr(f"concat(transform(k, k -> {place.format('k')}), transform(k, k -> {place.format('k + 1')}))")
    found = sized.select("*", twins.alias("k")).select("*", starts.alias("s")).drop("g", "w", "k")
    covered = F.expr("cast(size(array_distinct(concat(s, transform(s, x -> x + 1), transform(s, x -> x + 2)))) as bigint)")
    return found.select("*", covered.alias("n_repeat_words")).drop("s").select(
        "*",
        F.when(F.col("n_words") > 0, F.col("word_chars") / F.col("n_words")).otherwise(F.lit(0.0)).alias("mean_word_chars"),
        _pct("n_symbols", "word_chars").alias("symbol_pct"),
        _pct("n_stop_words", "n_words").alias("stop_word_pct"),
        _pct("n_dup_lines", "n_lines").alias("dup_line_pct"),
        _pct("n_repeat_words", "n_words").alias("repeat_word_pct"),
    )


def quality_flags(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measures, ``base_failed``, the names of the failed rules and ``kept``."""
    failed = F.array_compact(F.array(*[F.when(~r.holds(), F.lit(r.measure)) for r in rules]))
    base_failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return (
        quality_measures(docs)
        .withColumn("failed_rules", failed)
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    )
