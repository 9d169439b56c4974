"""Toxicity by a subsequence string kernel support vector machine (operator 8).

Kernel: two words are alike as far as they share subsequences of three characters; each
further character a subsequence spans costs a factor ``DECAY`` and up to ``GAP`` inserted
characters are tolerated ("idi*ot", "i d i o t": runs of single characters count as one
word). Words carry a start and an end sign; the kernel is normalised.

Training, on a bounded sample of labelled documents (``MAX_POSITIVE``, ``MAX_NEGATIVE`` rows
of at most ``MAX_CHARS`` characters, taken in hash order): documents are cut into sentences,
a sentence is as toxic as its worst word. A toxic document must have one toxic sentence, a
clean one has none, so training alternates between naming the witness of each toxic
document and fitting the machine. Nyström features over ``LANDMARKS`` words make it linear;
it is a squared-hinge machine solved by Newton steps. A logistic curve over the documents'
margins makes the score.

As the machine is linear in the kernel, all landmarks fold into one weight per subsequence,
and scoring a word costs its subsequences, whatever the number of landmarks. Words are
scored once per worker.

Defined cases: a null or empty text, or one without words, gets the score of the lowest
margin (``FLOOR``). Words of any length are scored (long ones in overlapping windows). No
labelled document of either class: every score is 0. Labels that contradict each other
count as toxic. Repeated rows are scored one by one, an empty table gives an empty result,
extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlens.llm.common import drop_caches, fold, release_memory, texts

DECAY, GAP = 0.6, 3
SHAPES = [(a, b, DECAY ** (b - 2)) for a, b in combinations(range(1, 3 + GAP), 2)]
CODES = 64  # characters are told apart modulo this
WINDOW = 32
MAX_POSITIVE, MAX_NEGATIVE, MAX_CHARS = 1000, 2000, 20_000
LANDMARKS, NEGATIVES, ROUNDS = 96, 6000, 3
RIDGE, FLOOR, SURE, HARD = 0.1, -1.5, 1.5, 20.0
REMEMBERED, TEXTS = 250_000, 256
SENTENCE = re.compile(r"[.!?\n|]+\s*")
EDGE = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum()) + "«»“”‘’„…–—¿¡"


def sentence_words(sentence: str) -> list[str]:
    """Lower-case words without punctuation at the ends; runs of single characters as one word."""
    out, run = [], []
    for w in sentence.lower().split():
        w = w.strip(EDGE)
        if len(w) == 1:
            run.append(w)
            continue
        if run:
            out.append("".join(run))
            run = []
        if w:
            out.append(w)
    if run:
        out.append("".join(run))
    return out


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and normalised weights of the subsequences of each word, as two matrices. Words
    must not be longer than ``WINDOW``."""
    n = max(len(w) for w in words) + 2
    width = n + GAP + 3
    text = np.zeros((len(words), width), np.int32)
    lengths = np.array([len(w) for w in words])
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    row = np.repeat(np.arange(len(words)), lengths)
    col = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    text[row, col + 1] = (flat % (CODES - 2)) + 2
    text[:, 0] = 1
    text[np.arange(len(words)), lengths + 1] = 1
    codes, weights = [], []
    first = text[:, :n]
    for a, b, w in SHAPES:
        last = text[:, b:b + n]
        codes.append((first * CODES + text[:, a:a + n]) * CODES + last)
        weights.append(np.where(last > 0, np.float32(w), np.float32(0)))
    codes, weights = np.concatenate(codes, axis=1), np.concatenate(weights, axis=1)
    order = np.argsort(codes, axis=1, kind="stable")
    codes, weights = np.take_along_axis(codes, order, 1), np.take_along_axis(weights, order, 1)
    # K(w, w): equal subsequences add up before they are squared.
    new = np.ones(codes.shape, bool)
    new[:, 1:] = codes[:, 1:] != codes[:, :-1]
    sums = np.bincount(np.cumsum(new.ravel()) - 1, weights=weights.ravel())
    norm = np.sqrt(np.bincount(np.nonzero(new)[0], weights=sums * sums, minlength=len(words)))
    return codes, weights / np.maximum(norm, 1e-9)[:, None].astype(np.float32)


def windows(word: str) -> list[str]:
    """A word that is longer than ``WINDOW`` as overlapping parts, between them the whole word."""
    return [word] if len(word) <= WINDOW else [word[k:k + WINDOW] for k in range(0, len(word) - WINDOW // 2, WINDOW // 2)]


@dataclass(frozen=True)
class Model:
    """One weight per subsequence, the bias, and the curve from a margin to a score."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, words: list[str], chunk: int = 2048) -> np.ndarray:
        out = np.empty(len(words), np.float32)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for at in range(0, len(order), chunk):
            own = order[at:at + chunk]
            long = [i for i in own if len(words[i]) > WINDOW]
            short = own[: len(own) - len(long)]
            if short:
                codes, w = subsequences([words[i] for i in short])
                out[short] = (self.weights[codes] * w).sum(axis=1) + self.bias
            for i in long:
                parts = windows(words[i])
                out[i] = max(self.margins(parts[k:k + chunk]).max() for k in range(0, len(parts), chunk))
        return out

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * np.maximum(margin, FLOOR) + self.shift, -50, 50)))


NOTHING = Model(np.zeros(CODES**3, np.float32), FLOOR, 0.0, -50.0)


def fit(toxic: list[str], clean: list[str]) -> Model:
    """Fit on labelled texts."""
    one: dict[str, str] = {}  # equal words are held once
    docs = [list({one.setdefault(x, x): None for s in SENTENCE.split(t) for w in sentence_words(s) for x in windows(w)}) for t in (*toxic, *clean)]
    good, bad = docs[: len(toxic)], docs[len(toxic):]
    good = [d for d in good if d]
    if not good or not any(bad):
        return NOTHING
    df_good, df_bad = Counter(w for d in good for w in d), Counter(w for d in bad for w in d)
    odds = {w: np.log((n + 0.5) / (len(good) + 1)) - np.log((df_bad[w] + 0.5) / (len(bad) + 1)) for w, n in df_good.items()}
    # Witnesses to begin with: the word that tells most, over all the documents it is in, of
    # those at least e^SURE times as frequent in toxic documents.
    witness = [max(d, key=lambda w: (max(0.0, odds[w] - SURE) * df_good[w], w)) for d in good]
    neutral = sorted(df_bad, key=lambda w: (-df_bad[w], w))[:NEGATIVES]
    model, hard, flat = None, [], sorted({w for d in docs for w in d})
    for _ in range(ROUNDS):
        # A document whose worst word is common in clean ones too has no witness to learn from.
        votes, confused = Counter([w for w in witness if odds[w] >= SURE] or witness), set(hard)
        positive = sorted(w for w in votes if votes[w] > 1 or len(votes) < 20) or sorted(votes)
        landmarks = sorted(positive, key=lambda w: (-votes[w], w))[: LANDMARKS * 3 // 4]
        landmarks += [w for w in neutral if w not in votes][: LANDMARKS - len(landmarks)]
        known = positive + [w for w in neutral if w not in set(positive)]
        spaces = _Spaces(landmarks)
        kernel, among = _kernel(known, spaces), _kernel(landmarks, spaces)
        value, vector = np.linalg.eigh((among + among.T) / 2)
        keep = value > 1e-6
        root = vector[:, keep] / np.sqrt(value[keep])  # W^-1/2: kernel values to Nyström features
        y = np.where(np.arange(len(known)) < len(positive), 1.0, -1.0)
        weight = np.array([float(votes[w]) for w in positive] + [HARD if w in confused else 1.0 for w in known[len(positive):]])
        weight[y > 0] *= 0.5 * (y < 0).sum() / weight[y > 0].sum()
        u, bias = _machine(kernel @ root, y, weight)
        weights = np.zeros(CODES**3)
        for word, c in zip(landmarks, root @ u):
            codes, w = subsequences([word])
            np.add.at(weights, codes[0], c * w[0])
        model = Model(weights.astype(np.float32), float(bias), 1.0, 0.0)
        margin = dict(zip(flat, model.margins(flat)))
        witness = [max(d, key=lambda w: (margin[w], w)) for d in good]
        # Words of clean documents that look toxic join the neutral ones, and weigh HARD times as much.
        hard = sorted((w for w in df_bad if margin[w] > -0.5), key=lambda w: (-margin[w], w))[:1000]
        neutral = list(dict.fromkeys(hard + neutral))[:NEGATIVES]
    top = np.array([max((margin[w] for w in d), default=FLOOR) for d in (*good, *bad)])
    slope, shift = _curve(np.maximum(top, FLOOR), np.r_[np.ones(len(good)), np.zeros(len(bad))])
    return Model(model.weights, model.bias, slope, shift)


class _Spaces:
    """The landmarks' spaces, of which one is laid out at a time."""

    def __init__(self, landmarks: list[str]):
        self.marks = [subsequences([x]) for x in landmarks]

    def __len__(self) -> int:
        return len(self.marks)

    def __iter__(self) -> Iterator[np.ndarray]:
        space = np.zeros(CODES**3, np.float32)
        for codes, w in self.marks:
            np.add.at(space, codes[0], w[0])
            yield space
            space[codes[0]] = 0


def _dense(word: str) -> np.ndarray:
    return next(iter(_Spaces([word])))


def _kernel(words: list[str], spaces: _Spaces | np.ndarray, chunk: int = 512) -> np.ndarray:
    """Kernel values, a row for each word and a column for each space."""
    out = np.empty((len(words), len(spaces)))
    for at in range(0, len(words), chunk):
        codes, w = subsequences(words[at:at + chunk])
        for j, space in enumerate(spaces):
            out[at:at + chunk, j] = (space[codes] * w).sum(axis=1)
    return out


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared-hinge support vector machine, by Newton steps over the rows inside the margin."""
    x = np.c_[x, np.ones(len(x))]
    u = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6
    inside = np.ones(len(x), bool)
    for _ in range(30):
        a = x[inside] * weight[inside, None]
        u = np.linalg.solve(a.T @ x[inside] + np.diag(ridge), a.T @ y[inside])
        now = y * (x @ u) < 1
        if (now == inside).all():
            break
        inside = now
    return u[:-1], u[-1]


def _curve(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic curve by Newton steps; targets are drawn in a little, so that a clean split stays finite."""
    n1, n0 = label.sum(), (1 - label).sum()
    target = np.where(label > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.c_[margin, np.ones(len(margin))]

    def loss(a):
        z = x @ a
        return (np.logaddexp(0, z) - target * z).sum() + 5e-5 * a @ a

    a = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2), x.T @ (target - p) - 1e-4 * a)
        while loss(a + step) > loss(a) and np.abs(step).max() > 1e-9:
            step /= 2
        a += step
        if np.abs(step).max() < 1e-6:
            break
    return float(a[0]), float(a[1])


def labelled_sample(docs: DataFrame, labels: DataFrame, toxic: int, most: int) -> list[str]:
    """Texts of up to ``most`` labelled training documents of a class, in hash order. Only the
    chosen ids, a bounded number, are broadcast; no text is shuffled."""
    ids = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    ids = ids.where((F.col("toxic") == toxic) & (fold(F.col("doc_id"), 5) != 0))
    ids = ids.select("doc_id", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(2 * most)
    rows = texts(docs).where(F.length("text").between(1, MAX_CHARS)).join(F.broadcast(ids), "doc_id")
    return [r["text"] for r in rows.orderBy("h", "doc_id", "text").limit(most).select("text").collect()]


def train(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(labelled_sample(docs, labels, 1, MAX_POSITIVE), labelled_sample(docs, labels, 0, MAX_NEGATIVE))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """A batch in parts, so that few texts are Python strings at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    release_memory()


class Scorer:
    """Scores of texts; a word is scored once per task."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def __call__(self, found: list[str]) -> np.ndarray:
        """A few texts at a time: their words are held at once."""
        parts = [self._score(found[at:at + TEXTS]) for at in range(0, len(found), TEXTS)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def _score(self, found: list[str]) -> np.ndarray:
        per_doc = [_words(t) for t in found]
        if len(self.known) > REMEMBERED:
            self.known = {}
        unseen = list({w for d in per_doc for w in d if w not in self.known})
        for at in range(0, len(unseen), 16384):
            part = unseen[at:at + 16384]
            self.known.update(zip(part, self.model.margins(part).tolist()))
        return self.model.score(np.array([max(map(self.known.__getitem__, d), default=FLOOR) for d in per_doc]))


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row. The model (one weight per subsequence, 1 MB) travels
    with the tasks; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        score = Scorer(shared.value)
        for b in _slices(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score(b.column("text").to_pylist()))], names=["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, model: Model, reject_from: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose score stays below ``reject_from``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        score = Scorer(shared.value)
        for b in _slices(batches):
            found = b.column(b.schema.get_field_index("text")).to_pylist()
            yield b.filter(pa.array(score([t or "" for t in found]) < reject_from))

    return docs.mapInArrow(run, docs.schema)


def _words(text: str) -> set[str]:
    return {w for s in SENTENCE.split(text) for w in sentence_words(s)}
