"""Toxicity by a subsequence string kernel, Nystroem landmarks and a linear support vector machine.

The kernel of two words sums over the character sequences of length 4 that occur in both, gaps allowed: an occurrence
that spans ``s`` characters counts ``DECAY ** (s - 4)``, spans over ``SPAN`` do not count. An insult with characters
put in between, or with another ending, so stays close to the insult. Each word's kernel values are scaled by its
length. Letters put apart by spaces are read as one word as well.

Training uses a bounded sample of labelled documents (``most_toxic`` and ``most_clean``, those of the smallest hashes)
and their sentences. Sentences of clean documents are negative. A toxic label holds for a document, so a sentence of
a toxic document is positive through one word, its witness: a word that next to no clean sentence holds. Witnesses are
chosen by support at first, then by the machine's own score as well (two rounds), and the clean words that score
highest are added as negatives. Frequent witnesses are learned with characters put in too. The machine is linear in the Nystroem features, so it folds into one weight per character sequence of
the landmarks; a word's score is the sum of its sequences' weights, the same number as through the kernel values.

A text scores as its highest word, put on a 0..1 scale by a logistic fit to the sampled documents.

Defined results: null, empty and wordless texts score as a text of the least toxic words (the score of ``FLOOR``);
rows that repeat an id are each scored; a null id is not held out; without labelled rows of both kinds every score is
0.5 of neither; an empty table gives an empty one; words of any length are scored in overlapping pieces.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from caseweave.llm.byte_bpe import slices
from caseweave.llm.line_quality import words as words_of
from caseweave.session import stored

ORDER, SPAN, DECAY = 4, 7, 0.5
CLASSES, PADDING = 40, 39
PIECE = 24
FLOOR, CEILING = -2.0, 1.2  # beyond the margin a score says no more
MEMO_WORDS = 700_000
# A word marks toxic sentences when they outnumber the clean ones it is in by CLEAN_SHARE; with SUPPORT (or one in a
# hundred of the toxic documents) it is a witness from the start. The most frequent MOST_VARIED witnesses are also learned in disguise.
CLEAN_SHARE, SUPPORT, MOST_VARIED = 20, 3, 300
POSITIVE_WEIGHT = 2.0
STRIP = ".,;:!?\"'()[]{}<>*#$%&|-_"
SPACED = r"(?<!\S)(?:\S\s){2,}\S(?!\S)"


def patterns() -> list[tuple[int, ...]]:
    """Offsets of the characters of a sequence, from its first."""
    return [(0, *rest) for rest in combinations(range(1, SPAN), ORDER - 1)]


def char_classes(points: np.ndarray) -> np.ndarray:
    """0 stands for a word's edge, 1-26 for letters, 27 digits, 28 marks, 29-38 anything else."""
    table = 29 + np.arange(0x110000, dtype=np.int64) % 10
    table[:128] = 28
    table[ord("0") : ord("9") + 1] = 27
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    return table[points]


def pieces(word: str) -> list[str]:
    if len(word) <= PIECE:
        return [word]
    return [word[i : i + PIECE] for i in range(0, len(word) - PIECE // 2, PIECE // 2)]


def coded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character classes of words of up to PIECE characters, edges included, and the lengths with edges."""
    lengths = np.array([len(w) for w in words], np.int64) + 2
    width = int(lengths.max()) + SPAN
    out = np.full((len(words), width), PADDING, np.int32)
    columns = np.arange(width)
    out[:, 0] = 0
    out[np.arange(len(words)), lengths - 1] = 0
    inner = (columns >= 1) & (columns < lengths[:, None] - 1)
    out[inner] = char_classes(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32))
    return out, lengths


def sequences(codes: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """For each pattern the number of the sequence that starts at each place, and the weight of its span."""
    places = codes.shape[1] - SPAN + 1
    for offsets in patterns():
        number = codes[:, :places]
        for k in offsets[1:]:
            number = number * CLASSES + codes[:, k : k + places]
        yield number, DECAY ** (offsets[-1] + 1 - ORDER)


def scales(lengths: np.ndarray) -> np.ndarray:
    """The factor of each word's kernel values: one over the root of its squared weights."""
    weights = [(o[-1], DECAY ** (2 * (o[-1] + 1 - ORDER))) for o in patterns()]
    by_length = np.array([sum(w * max(0, n - last) for last, w in weights) for n in range(PIECE + 3)])
    return 1 / np.sqrt(np.maximum(by_length, 1.0))[lengths]


@dataclass
class Machine:
    """The folded machine: a weight per character sequence, a bias, and the logistic scale of a text's score."""

    numbers: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def table(self) -> np.ndarray:
        out = np.zeros(CLASSES**ORDER, np.float32)
        out[self.numbers] = self.weights
        return out

    def probability(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.offset, -50, 50)))


def sums(words: list[str], table: np.ndarray) -> np.ndarray:
    """For words of up to PIECE characters the scaled sum of the weights of their sequences."""
    out = np.zeros(len(words))
    lengths = np.array([len(w) for w in words])
    for low, high in ((0, 6), (6, 10), (10, 14), (14, PIECE)):
        for own in np.array_split(chosen := np.flatnonzero((lengths > low) & (lengths <= high)), len(chosen) // 8192 + 1):
            if len(own):
                codes, full = coded([words[i] for i in own])
                total = sum(table[number].sum(axis=1) * weight for number, weight in sequences(codes))
                out[own] = total * scales(full)
    return out


class Scorer:
    """Scores texts with a bounded memo of words."""

    def __init__(self, machine: Machine):
        self.machine, self.table, self.memo = machine, machine.table(), {}
        self.spaced = re.compile(SPACED)

    def words(self, words: list[str]) -> np.ndarray:
        cut = [pieces(word.lower().strip(STRIP)) for word in words]
        flat = sums([p for own in cut for p in own], self.table) + self.machine.bias
        starts = np.cumsum([0, *(len(own) for own in cut)])[:-1]
        return np.clip(np.maximum.reduceat(flat, starts), FLOOR, CEILING) if len(flat) else flat

    def texts(self, texts: list[str | None]) -> np.ndarray:
        split = []
        for text in texts:
            found = (text or "").split()
            if text and (apart := self.spaced.findall(text)):
                found = found + ["".join(run.split()) for run in apart]
            split.append(found)
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        fresh = list(set().union(*split) - self.memo.keys())
        if fresh:
            self.memo.update(zip(fresh, self.words(fresh).tolist(), strict=True))
        out = np.array([max(map(self.memo.__getitem__, found), default=FLOOR) for found in split])
        for word in fresh:
            if len(word) > 2 * PIECE:
                del self.memo[word]
        return out


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Scaled kernel values of words of up to PIECE characters and landmarks."""
    parts = [landmark_weights([landmark], np.ones(1)) for landmark in landmarks]
    numbers = np.unique(np.concatenate([n for n, _ in parts]))
    place = np.zeros(CLASSES**ORDER, np.int32)
    place[numbers] = np.arange(1, len(numbers) + 1)
    weights = np.zeros((len(numbers) + 1, len(landmarks)))
    for j, (own, values) in enumerate(parts):
        weights[place[own], j] = values
    out = np.zeros((len(words), len(landmarks)))
    for at in range(0, len(words), 4096):
        codes, full = coded(words[at : at + 4096])
        for number, decay in sequences(codes):
            found = place[number]
            row, column = np.nonzero(found)
            np.add.at(out, row + at, decay * weights[found[row, column]])
        out[at : at + 4096] *= scales(full)[:, None]
    return out


def landmark_weights(landmarks: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The landmarks' sequences and their summed weights."""
    numbers, values = [], []
    for landmark, weight in zip(landmarks, weights, strict=True):
        codes, lengths = coded([landmark])
        for number, decay in sequences(codes):
            number = number[0][: max(0, lengths[0])]
            numbers.append(number)
            values.append(np.full(len(number), weight * decay * scales(lengths)[0]))
    numbers, values = np.concatenate(numbers), np.concatenate(values)
    real = np.ones(len(numbers), bool)
    rest = numbers.copy()
    for _ in range(ORDER):  # a sequence that holds padding is none
        real &= rest % CLASSES != PADDING
        rest //= CLASSES
    found, where = np.unique(numbers[real], return_inverse=True)
    return found, np.bincount(where, values[real], len(found))


def landmark_table(landmarks: list[str], weights: np.ndarray) -> np.ndarray:
    table = np.zeros(CLASSES**ORDER, np.float32)
    numbers, values = landmark_weights(landmarks, weights)
    table[numbers] = values
    return table


def support_vectors(z: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, by Newton steps on the rows inside the margin."""
    x = np.hstack([z, np.ones((len(z), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        active = y * (x @ w) < 1
        a = x[active] * weight[active, None]
        penalty = np.eye(len(w))
        penalty[-1, -1] = 1e-3
        new = np.linalg.solve(penalty + 2 * cost * a.T @ x[active], 2 * cost * a.T @ y[active])
        done = np.abs(new - w).max() < 1e-6
        w = new
        if done:
            break
    return w[:-1], w[-1]


def fit_machine(positive: list[str], negative: list[str], landmarks: list[str], cost: float) -> Machine:
    """The machine over Nystroem features of the words, folded into weights of character sequences."""
    own = kernel(landmarks, landmarks)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    good = values > 1e-4 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    words = positive + negative
    z = kernel(words, landmarks) @ root
    y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
    weight = np.where(y > 0, POSITIVE_WEIGHT, 1.0)
    w, bias = support_vectors(z, y, weight, cost)
    numbers, weights = landmark_weights(landmarks, root @ w)
    return Machine(numbers, weights.astype(np.float32), float(bias))


def fit_logistic(score: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve; both labels weigh the same, targets are drawn in a little from 0 and 1."""
    n1, n0 = label.sum(), (1 - label).sum()
    target = np.where(label > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(label > 0, 0.5 / max(n1, 1), 0.5 / max(n0, 1))
    x, w = np.column_stack([score, np.ones(len(score))]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-7 * np.eye(2), x.T @ (weight * (target - p)) - 1e-7 * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def variants(word: str) -> list[str]:
    """The word with characters put in, as examples of its disguises."""
    half = len(word) // 2
    forms = (".".join(word), word[:half] + "*" + word[half:], word[: half + 1] + "x" + word[half + 1 :])
    return [form for form in forms if len(word) > ORDER and len(form) <= PIECE]


def sample(labelled: DataFrame, most_toxic: int, most_clean: int) -> DataFrame:
    """``id`` and ``label`` of the sampled rows, of the smallest hashes."""
    order = (F.xxhash64("id"), F.col("id"))
    parts = [
        labelled.where(F.col("label") == label).orderBy(*order).limit(most) for label, most in ((1, most_toxic), (0, most_clean))
    ]
    return parts[0].unionByName(parts[1])


def train(
    docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_toxic: int = 3000,
    most_clean: int = 9000, n_landmarks: int = 192, n_negative: int = 8000, cost: float = 20.0,
) -> Machine | None:
    """The machine for ``labelled`` (``id``, ``label`` 0 or 1); None without rows of both labels."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chosen = F.broadcast(sample(labelled, most_toxic, most_clean))
    texts = stored(rows.join(chosen, "id"), "labelled-texts")
    sentences = texts.select("id", "label", F.explode(F.split(F.lower("text"), r"[.!?\n]+")).alias("sentence"))
    tokens = stored(
        sentences.select("id", "label", F.xxhash64("sentence").alias("sentence"), F.explode(words_of(F.col("sentence"))).alias("word"))
        .withColumn("word", F.btrim("word", F.lit(STRIP))).where(F.length("word").between(3, PIECE)).distinct(),
        "labelled-words",
    )
    # Sentences are counted by their text, so a word in a sentence that was copied often counts once.
    counted = tokens.groupBy("word").agg(*[
        F.count_distinct(F.when(F.col("label") == k, F.col("sentence"))).alias(f"n{k}") for k in (0, 1)
    ])
    support = stored(counted.withColumn("toxic", F.col("n0") * CLEAN_SHARE < F.col("n1")), "word-support")
    clean = support.where("NOT toxic").select("word")
    bags: dict[object, dict[str, int]] = defaultdict(dict)
    marked = tokens.where("label = 1").select("id", "word").distinct().join(support.where("toxic"), "word")
    for row in marked.select("id", "word", "n1").collect():  # bounded by the sample
        bags[row["id"]][row["word"]] = row["n1"]
    usual = [r["word"] for r in clean.orderBy(F.xxhash64("word"), "word").limit(n_negative).collect()]
    if not bags or not usual:
        return None
    counts = {word: n for bag in bags.values() for word, n in bag.items()}
    usable = max(SUPPORT, len(bags) // 100)
    known = {w for w, n in counts.items() if n >= usable} or {max(bag, key=lambda w: (bag[w], w)) for bag in bags.values()}
    witness = set(known)
    hard: list[str] = []
    for turn in range(3):
        positive = sorted(witness, key=lambda w: (-counts[w], w))
        varied = [v for w in positive[:MOST_VARIED] for v in variants(w)]
        negative = sorted(set(usual) | set(hard))
        marks = spread(positive, n_landmarks * 2 // 3) + spread(hard or usual, n_landmarks // 3)
        machine = fit_machine(positive + varied, negative, marks, cost)
        if turn < 2:
            hard = sorted(set(hard) | set(hardest(clean, machine, 2000)))
            scorer = Scorer(machine)
            ranked = dict(zip(counts, scorer.words(list(counts)).tolist(), strict=True))
            best = {max(bag, key=lambda w: (ranked[w], w)) for bag in bags.values()}
            witness = known | {w for w in best if ranked[w] > 0}
    scores = score(texts.select("id", "text", "label"), machine, "id", "text", carry=("label",)).select("raw", "label").collect()
    machine.slope, machine.offset = fit_logistic(np.array([r["raw"] for r in scores]), np.array([float(r["label"]) for r in scores]))
    return machine


def spread(words: list[str], most: int) -> list[str]:
    """Up to ``most`` words, each time the one least like those taken."""
    words = words[:1500]
    if len(words) <= most:
        return list(words)
    taken, near = [words[0]], np.zeros(len(words))
    while len(taken) < most:
        near = np.maximum(near, sums(words, landmark_table([taken[-1]], np.ones(1))))
        taken.append(words[int(near.argmin())])
    return taken


def hardest(words: DataFrame, machine: Machine, most: int) -> list[str]:
    """The ``most`` clean words that score highest."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(machine)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer.words(batch.column(0).to_pylist()))], ["word", "raw"])

    ranked = words.mapInArrow(rank, "word string, raw double")
    return [r["word"] for r in ranked.orderBy(F.desc("raw"), "word").limit(most).collect()]


def score(
    docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """The id, carried columns, ``raw`` (the highest word's score) and ``score`` of each row."""
    rows = docs.select(F.col(text_col).alias("_text"), id_col, *carry)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(machine)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for start, stop in slices([len(t or "") for t in texts]):
                raw = scorer.texts(texts[start:stop])
                kept = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns[1:], pa.array(raw), pa.array(machine.probability(raw))], [*batch.schema.names[1:], "raw", "score"]
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(rate, f"{fields}, raw double, score double")
