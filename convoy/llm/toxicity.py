"""Toxicity by a weighted lexicon, matched with Aho-Corasick in folded text and normalised by length.

Folding lower-cases, maps look-alike letters and digits used as letters to plain ones, drops invisible characters and turns
everything else that is no letter into a word break. Lexicon entries are word starts (" idiot") or whole words (" ass ").
A match inside an exception phrase does not count.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import cut, few

# Letters of other scripts and signs that look like Latin letters, and digits that stand for letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p",
    "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ɡ": "g", "ı": "i", "ⅼ": "l", "ո": "n",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "€": "e",
}
# Characters that show nothing.
INVISIBLE = "\u00ad\u034f\u200b\u200c\u200d\u2060\ufeff"

#: Lengths of word starts that may become lexicon entries, and of whole words at most; longer ones count by their starts.
STARTS, WORD = range(4, 13), 64
#: Counts a Python worker holds before it passes them on.
HELD = 100_000


class _Folds(dict):
    """What a character becomes, worked out when first seen."""

    def __missing__(self, code: int):
        if 0xFF01 <= code <= 0xFF5E:
            made = self[ord(chr(code - 0xFEE0).lower())]
        elif chr(code) in INVISIBLE or 0x0300 <= code <= 0x036F:
            made = None
        else:
            made = code if chr(code).isalpha() else 32
        self[code] = made
        return made


def _folds() -> _Folds:
    return _Folds({ord(a): ord(b) for a, b in LOOK_ALIKES.items()})


def fold(text: str | None, folds: dict | None = None) -> list[str]:
    """The folded words of a text; none for null."""
    return text.lower().translate(folds if folds is not None else _folds()).split() if text else []


@dataclass(frozen=True)
class Model:
    """Entries and weights, exception phrases, and how a weight and a length become a score."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    bias: float = -3.0
    by_sum: float = 1.0
    by_density: float = 1.0


class Matcher:
    """A model's automaton."""

    def __init__(self, model: Model):
        self.model, self.folds = model, _folds()
        self.automaton = ahocorasick.Automaton()
        entries = {p: (len(p), w) for p, w in model.weights.items()}
        entries |= {f" {' '.join(fold(p, self.folds))} ": None for p in model.exceptions if fold(p, self.folds)}
        for pattern, value in entries.items():
            self.automaton.add_word(pattern, (pattern, value))
        if entries:
            self.automaton.make_automaton()
        self.empty = not entries

    def hits(self, folded: str) -> list[tuple[int, float]]:
        """(place, weight) of the longest entry at every matched word start that no exception covers."""
        best: dict[int, tuple[int, float]] = {}
        spared: list[tuple[int, int]] = []
        for end, (pattern, value) in () if self.empty else self.automaton.iter(folded):
            start = end - len(pattern) + 1
            if value is None:
                spared.append((start, end))
            elif start not in best or best[start][0] < value[0]:
                best[start] = value
        spared.sort()
        found, reach, next_spared = [], -1, 0
        for start, (_, weight) in sorted(best.items()):
            while next_spared < len(spared) and spared[next_spared][0] <= start:
                reach = max(reach, spared[next_spared][1])
                next_spared += 1
            if start >= reach:
                found.append((start, weight))
        return found

    def weigh(self, text: str | None) -> tuple[int, float, int]:
        """Hits, their weight, and the number of words."""
        words = fold(text, self.folds)
        found = self.hits(f" {' '.join(words)} ") if words else []
        return len(found), sum(w for _, w in found), len(words)

    def score(self, weight: float, words: int) -> float:
        x, y = features(weight, words)
        return 1 / (1 + math.exp(-(self.model.bias + self.model.by_sum * x + self.model.by_density * y)))


def features(weight: float, words: int) -> tuple[float, float]:
    """The logarithms of the weight and of the weight per hundred words, counting at least twenty words."""
    return math.log1p(weight), math.log1p(100 * weight / max(words, 20))


def toxicity(text: Column, model: Model) -> Column:
    """A struct (score double, hits int, weight double, words int) for every text, read whole.

    A null or empty text has no hits and gets the score of a text without any. Equal texts get equal scores.
    """

    @F.arrow_udf("score double, hits int, weight double, words int")
    def weighed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(model)
        for texts in (part for batch in batches for part in few(batch)):
            rows = [matcher.weigh(text.as_py()) for text in texts]
            hits, weights, words = zip(*rows) if rows else ((), (), ())
            scores = [matcher.score(w, n) for _, w, n in rows]
            arrays = [pa.array(scores, pa.float64()), pa.array(hits, pa.int32()), pa.array(weights, pa.float64()), pa.array(words, pa.int32())]
            yield pa.StructArray.from_arrays(arrays, ["score", "hits", "weight", "words"])

    return weighed(text)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_rows: int = 20_000,
    least_evidence: float = 8.0,
    least_weight: float = 0.5,
) -> Model:
    """Learn a model from labelled texts.

    Of each label about ``max_rows`` rows are used at most, chosen by a hash of the id; ids with both labels, null ids and
    null labels are left out. Every pattern is tried that has a log-likelihood ratio of ``least_evidence`` between the two
    labels, however rare it is; of nested ones the best. Its weight comes from a ridge regression over all that are tried,
    so that words which merely share copies with an entry get next to none; entries weigh ``least_weight`` or more. A word
    pair around an entry becomes an exception if it has as much evidence for the clean label. Without rows of both labels
    the model is empty.
    """
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min(label_col).cast("int").alias("label"), F.max(label_col).cast("int").alias("other"))
        .where("label = other")
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return Model({})
    share = F.when(F.col("label") == 1, max_rows / counts[1]).otherwise(max_rows / counts[0])
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share * (1 << 20)).select("id", "label")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = cut(texts.join(F.broadcast(chosen), "id").select("label", "text"))
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return Model({})
    rated = _rated(_evident(_counted(sample), 1, sizes, least_evidence).collect(), sizes, least_evidence)
    held = sample.mapInArrow(partial(_held, rated), "label int, places array<int>").where("size(places) > 0").toArrow()
    places = held.column("places").combine_chunks()
    fitted = _weights(len(rated), places.flatten().to_numpy(), places.value_lengths().to_numpy(), held.column("label").to_numpy(), sizes)
    weights = {pattern: float(w) for pattern, w in zip(rated, fitted) if w >= least_weight}
    around = sample.mapInArrow(partial(_pairs, Model(weights)), "label int, pattern string, n long")
    around = _evident(_by_label(around), 0, sizes, least_evidence).where("toxic = 0").orderBy(F.desc("clean"), "pattern")
    exceptions = tuple(
        r["pattern"] for r in around.collect() if _evidence(r["clean"], r["toxic"], sizes[0], sizes[1]) >= least_evidence
    )
    raw = Model(weights, exceptions)
    rows = sample.select("label", toxicity(F.col("text"), raw).alias("t")).select("label", "t.weight", "t.words").collect()
    x = np.array([features(r["weight"], r["words"]) for r in rows])
    return Model(weights, exceptions, *_logistic(x, np.array([r["label"] for r in rows], float)))


def _by_label(counts: DataFrame) -> DataFrame:
    """Partial counts (label, pattern, n) added up, as (pattern, clean, toxic)."""
    return counts.groupBy("pattern").agg(
        F.sum(F.expr("if(label = 0, n, 0)")).alias("clean"), F.sum(F.expr("if(label = 1, n, 0)")).alias("toxic")
    )


def _counted(sample: DataFrame) -> DataFrame:
    """In how many texts of either label each pattern occurs, as (pattern, clean, toxic)."""
    return _by_label(sample.mapInArrow(_patterns, "label int, pattern string, n long"))


def _evident(counts: DataFrame, label: int, sizes: dict[int, int], least: float) -> DataFrame:
    """The patterns with enough evidence for a label. Rounding may let a few others through."""
    size, other = float(sizes[label]), float(sizes[1 - label])
    k, z = (F.col(c).cast("double") for c in (("clean", "toxic"), ("toxic", "clean"))[label])
    rate = (k + z) / (size + other)
    part = lambda n, e: F.when(n > 0, n * F.log(n / e)).otherwise(0.0)
    evidence = part(k, rate * size) + part(z, rate * other)
    evidence += part(size - k, (1 - rate) * size) + part(other - z, (1 - rate) * other)
    return counts.where((evidence >= least - 1e-6) & (k * other > z * size))


def _patterns(batches):
    folds, seen = _folds(), Counter()
    for batch in (part for whole in batches for part in few(whole)):
        for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
            words = set(fold(text, folds))
            found = {(label, f" {w} ") for w in words if len(w) <= WORD}
            found.update((label, f" {w[:n]}") for w in words for n in STARTS if n <= len(w))
            seen.update(found)
            if len(seen) > HELD:
                yield _counts(seen)
                seen.clear()
    yield _counts(seen)


def _pairs(model, batches):
    """The word pairs around the hits of every text, each once a text."""
    matcher, seen = Matcher(model), Counter()
    for batch in (part for whole in batches for part in few(whole)):
        for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
            words = fold(text, matcher.folds)
            found, places = set(), {}
            for i, at in enumerate(accumulate((len(w) + 1 for w in words), initial=0)):
                places[at] = i
            for at, _ in matcher.hits(f" {' '.join(words)} ") if words else ():
                i = places[at]
                near = [(words[j], words[j + 1]) for j in (i - 1, i) if 0 <= j < len(words) - 1]
                found.update((label, f"{a} {b}") for a, b in near if len(a) <= WORD and len(b) <= WORD)
            seen.update(found)
            if len(seen) > HELD:
                yield _counts(seen)
                seen.clear()
    yield _counts(seen)


def _counts(seen: Counter) -> pa.RecordBatch:
    keys = list(seen)
    arrays = [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.string())]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(list(seen.values()), pa.int64())], ["label", "pattern", "n"])


def _evidence(k: int, z: int, size: int, other: int) -> float:
    """Log-likelihood ratio that ``k`` of ``size`` and ``z`` of ``other`` texts come from different rates."""
    rate = (k + z) / (size + other)
    part = lambda n, e: n * math.log(n / e) if n else 0.0
    return part(k, rate * size) + part(z, rate * other) + part(size - k, (1 - rate) * size) + part(other - z, (1 - rate) * other)


def _rated(counted, sizes, least) -> list[str]:
    """The patterns with evidence, most first. Of nested ones only the best stays; on a tie, the longest word start."""
    rated = []
    for pattern, z, k in counted:
        evidence = _evidence(k, z, sizes[1], sizes[0])
        if evidence >= least and (k + 0.5) * (sizes[0] + 1) >= 4 * (z + 0.5) * (sizes[1] + 1):
            rated.append((-round(evidence, 6), pattern.endswith(" "), -len(pattern), pattern))
    chosen: list[str] = []
    taken, starts = set(), set()
    for *_, pattern in sorted(rated):
        if pattern not in starts and not any(pattern[:n] in taken for n in range(2, len(pattern))):
            chosen.append(pattern)
            taken.add(pattern)
            starts.update(pattern[:n] for n in range(2, len(pattern) + 1))
    return chosen


def _held(rated, batches):
    """Which of the rated patterns each text holds."""
    folds, place = _folds(), {pattern: i for i, pattern in enumerate(rated)}
    for batch in (part for whole in batches for part in few(whole)):
        found = []
        for text in batch.column("text").to_pylist():
            words = set(fold(text, folds))
            patterns = {f" {w} " for w in words if len(w) <= WORD} | {f" {w[:n]}" for w in words for n in STARTS if n <= len(w)}
            found.append(sorted(place[p] for p in patterns & place.keys()))
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.list_(pa.int32()))], ["label", "places"])


def _weights(n, columns, lengths, labels, sizes, ridge: float = 1.0, steps: int = 300) -> np.ndarray:
    """Weights of zero or above by logistic regression on which patterns a text holds, by accelerated gradient steps.

    ``columns`` are the patterns of one text after the other, ``lengths`` how many each holds. Texts that hold none count for
    the bias only.
    """
    if not n or not len(lengths):
        return np.zeros(n)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    y = labels.astype(float)
    bare = {label: sizes[label] - int((y == label).sum()) for label in (0, 1)}
    # the curvature is at most a quarter of the largest sum over a text's patterns of their texts
    often = np.bincount(columns, minlength=n)
    bound = 0.25 * max(np.bincount(rows, often[columns]).max(), 1) + ridge
    w, z, bias, speed = np.zeros(n), np.zeros(n), math.log((sizes[1] + 1) / (sizes[0] + 1)), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, z[columns], len(lengths)) + bias, -30, 30)))
        low = 1 / (1 + math.exp(-bias))
        bias += 4 * ((y - p).sum() + bare[1] * (1 - low) - bare[0] * low) / (sizes[0] + sizes[1])
        step = np.maximum(0, z + (np.bincount(columns, (y - p)[rows], n) - ridge * z) / bound)
        faster = (1 + math.sqrt(1 + 4 * speed * speed)) / 2
        z, w, speed = step + (speed - 1) / faster * (step - w), step, faster
    return w


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, steps: int = 50) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton's method. Slopes are kept at zero or above: more hits never lower a score."""
    used = np.ones(x.shape[1], bool)
    while True:
        a = np.column_stack([np.ones(len(x)), x[:, used]])
        w = np.zeros(a.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            penalty = ridge * np.concatenate(([1e-3], np.ones(len(w) - 1)))
            step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + np.diag(penalty), a.T @ (y - p) - penalty * w)
            w += step
            if np.abs(step).max() < 1e-9:
                break
        slopes = np.zeros(x.shape[1])
        slopes[used] = w[1:]
        if (slopes >= 0).all():
            return float(w[0]), float(slopes[0]), float(slopes[1])
        used &= slopes >= 0
