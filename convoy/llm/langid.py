"""Language identification by words first, with backoff to ever shorter character n-grams for words not known.

A known word adds the logarithm of its frequency in every language. An unknown one is cut, with its edges marked, into
n-grams of the greatest length of which at least one is known, and adds the mean of their logarithms.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import cut

#: Lengths of n-grams, longest first.
LENGTHS = (5, 4, 3, 2, 1)
#: Counts a worker holds before it passes them on, and words whose scores it remembers.
HELD, REMEMBERED = 300_000, 200_000
UNKNOWN = "und"


#: A letter and what letters and marks follow it. Numerals are no letters.
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def _none() -> np.ndarray:
    return np.zeros((0, 0))


@dataclass(frozen=True)
class Model:
    """Words and n-grams, and the logarithms of their frequencies: a row for each, a column for every language."""

    languages: tuple[str, ...] = ()
    words: tuple[str, ...] = ()
    word_logs: np.ndarray = field(default_factory=_none)
    grams: tuple[str, ...] = ()
    gram_logs: np.ndarray = field(default_factory=_none)


def _words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def _grams(word: str, n: int) -> list[str]:
    """N-grams of a word whose edges are marked; single letters are taken without the marks."""
    marked = word if n == 1 else f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_rows: int = 20_000,
    max_words: int = 50_000,
    max_grams: int = 25_000,
) -> Model:
    """Learn a model from texts of known language.

    Of each language about ``max_rows`` rows are used at most, chosen by a hash of the id, or of the text where that is null;
    null texts and languages are left out. Of every language all words from the count on from which there are at most
    ``max_words`` make the model, and for each length all n-grams from which there are at most ``max_grams``; so a small
    language keeps its words beside a large one. Without rows the model knows no language.
    """
    known = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    chosen_by = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.col(text_col)))
    known = known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), chosen_by.alias("place"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Model()
    languages = tuple(sorted(counts))
    share = F.coalesce(*[F.when(F.col("lang") == lang, max_rows / counts[lang]) for lang in languages])
    sample = known.where(F.pmod("place", F.lit(1 << 20)) < share * (1 << 20)).select("lang", "text")
    tokens = sample.mapInArrow(_counts, "size int, token string, lang string, n long")
    by_lang = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{i}") for i, lang in enumerate(languages)]
    table = cut(tokens.groupBy("size", "token").agg(*by_lang))
    wanted = F.lit(False)
    for size in (0, *LENGTHS):
        least = _least(table.where(F.col("size") == size), len(languages), max_grams if size else max_words)
        enough = [F.col(f"n{i}") >= n for i, n in enumerate(least)]
        wanted = wanted | ((F.col("size") == size) & F.greatest(*enough, F.lit(False)))
    kept = table.where(wanted).toArrow().to_pandas().sort_values(["size", "token"], kind="stable")
    columns = [f"n{i}" for i in range(len(languages))]
    parts = {size: kept[kept["size"] == size] for size in (0, *LENGTHS)}
    logs = {size: _logarithms(part[columns].to_numpy(float)) for size, part in parts.items()}
    grams = tuple(token for size in LENGTHS for token in parts[size]["token"])
    return Model(languages, tuple(parts[0]["token"]), logs[0], grams, np.concatenate([logs[size] for size in LENGTHS]))


def _least(counts: DataFrame, languages: int, most: int) -> list[int]:
    """For every language the least count, above zero, that at most ``most`` tokens reach, from how many have each count."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("lang"), F.col(f"n{i}").alias("n")) for i in range(languages)]))
    levels = counts.select(pairs.alias("p")).where("p.n > 0").groupBy("p.lang", "p.n").agg(F.count(F.lit(1)).alias("tokens"))
    found = defaultdict(list)
    for row in levels.collect():
        found[row["lang"]].append((row["n"], row["tokens"]))
    least = []
    for i in range(languages):
        total, bound = 0, None
        for n, tokens in sorted(found[i], reverse=True):
            total += tokens
            if total > most:
                break
            bound = n
        # if even the most frequent are too many, those above them: none
        least.append(bound if bound is not None else 1 + max((n for n, _ in found[i]), default=0))
    return least


def _logarithms(counts: np.ndarray, prior: float = 0.5) -> np.ndarray:
    counts = counts + prior
    return np.log(counts / counts.sum(axis=0))


def _counts(batches):
    held: dict[str, Counter] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            seen = held.setdefault(lang, Counter())
            size -= len(seen)
            seen.update(_words(text))
            size += len(seen)
            if size > HELD:
                yield from _rows(held)
                held, size = {}, 0
    yield from _rows(held)


def _rows(held: dict[str, Counter]):
    for lang, words in held.items():
        by_size = {0: words, **{n: Counter() for n in LENGTHS}}
        for word, n in words.items():
            for length in LENGTHS:
                seen = by_size[length]
                for gram in _grams(word, length):
                    seen[gram] += n
        for length, seen in by_size.items():
            arrays = [pa.array([length] * len(seen), pa.int32()), pa.array(list(seen), pa.string())]
            arrays += [pa.array([lang] * len(seen), pa.string()), pa.array(list(seen.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["size", "token", "lang", "n"])


class _Rows(dict):
    """The row of a table that holds a word's logarithms; those of unknown words are added when first seen."""

    def __init__(self, model: Model):
        self.model, self.known = model, len(model.words)
        self.grams = dict(zip(model.grams, model.gram_logs.tolist()))
        self.table = np.zeros((self.known + REMEMBERED, len(model.languages)))
        if self.known:
            self.table[: self.known] = model.word_logs
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.update(zip(self.model.words, range(self.known)))

    def full(self, more: int) -> bool:
        return len(self) + more > len(self.table)

    def __missing__(self, word: str) -> int:
        row = len(self)
        self.table[row] = self.backoff(word)
        self[word] = row
        return row

    def backoff(self, word: str) -> list[float]:
        """The mean over the longest known n-grams of an unknown word; zeros if no letter of it is known."""
        for n in LENGTHS:
            parts = [self.grams[g] for g in _grams(word, n) if g in self.grams]
            if parts:
                return [sum(part) / len(parts) for part in zip(*parts)]
        return [0.0] * len(self.model.languages)


def language(text: Column, model: Model) -> Column:
    """A struct (lang string, score double) for every text, read whole.

    ``lang`` is the language with the largest sum, the first by name on a tie, and ``und`` with score 0 if the text is null
    or has no letter, or if no language is known. The score is the language's share after a softmax of the sums, divided by
    the root of the number of words, so that it stays below 1 for short texts.
    """

    @F.arrow_udf("lang string, score double")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        rows = _Rows(model)
        for texts in batches:
            names, scores = [], []
            for text in texts.to_pylist():
                name, score = _predict(rows, _words(text))
                names.append(name)
                scores.append(score)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return predicted(text)


def _predict(rows: _Rows, words: list[str]) -> tuple[str, float]:
    languages = rows.model.languages
    if not words or not languages:
        return UNKNOWN, 0.0
    sums = np.zeros(len(languages))
    for start in range(0, len(words), REMEMBERED // 2):
        part = words[start : start + REMEMBERED // 2]
        if rows.full(len(part)):
            rows.forget()
        sums += rows.table[np.fromiter(map(rows.__getitem__, part), np.int64, len(part))].sum(axis=0)
    sums /= math.sqrt(len(words))
    best = int(np.argmax(sums))
    return languages[best], float(1 / np.exp(sums - sums[best]).sum())
