"""Toxicity, language and licenses."""

from __future__ import annotations

import math
import random
import textwrap
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from convoy.llm import langid, licenses, toxicity
from tests.llm.data import awkward, docs, prose

MODEL = toxicity.Model({" idiot": 3.0, " scum ": 3.0, " trash": 2.0}, ("trash can",), -4.0, 3.0, 1.0)


def hits(spark, texts, model=MODEL):
    table = docs(spark, list(enumerate(texts)))
    rows = table.select("doc_id", toxicity.toxicity(F.col("text"), model).alias("t")).orderBy("doc_id").collect()
    return [r.t for r in rows]


def test_folding_and_exceptions(spark):
    texts = ["you IDIOT!", "1d10ts", "іdіоt", "ｉｄｉｏｔ", "i­di​ot", "scum", "scummy", "a trash can", "trash, can of trash",
             "Trash can trash", "didiot", "plain words", "", None, "idi ot"]
    assert [r.hits for r in hits(spark, texts)] == [1, 1, 1, 1, 1, 1, 0, 0, 1, 1, 0, 0, 0, 0, 0]


def test_length_and_equal_texts(spark):
    rows = hits(spark, ["idiot", "idiot " + prose(1, 2000), "idiot", prose(2, 30), "", None])
    assert rows[0].score > rows[1].score > rows[3].score == rows[4].score == rows[5].score
    assert rows[0] == rows[2]
    assert all(0 <= r.score <= 1 for r in rows)


def test_learned_words_and_exceptions(spark):
    draw = random.Random(1)
    texts, labels = [], []
    for i in range(600):
        bad, words = i % 3 == 0, prose(1000 + i, 40).split()
        for _ in range(2 if bad else 0):
            words.insert(draw.randrange(40), draw.choice(["numpty", "numpties", "git"]))
        if i % 3 == 1 and i % 2:
            words.insert(20, "git commit")
        texts.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    labels += [(0, 0), (None, 1), (5, None), (10**6, 1)]
    table = docs(spark, texts)
    model = toxicity.learn(table, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert any("numpt".startswith(w.strip()) or w.strip().startswith("numpt") for w in model.weights)
    scored = table.select("doc_id", toxicity.toxicity(F.col("text"), model)["score"].alias("score")).collect()
    right = [(r.score >= 0.7) == (r.doc_id % 3 == 0) for r in scored]
    assert sum(right) > 0.95 * len(right)


def dealt(draw, texts, words, times):
    """Put every word into ``times`` of the texts."""
    for word in words:
        for i in draw.sample(range(len(texts)), times):
            texts[i].append(word)


def coined(draw, n, length):
    return ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(length)) for _ in range(n)]


def learned(spark, bad, good):
    table = docs(spark, [(i, " ".join(t)) for i, t in enumerate(bad + good)])
    labels = [(i, int(i < len(bad))) for i in range(len(bad) + len(good))]
    return toxicity.learn(table, spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_rare_toxic_words_beside_many_common_ones(spark):
    """Words with full evidence are learned although more than 50,000 patterns occur in more toxic texts."""
    draw = random.Random(5)
    bad, good = [[] for _ in range(1000)], [[] for _ in range(1000)]
    harmless, rare = coined(draw, 5400, 12), coined(draw, 20, 8)
    dealt(draw, bad, harmless, 20)
    dealt(draw, good, harmless, 20)
    dealt(draw, bad, rare, 15)
    entries = learned(spark, bad, good).weights
    assert all(any(f" {w} ".startswith(e) for e in entries) for w in rare)


def test_many_toxic_words(spark):
    """No number of entries and exceptions is the most that is learned."""
    draw = random.Random(6)
    bad, good = [[f"w{i % 7}x"] for i in range(15_000)], [[f"w{i % 7}x"] for i in range(15_000)]
    words = sorted({w[:4]: w for w in coined(draw, 2300, 8)}.values())
    dealt(draw, bad, words, 15)
    entries = learned(spark, bad, good).weights
    assert len(words) > 2100 and len(entries) >= len(words) and all(f" {w} "[:5] in {e[:5] for e in entries} for w in words)


def test_nothing_to_learn(spark):
    labels = "doc_id long, toxic int"
    table = docs(spark, awkward())
    for rows in ([], [(1, 1), (2, 1)], [(None, None)], [(1, 0), (2, None)]):
        assert toxicity.learn(table, spark.createDataFrame(rows, labels)).weights == {}
    assert toxicity.learn(docs(spark, []), spark.createDataFrame([(1, 0), (2, 1)], labels)).weights == {}
    extra = table.withColumns({"score": F.lit(1), "t": F.lit(2)})
    assert extra.withColumn("tox", toxicity.toxicity(F.col("text"), toxicity.Model({}))).count() == len(awkward())


def languages(spark):
    parts = {"xx": "ba be bi bo bu".split(), "yy": "ka ke ki ko ku".split(), "zz": "ßa ßé ßi ño ñu".split()}
    draw = random.Random(3)
    rows = []
    for i in range(240):
        lang = sorted(parts)[i % 3]
        words = ["".join(draw.choice(parts[lang]) for _ in range(draw.randrange(1, 4))) for _ in range(12)]
        rows.append((i, " ".join(words), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language(spark):
    table = languages(spark)
    model = langid.learn(table.where("doc_id < 160"))
    guessed = table.where("doc_id >= 160").withColumn("guess", langid.language(F.col("text"), model)).collect()
    assert all(r.guess.lang == r.lang and 0 < r.guess.score <= 1 for r in guessed)


def test_backoff(spark):
    model = langid.learn(languages(spark))
    texts = ["bababebibo", "ßaßañu", "1234 ?!", "", None, "日本", "KAKI"]
    rows = docs(spark, list(enumerate(texts))).select("doc_id", langid.language(F.col("text"), model).alias("g"))
    got = {r.doc_id: (r.g.lang, r.g.score) for r in rows.collect()}
    assert [got[i][0] for i in (0, 1, 6)] == ["xx", "zz", "yy"]
    assert got[2] == got[3] == got[4] == ("und", 0.0)
    assert got[5][0] == "xx" and got[5][1] == pytest.approx(1 / 3)  # nothing known: all alike, the first by name
    first = langid._Rows(model).backoff("bababebibo")
    assert first[0] == max(first) > min(first) and "bababebibo" not in model.words


def test_language_without_rows(spark):
    empty = langid.learn(docs(spark, []))
    assert empty.languages == ()
    rows = docs(spark, awkward()).withColumn("score", F.lit(1)).select(langid.language(F.col("text"), empty).alias("g"))
    assert {(r.g.lang, r.g.score) for r in rows.collect()} == {("und", 0.0)}


def test_model_is_bounded(spark):
    model = langid.learn(languages(spark), max_words=5, max_grams=7)
    assert len(model.words) <= 3 * 5 and len(model.grams) <= 3 * 7 * len(langid.LENGTHS)


def test_licenses(spark):
    texts = ["Released under the MIT License.", "text\nLICENSED under the apache license version 2.0\nmore", "licensed under cc by",
             licenses.TEMPLATES["MIT-text"].replace(", ", ",\n"), None, "", "word", "mit", prose(1, 300),
             "Licensed under CC BY-NC 4.0.\nReleased under the MIT License."]
    rows = docs(spark, list(enumerate(texts))).withColumn("found", licenses.licenses(F.col("text"))).collect()
    found = {r.doc_id: [(x.license, round(x.dice, 3)) for x in r.found] for r in rows}
    assert found[0] == [("MIT", 1.0)]
    assert found[1] == [("Apache-2.0", 1.0)]
    assert found[3] == [("MIT-text", 1.0)]
    assert [found[i] for i in (4, 5, 6, 7, 8)] == [[]] * 5
    assert [x[0] for x in found[9]] == ["CC-BY-NC-4.0", "MIT"]
    assert found[2] == [("CC-BY-4.0", 0.75)] or found[2] == []


def test_size_bounds_lose_nothing():
    """Pruned templates are those that can't reach the threshold."""
    from collections import Counter

    names = {f"t{i}": prose(i, 3 + i) for i in range(30)}
    scanner = licenses.Scanner(names, 0.5)
    draw = random.Random(5)
    for _ in range(200):
        words = prose(draw.randrange(30), draw.randrange(2, 40)).split()
        best: dict = {}
        scanner.part(words, best)
        bag = Counter(licenses.bigrams(words))
        for name, text in names.items():
            other = Counter(licenses.bigrams(text.split()))
            dice = 2 * (bag & other).total() / (bag.total() + other.total())
            assert best.get(name, 0) == (dice if dice >= 0.5 else 0)


def test_wrapped_and_inline_notices(spark):
    """Notices inside a line and texts wrapped over lines are found wherever they stand."""
    every = licenses.templates_and_texts()
    around = [prose(i, 90).replace(". ", ".\n") for i in range(2)]
    wrapped = textwrap.fill(licenses.TEMPLATES["MIT-text"], 78)
    texts = ["This project is licensed under the MIT License.", "Released under the MIT License. See LICENSE for details.",
             f"{around[0]}\n\n{wrapped}\n\n{around[1]}", "MIT License\n\nCopyright (c) 2026 A. Writer\n\n" + every["MIT-full"],
             *(f"{around[0]}\n{t}\n{around[1]}" for n, t in sorted(every.items()) if n not in licenses.TEMPLATES)]
    rows = docs(spark, list(enumerate(texts))).withColumn("found", licenses.licenses(F.col("text"))).collect()
    found = {r.doc_id: [(x.license, round(x.dice, 3)) for x in r.found] for r in rows}
    assert found[0] == [("MIT", 0.857)]
    assert found[1] == [("MIT", 1.0)]
    assert found[2] == [("MIT-text", 1.0)]
    assert ("MIT-full", 1.0) in found[3]
    for i, name in enumerate(sorted(set(every) - set(licenses.TEMPLATES)), 4):
        assert (name, 1.0) in found[i]


def naive_scan(names, least, words, low, high, found):
    """The best run of words of all templates, every further one of that template as good, and the same between them."""
    from collections import Counter

    runs = []
    for a in range(low, high):
        for b in range(a + 1, high + 1):
            bag = Counter(licenses.bigrams(words[a : b + 1]))
            for name, text in names.items():
                other = Counter(licenses.bigrams(text.split()))
                dice = 2 * (bag & other).total() / (bag.total() + other.total())
                if dice >= least:
                    runs.append((-dice, -other.total(), name, a, b))
    if not runs:
        return
    top = min(runs)[:3]
    found[top[2]] = max(found.get(top[2], 0), -top[0])
    for run in sorted(r for r in runs if r[:3] == top):
        if run[3] >= low:
            naive_scan(names, least, words, low, run[3], found)
            low = run[4]
    naive_scan(names, least, words, low, high, found)


def test_windows_against_all_runs_of_words():
    """Of all runs of words the best is taken, then the best of what is left, also with repeated bigrams."""
    draw = random.Random(7)
    some = lambda n: [draw.choice("abcd") for _ in range(n)]
    names = {f"t{i}": " ".join(some(3 + i)) for i in range(12)}
    scanner = licenses.Scanner(names, 0.7)
    for _ in range(60):
        words, want = some(draw.randrange(0, 30)), {}
        naive_scan(names, 0.7, words, 0, len(words) - 1, want)
        assert scanner.scan(draw.choice(" \n").join(words)) == sorted(want.items(), key=lambda b: (-b[1], b[0]))


def test_a_notice_counts_for_the_license_it_names():
    scanner = licenses.Scanner(licenses.templates_and_texts(), licenses.LEAST)
    for name, text in licenses.TEMPLATES.items():
        assert scanner.scan(text) == [(name, 1.0)]
    assert scanner.scan("Licensed under CC BY-NC-SA 4.0") == [("CC-BY-NC-SA-4.0", 1.0)]
    both = f"{licenses.TEMPLATES['GPL-3.0']}\nand parts: {licenses.TEMPLATES['LGPL-3.0']} " * 400
    assert scanner.scan(both) == [("GPL-3.0", 1.0), ("LGPL-3.0", 1.0)]


def naive_hits(model, text):
    """Hits by trying every entry at every place."""
    folded = f" {' '.join(toxicity.fold(text))} "
    spared = []
    for phrase in model.exceptions:
        p = f" {' '.join(toxicity.fold(phrase))} "
        spared += [(i, i + len(p) - 1) for i in range(len(folded)) if p.strip() and folded.startswith(p, i)]
    found = []
    for i in range(len(folded)):
        at = [e for e in model.weights if folded.startswith(e, i)]
        if at and not any(a <= i < b for a, b in spared):
            found.append((i, model.weights[max(at, key=len)]))
    return found


def test_hits_are_those_of_a_naive_search():
    draw = random.Random(9)
    words = ["ab", "abc", "abca", "bc", "cab", "a", "b-c", "ABC", "c4b"]
    for _ in range(300):
        entries = {f" {draw.choice(words[:5])}{draw.choice(['', ' '])}": draw.random() for _ in range(4)}
        phrases = tuple(" ".join(draw.choice(words) for _ in range(draw.randrange(1, 4))) for _ in range(3))
        model = toxicity.Model(entries, phrases)
        text = " ".join(draw.choice(words) for _ in range(draw.randrange(40)))
        folded = f" {' '.join(toxicity.fold(text))} "
        assert toxicity.Matcher(model).hits(folded) == naive_hits(model, text), (entries, phrases, text)


def test_a_text_of_megabytes_takes_seconds():
    """Exception phrases and hits all over a long text, and words of any length around them."""
    text = "trash can trash " * 300_000 + "idiot " * 20_000 + "x" * 500_000
    start = time.perf_counter()
    hits, weight, words = toxicity.Matcher(MODEL).weigh(text)
    assert (hits, words) == (320_000, 920_001) and weight == 660_000
    batch = pa.RecordBatch.from_pydict({"label": pa.array([1], pa.int32()), "text": [text]})
    pairs = {r for b in toxicity._pairs(MODEL, [batch]) for r in b.column("pattern").to_pylist()}
    assert pairs == {"can trash", "trash trash", "trash idiot", "idiot idiot"}
    assert time.perf_counter() - start < 20


def test_what_is_a_word():
    """Numerals are no letters, and marks belong to the letter before."""
    assert langid._words("½ ² ① 12 _") == [] and langid._words("हिन्दी भाषा") == ["हिन्दी", "भाषा"]
    assert langid._words("Don't x2y É-É\u0301") == ["don", "t", "x", "y", "é", "é\u0301"]
    assert langid._words("\u0301 \u0301a") == ["a"] and langid._words(None) == langid._words("") == []


def test_texts_without_a_letter_have_no_language(spark):
    model = langid.learn(languages(spark))
    rows = docs(spark, list(enumerate(["½ ² ①", "1 2", "\u0301", "a"]))).select("doc_id", langid.language(F.col("text"), model).alias("g"))
    got = {r.doc_id: r.g.lang for r in rows.collect()}
    assert [got[i] for i in range(3)] == ["und"] * 3 and got[3] != "und"


def test_a_small_language_keeps_its_words_beside_a_large_one(spark):
    draw = random.Random(4)
    small = coined(draw, 300, 9)
    rows = [(i, " ".join(coined(draw, 40, 7)), "large") for i in range(2000)]
    rows += [(10_000 + i, " ".join(draw.choice(small) for _ in range(30)), "small") for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(table, max_words=400, max_grams=400)
    assert set(small) <= set(model.words)


def naive_language(model, text):
    """The sums of the definition, word by word and n-gram by n-gram."""
    words = [w for w in langid._words(text)]
    if not words or not model.languages:
        return "und", 0.0
    known, grams = dict(zip(model.words, model.word_logs)), dict(zip(model.grams, model.gram_logs))
    sums = [0.0] * len(model.languages)
    for word in words:
        part = known.get(word)
        for n in (5, 4, 3, 2, 1) if part is None else ():
            marked = word if n == 1 else f"<{word}>"
            found = [grams[marked[i : i + n]] for i in range(len(marked)) if marked[i : i + n] in grams and len(marked[i : i + n]) == n]
            if found:
                part = [sum(column) / len(found) for column in zip(*found)]
                break
        sums = [s + p for s, p in zip(sums, part if part is not None else [0.0] * len(sums))]
    scaled = [s / len(words) ** 0.5 for s in sums]
    best = max(range(len(sums)), key=lambda i: (scaled[i], -i))
    return model.languages[best], 1 / sum(math.exp(s - scaled[best]) for s in scaled)


def test_language_equals_the_definition(spark):
    table = languages(spark)
    model = langid.learn(table, max_words=30, max_grams=25)
    texts = [r.text for r in table.limit(60).collect()] + ["bababebibo kißa", "zzz ñu", "日本", "b k", prose(1, 50), "ba " * 5000]
    rows = docs(spark, list(enumerate(texts))).select("doc_id", langid.language(F.col("text"), model).alias("g")).collect()
    for r in rows:
        lang, score = naive_language(model, texts[r.doc_id])
        assert r.g.lang == lang and r.g.score == pytest.approx(score, rel=1e-6)


def test_rows_are_chosen_by_id(spark):
    """Copies are not all taken or all left."""
    table = spark.range(4000).selectExpr("id AS doc_id", "concat('same text ', id DIV 4000) AS text", "'xx' AS lang")
    model = langid.learn(table, max_rows=400)
    assert set(model.words) == {"same", "text"}
