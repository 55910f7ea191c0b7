"""License scan: runs of words of a text against license templates, by the Dice coefficient over word bigrams.

Every run of words is a window, within a line or over several, up to the whole text. Text is lower-cased and cut into runs
of ASCII letters and digits. Two bigram bags of sizes a and b can't reach the threshold t unless a/b lies between t/(2-t)
and (2-t)/t, so a window of a template of size b holds at least b t/(2-t) bigrams of it within b (2-t)/t. The best window
starts and ends with a bigram of the template; only starts where bigrams lie that dense are looked at.

Of templates whose windows overlap only the best is kept, so that a notice counts for the license it names and not for those
with similar words.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from functools import cache
from importlib import resources
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = re.compile(r"[A-Za-z0-9]+")
#: The same words in UTF-8 of which ASCII letters are lower-cased.
LOWER_WORD = re.compile(rb"[a-z0-9]+")
LEAST = 0.8

# Notices by which texts name their license, and the grants of two short licenses.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "EPL-2.0": "Made available under the terms of the Eclipse Public License 2.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Subject to the terms of the Mozilla Public License, version 2.0.",
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
}


@cache
def templates_and_texts() -> dict[str, str]:
    """``TEMPLATES``, the full license texts ("-full") and the headers that go into source files ("-header")."""
    files = (f for f in resources.files("convoy.llm").joinpath("license_texts").iterdir() if f.name.endswith(".txt"))
    return TEMPLATES | {f.name.removesuffix(".txt"): f.read_text("utf-8") for f in sorted(files, key=lambda f: f.name)}


def bigrams(words: list[str]) -> list[tuple[str, str]]:
    """Neighbouring words in lower case."""
    words = [w.lower() for w in words]
    return list(zip(words, words[1:]))


class Scanner:
    """Templates by size."""

    def __init__(self, templates: Mapping[str, str], least: float):
        self.least = least
        bags = [(len(b), name, Counter(b)) for name, b in ((n, bigrams(WORD.findall(t))) for n, t in templates.items()) if b]
        self.bags = sorted(bags, key=lambda b: b[:2])
        self.sizes = [b[0] for b in self.bags]
        self.ratio = least / (2 - least)
        self.grams: dict[tuple[bytes, bytes], int] = {}
        for _, _, bag in self.bags:
            for one, two in bag:
                self.grams.setdefault((one.encode(), two.encode()), len(self.grams))
        # (fewest bigrams a window shares, most it holds, size, name, how often each bigram occurs), the smallest first
        self.wanted = []
        for size, name, bag in self.bags:
            often = np.zeros(len(self.grams), np.int64)
            often[[self.grams[one.encode(), two.encode()] for one, two in bag]] = list(bag.values())
            fewest, most = math.ceil(size * self.ratio * (1 - 1e-12)), math.floor(size / self.ratio * (1 + 1e-12))
            self.wanted.append((fewest, most, size, name, often))

    def part(self, words: list[str], best: dict[str, float]) -> None:
        """Compare one part as a whole with the templates of a size it can match; no window of a text is worse than this."""
        size = len(words) - 1
        if size < 1:
            return
        low = bisect.bisect_left(self.sizes, size * self.ratio * (1 - 1e-12))
        high = bisect.bisect_right(self.sizes, size / self.ratio * (1 + 1e-12))
        if low == high:
            return
        bag = Counter(bigrams(words))
        for other, name, template in self.bags[low:high]:
            shared = sum(min(n, bag[g]) for g, n in template.items() if g in bag)
            dice = 2 * shared / (size + other)
            if dice >= self.least and dice > best.get(name, 0):
                best[name] = dice

    def scan(self, text: str | None) -> list[tuple[str, float]]:
        """(name, dice) of the best template of every place, the best first, then by name.

        The best window of all is taken, of equal ones that of the largest template, then the first by name, and so is every
        further place where that template matches as well. What lies between is scanned again for the others.
        """
        words = LOWER_WORD.findall(text.encode().lower()) if text else []
        if len(words) < 2:
            return []
        pairs = zip(words, islice(words, 1, None))
        grams = np.fromiter(map(self.grams.get, pairs, repeat(-1)), np.int64, len(words) - 1)
        places = np.flatnonzero(grams >= 0)
        grams, best = grams[places], {}
        todo = [(0, len(words) - 1, self.wanted)]
        while todo:
            low, high, wanted = todo.pop()
            found = self.matches(places, grams, low, high, wanted)
            if not found:
                continue
            dice, windows, template = min(found, key=lambda f: (-f[0], -f[2][2], f[2][3]))
            name = template[3]
            best[name] = max(best.get(name, 0.0), dice)
            rest = [f[2] for f in found]
            for first, last in windows:
                todo.append((low, first, rest))
                low = last + 1
            todo.append((low, high, rest))
        return sorted(best.items(), key=lambda b: (-b[1], b[0]))

    def matches(self, places: np.ndarray, grams: np.ndarray, low: int, high: int, wanted: list) -> list:
        """(dice, windows, template) of every template found between two places."""
        first, last = np.searchsorted(places, [low, high])
        places, grams, found = places[first:last], grams[first:last], []
        for template in wanted:
            fewest, most, size, _, often = template
            if len(places) < fewest:
                break
            times = often[grams]
            held = np.flatnonzero(times)
            if len(held) >= fewest:
                dice, windows = self.window(places[held], grams[held], times[held], fewest, most, size)
                if dice >= self.least:
                    found.append((dice, windows, template))
        return found

    @staticmethod
    def window(places: np.ndarray, grams: np.ndarray, times: np.ndarray, fewest: int, most: int, size: int):
        """The largest Dice of any window with a template, whose bigrams lie at ``places`` and occur ``times`` in it, and the
        (first, last) bigrams of the windows that have it, from the left and without overlap."""
        starts = np.flatnonzero(places[fewest - 1 :] - places[: len(places) - fewest + 1] < most)
        if not len(starts):
            return 0.0, []
        # an occurrence counts in windows that start after the one that lies ``times`` of the same bigram before it
        order = np.argsort(grams, kind="stable")
        grouped = grams[order]
        earlier = np.arange(len(order)) - times[order]
        spent = np.empty(len(order), np.int64)
        spent[order] = np.where(earlier >= np.searchsorted(grouped, grouped), order[earlier], -1)
        stops = np.searchsorted(places, places[starts] + most)
        reach = np.minimum(stops - starts, size)
        reach = 2 * reach / (reach + size)
        best, windows = 0.0, []
        for start, stop, bound in zip(starts.tolist(), stops.tolist(), reach.tolist()):
            if bound < best or windows and bound == best and places[start] <= windows[-1][1]:
                continue
            shared = np.cumsum(spent[start:stop] < start)
            dice = 2 * shared / (places[start:stop] - places[start] + 1 + size)
            top = int(dice.argmax())
            if dice[top] >= best:
                if dice[top] > best:
                    best, windows = float(dice[top]), []
                if not windows or places[start] > windows[-1][1]:
                    windows.append((int(places[start]), int(places[start + top])))
        return best, windows


def licenses(text: Column, templates: Mapping[str, str] | None = None, least: float = LEAST) -> Column:
    """An array of struct (license string, dice double) for every text: the templates found in it, best first.

    A template counts with its best window, only from ``least`` on, and only where no other one matches the same place better.
    Null and empty texts, and templates of under two words, are never found. Without ``templates`` they are those of
    ``templates_and_texts``.
    """
    templates = templates_and_texts() if templates is None else templates

    @F.arrow_udf("array<struct<license: string, dice: double>>")
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(templates, least)
        kind = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64())]))
        for texts in batches:
            found = [[{"license": n, "dice": d} for n, d in scanner.scan(t)] for t in texts.to_pylist()]
            yield pa.array(found, kind)

    return scanned(text)
