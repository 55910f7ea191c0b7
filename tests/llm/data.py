"""Small tables with the awkward rows that every operator must handle."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    """Words that hardly repeat in the same order."""
    draw = random.Random(seed)
    return " ".join(f"{draw.choice(WORDS)}{draw.randrange(40)}" for _ in range(n))


def docs(spark, texts, lang="en"):
    """A documents table of (id, text) pairs."""
    rows = [(i, t, lang, "src", None if t is None else len(t)) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def awkward() -> list[tuple[int | None, str | None]]:
    """Nulls, blanks, odd white space, ties, repeated rows, rows that share an id, and a long text."""
    passage = prose(1, 30)
    return [
        (1, passage),
        (2, f"{prose(2, 20)} {passage} {prose(3, 20)}"),
        (3, None),
        (4, ""),
        (5, " \t\n\r\x0b\x0c "),
        (6, "one"),
        (7, f"\n{passage}\n\n\ttail of it end"),
        (8, passage),
        (8, passage),
        (9, prose(4, 40)),
        (9, f"{passage} other"),
        (None, passage),
        (None, None),
        (10, "the the " * 40),
        (11, "Ünïcode ÉTÉ 😀😀 日本語 text " * 12),
        (12, (prose(5, 500) + " ") * 4 + passage),
        (-3, f"{prose(6, 15)}\n{passage}"),
    ]
