"""Encoding against the library on whole texts, and the round trip."""

from __future__ import annotations

import base64

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from convoy.llm import bpe
from tests.llm.data import awkward, docs, prose

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def longer():
    return [
        (30, "a" * 900),
        (31, " " * 700),
        (32, "don't we'll they've I'm it's you'd we're " * 30),
        (33, ("word  \n\n  \t next　 " * 60) + "   "),
        (34, "x" * 150 + " " + "9" * 300 + "!?" * 200 + "é" * 250),
        (35, "<|endoftext|> " * 40),
        (36, prose(8, 300)),
        (37, prose(8, 300)),
        (38, "日本語のテキスト" * 80 + "😀" * 100),
        (39, ("b" * 130 + " ") * 9),
    ]


@pytest.mark.parametrize("chunk,overlap", [(1 << 15, 1 << 10), (120, 40), (64, 20)])
def test_encode_and_decode(spark, library, chunk, overlap):
    rows = [*awkward(), *longer()]
    table = docs(spark, rows)
    both = bpe.decode(bpe.encode(table, PATH, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap), PATH)
    got = both.withColumn("digest", bpe.ids_digest(F.col("ids"))).collect()
    want = sorted(((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in got), key=repr) == want


def test_white_space_is_the_library_s(library):
    import regex

    split = regex.compile(public_tokenizers.PATTERN).findall
    ids = bpe._Ids(library._mergeable_ranks)
    for code in [*range(0x3100), *range(0xA000, 0xAC00), *range(0xFE00, 0x10000)]:
        if not 0xD800 <= code < 0xE000:
            text = f"a{chr(code)}{chr(code)} b{chr(code)}1"
            own = b"".join(map(ids.__getitem__, split(text)))
            assert memoryview(own).cast("i").tolist() == library.encode_ordinary(text), hex(code)


def test_columns_and_empty_table(spark):
    table = docs(spark, longer()).withColumns({"text_key": F.lit(1), "n": F.lit(2)})
    assert bpe.encode(table, PATH, public_tokenizers.PATTERN, chunk=100, overlap=30).columns == [*table.columns, "ids"]
    assert bpe.encode(docs(spark, []), PATH, public_tokenizers.PATTERN).count() == 0


def test_a_batch_becomes_python_objects_some_rows_at_a_time():
    import pyarrow as pa

    from convoy.llm import bpe as module

    for n in (0, 1, 256, 700):
        rows = pa.array([None if i % 3 == 0 else f"t{i}" for i in range(n)], pa.string())
        parts = list(module._few(rows))
        assert parts and max(len(part) for part in parts) <= module.AT_ONCE
        assert pa.concat_arrays(parts) == rows
