"""P1 contract: fixed chunks and the recursive splitter, checked against a plain recursion."""

import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from graphweave.operators import chunking


def test_fixed_contract(spark):
    texts = ["", "a", "x" * 499, "y" * 1500, "z" * 1501, "".join(chr(65 + i % 26) for i in range(4321)),
             "é\n😀" * 1700]  # multi-byte and supplementary-plane characters count as one
    df = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "document_name string, text string")
    out = chunking.chunk(df, 1500, 500).collect()
    by = {}
    for r in out:
        by.setdefault(r.document_name, []).append(r)
    assert "d0" not in by  # empty text: no chunk
    for i, t in enumerate(texts[1:], start=1):
        rows = sorted(by[f"d{i}"], key=lambda r: r.chunk_number)
        assert len(rows) == max(1, math.ceil((len(t) - 500) / 1000))
        assert all(len(r.text) <= 1500 for r in rows)
        assert [r.chunk_name for r in rows] == [f"d{i}_chunk_{n}" for n in range(len(rows))]
        for a, b in zip(rows, rows[1:]):
            assert a.text[-500:] == b.text[:500]
        assert rows[-1].text == t[(len(rows) - 1) * 1000:]


def test_fixed_rejects_bad_overlap(spark):
    df = spark.createDataFrame([("d", "t")], "document_name string, text string")
    try:
        chunking.chunk(df, 100, 100)
    except ValueError:
        return
    raise AssertionError("overlap >= size must be rejected")


BREAKS = ("\n\n", "\n", " ", "")


def plain_split(text: str, size: int, overlap: int, separators=BREAKS) -> list[str]:
    """Split ``text`` into pieces of at most ``size`` characters.

    The first separator that occurs in the text is used; pieces still longer than
    ``size`` are split again with the next separator. Small pieces are packed
    greedily into chunks; a new chunk starts with trailing pieces of the previous
    one as long as they fit in ``overlap`` characters. Separators are kept on the
    left of the piece that follows them, so no character is lost."""
    if not text:
        return []
    sep = separators[-1]
    rest: tuple = ()
    for i, s in enumerate(separators):
        if s == "" or s in text:
            sep, rest = s, separators[i + 1 :]
            break
    if sep:
        parts = text.split(sep)
        pieces = [parts[0]] + [sep + p for p in parts[1:]]
    else:
        pieces = list(text)
    pieces = [p for p in pieces if p]
    out: list[str] = []
    window: list[str] = []
    wlen = 0

    def flush():
        if window:
            out.append("".join(window))

    for p in pieces:
        if len(p) > size:
            flush()
            window, wlen = [], 0
            out.extend(plain_split(p, size, overlap, rest or ("",)))
            continue
        if wlen + len(p) > size and window:
            flush()
            # keep a tail of the window as overlap
            while window and (wlen > overlap or wlen + len(p) > size):
                wlen -= len(window[0])
                window.pop(0)
        window.append(p)
        wlen += len(p)
    flush()
    return out


alphabet = st.sampled_from(list("ab \n") + ["\n\n", "word ", "Longerword "])


@settings(max_examples=200, deadline=None)
@given(st.lists(alphabet, max_size=80).map("".join), st.integers(5, 40), st.integers(0, 4))
def test_plain_split_covers_text(text, size, overlap):
    chunks = plain_split(text, size, overlap)
    if not text:
        assert chunks == []
        return
    pos = 0
    for c in chunks:
        assert 0 < len(c) <= size
        idx = text.rfind(c, 0, pos + len(c))  # latest occurrence starting at or before pos
        assert idx != -1 and idx <= pos  # no gap between consecutive chunks
        pos = max(pos, idx + len(c))
    assert pos == len(text)


def recursive_chunks(spark, texts, size, overlap):
    df = spark.createDataFrame([(str(i), t, "x") for i, t in enumerate(texts)], "document_name string, text string, __chunk0 string")
    got = {}
    for r in chunking.chunk(df, size, overlap, mode="recursive").orderBy("chunk_number").collect():
        assert r.chunk_number == len(got.setdefault(r.document_name, []))
        assert r.chunk_name == f"{r.document_name}_chunk_{r.chunk_number}"
        got[r.document_name].append(r.text)
    return [got.get(str(i), []) for i in range(len(texts))]


def test_recursive_equals_plain_recursion(spark):
    rnd = random.Random(5)
    parts = ["a", "é", "😀", " ", "  ", "\n", "\n\n", "\n\n\n", "word ", "Longerword ", "averyveryverylongwordindeed" * 2]
    texts = ["".join(rnd.choices(parts, k=rnd.randrange(90))) for _ in range(150)]
    texts += [None, "", " ", "\n\n\n\n", "x" * 500, "para one\n\npara two is longer\n\nthree", "same\n\n" * 40, "w " * 700]
    for size, overlap in [(20, 5), (12, 0), (9, 8), (50, 30), (1, 0)]:
        assert recursive_chunks(spark, texts, size, overlap) == [plain_split(t or "", size, overlap) for t in texts]


def test_recursive_many_chunks(spark):
    """More chunks than one block of the fold holds, in texts with and without breaks."""
    rnd = random.Random(6)
    texts = [" ".join("w" * rnd.randrange(1, 9) for _ in range(60_000)), "y" * 200_000,
             "\n".join("line " * rnd.randrange(1, 60) for _ in range(3_000))]
    assert recursive_chunks(spark, texts, 150, 50) == [plain_split(t, 150, 50) for t in texts]


def test_recursive_plan_has_no_python(spark):
    df = spark.createDataFrame([("d", "t")], "document_name string, text string")
    plan = chunking.chunk(df, 20, 5, mode="recursive")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan
