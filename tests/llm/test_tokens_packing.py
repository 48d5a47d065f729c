import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from graphweave.llm import packing, token_files
from graphweave.llm.tokens import BatchEncoder, byte_letters, token_pieces

WORDS = str(public_tokenizers.path("word_bpe_49k.json"))
BYTES = str(public_tokenizers.path("byte_bpe_50k.json"))
ODD = [
    "", None, " ", "Hello, world's isn't I'LL 12 3x ###$$$ a\tb\nc\x0bd", "Été ÜBER straße ŉ İstanbul ΣΑΣ σας", "한국어 日本 é Å",
    "x<|endoftext|>y <| <|startoftext|>", "a\x00b \x7f\x85\xa0c d​e", "🙂👍🏽 ªº²½ ǅ ﬁ", "don't'S'd'Ve 's's", "\x1c\x1d a", "ſ K Å",
]


def texts(seed, n=60):
    rnd = random.Random(seed)
    alphabet = "abcXYZ019'.,!#éßñÇ \n\t漢́"
    return ODD + ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(200))) for _ in range(n)]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_pieces_equal_the_library(make_docs, path):
    tok = Tokenizer.from_file(path)
    rows = list(enumerate(texts(1)))
    got = {}
    for r in token_pieces(make_docs(rows), path, capacity=16).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        parts = sorted(got[i], key=lambda r: r.piece)
        assert [x for p in parts for x in p.ids] == ids
        assert [p.length for p in parts[:-1]] == [16] * (len(parts) - 1)
        for p in parts:
            assert p.start == 16 * p.piece and p.length == len(p.ids)
            assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())


def test_every_character_alone():
    enc, tok = BatchEncoder(WORDS), Tokenizer.from_file(WORDS)
    for c in [chr(i) for i in range(0x250)] + ["ʼ", "ẞ", "Ω"]:
        raw = f"a{c}B".encode()
        if not any(b in raw for b in (0x20, *range(9, 14))):
            assert list(enc.run_ids(raw)) == tok.encode(raw.decode(), add_special_tokens=False).ids, hex(ord(c))
    assert byte_letters()[0x20] == "Ġ" and len(set(byte_letters())) == 256


def layout(rows, capacity):
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in seqs.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return seqs


def optimal_pairs(lengths, capacity):
    """Fewest sequences for lengths above a third: pair by exhaustive matching on few items."""
    best = [len(lengths)]

    def go(rest, used):
        if used >= best[0]:
            return
        if not rest:
            best[0] = used
            return
        a, *rest = rest
        go(rest, used + 1)
        for k, b in enumerate(rest):
            if a + b <= capacity:
                go(rest[:k] + rest[k + 1 :], used + 1)

    go(sorted(lengths, reverse=True), 0)
    return best[0]


def test_large_items_are_matched_optimally():
    for seed in range(60):
        rnd = random.Random(seed)
        lengths = [rnd.randrange(11, 31) for _ in range(9)]
        counts = {x: lengths.count(x) for x in lengths}
        assert packing.plan(counts, 30)[1] == optimal_pairs(lengths, 30)


def test_plan_is_tight_on_small_items():
    rnd = random.Random(4)
    counts = {}
    for _ in range(5000):
        n = min(4096, int(rnd.lognormvariate(6, 1.2)) + 1)
        counts[n] = counts.get(n, 0) + 1
    least = -(-sum(k * v for k, v in counts.items()) // 4096)
    assert packing.plan(counts, 4096)[1] <= least * 1.01 + 1


def test_pack_documents(make_docs, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 7)
    rows = list(enumerate(texts(2))) + [(None, "a b c"), (3, "again"), (3, "again")] + [(500 + i, "same text") for i in range(50)]
    docs = make_docs(rows).withColumn("sequence_id", packing.F.lit("clash"))
    got = packing.pack_documents(docs, WORDS, capacity=24).collect()
    pieces = token_pieces(docs, WORDS, capacity=24).collect()
    key = lambda r: repr((r.doc_id, r.piece, r.start, r.length, r.ids_crc32))
    assert sorted(map(key, got)) == sorted(map(key, pieces))
    seqs = layout(got, 24)
    assert len(seqs) <= -(-sum(r.length for r in got) // 24) * 1.1 + 1
    assert packing.pack_documents(make_docs([]), WORDS).collect() == []
    with pytest.raises(ValueError):
        packing.pack_pieces(token_pieces(docs, WORDS, capacity=24), 8)


@pytest.mark.parametrize("block", [3, 64, 1 << 20])
def test_token_files_round_trip(make_docs, tmp_path, spark, block):
    tok = Tokenizer.from_file(WORDS)
    rows = [(i, t) for i, t in enumerate(texts(3)) if "<|" not in (t or "")] + [(None, "x y"), (7, "twice"), (7, "twice")]
    files = token_files.write_token_files(make_docs(rows), str(tmp_path), WORDS, 49407, file_tokens=400)
    files = spark.createDataFrame(files.collect(), files.schema)
    got = {}
    for r in token_files.token_counts(files.select("file", "n_tokens"), 49407, block_tokens=block).collect():
        got.setdefault(r.file, []).append(r)
    count = []
    for f in files.collect():
        docs = sorted(got[f.file], key=lambda r: r.ordinal)
        assert [d.ordinal for d in docs] == list(range(len(f.doc_ids))) and all(d.complete for d in docs)
        assert docs[0].start == 0 and all(b.start == a.start + a.n_tokens + 1 for a, b in zip(docs, docs[1:]))
        count += [(i, d.n_tokens) for i, d in zip(f.doc_ids, docs)]
    want = [(i, len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert sorted(count, key=repr) == sorted(want, key=repr)


def test_separators_at_block_edges(spark, tmp_path):
    ids = np.array([9, 9, 5, 1, 2, 9, 3, 3, 3, 3, 3, 9, 4], "<u2")
    (tmp_path / "a.bin").write_bytes(ids.tobytes())
    (tmp_path / "b.bin").write_bytes(b"")
    files = spark.createDataFrame([(str(tmp_path / "a.bin"), len(ids)), (str(tmp_path / "b.bin"), 0)], "file string, n_tokens long")
    for block in (1, 2, 5, 6, 100):
        got = sorted(tuple(r)[1:] for r in token_files.token_counts(files, 9, block_tokens=block).collect())
        assert got == [(0, 0, 0, True), (1, 1, 0, True), (2, 2, 3, True), (3, 6, 5, True), (4, 12, 1, False)]


def test_separator_in_text_is_refused(make_docs, tmp_path):
    with pytest.raises(Exception, match="separator"):
        token_files.write_token_files(make_docs([(1, "a <|endoftext|>")]), str(tmp_path), WORDS, 49407).collect()


def test_document_counts(make_docs):
    got = token_files.document_token_counts(make_docs([(1, "a b"), (2, None), (None, "c")]), WORDS, 49407).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, 2), (2, 0), (None, 1)], key=repr)
    assert token_files.document_token_counts(make_docs([]), WORDS, 49407).collect() == []


@pytest.mark.parametrize("dtype", ["<u2", "<i2"])
def test_separators_inside_texts_are_counted(make_docs, dtype):
    tok = Tokenizer.from_file(WORDS)
    rows = list(enumerate(texts(5, 20) + ["<|endoftext|>", "a <|endoftext|>", "<|endoftext|><|endoftext|> b<|endoftext|>c"]))
    got = token_files.document_token_counts(make_docs(rows), WORDS, 49407, dtype).collect()
    assert sorted(map(tuple, got)) == [(i, len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]


def test_encoder_works_on_short_stretches():
    enc = BatchEncoder(WORDS)
    text = "some plain words of a text " * 10_000  # 270 kB
    got = list(enc.encode(pa.array([text] * 8)))
    assert max(len(offsets) - 1 for _, offsets in got) <= 2  # working arrays are many times the bytes of a stretch
    assert sum(len(offsets) - 1 for _, offsets in got) == 8
    want = enc.tok.encode(text, add_special_tokens=False).ids
    assert all(np.array_equal(ids[a:b], want) for ids, o in got for a, b in zip(o[:-1], o[1:]))
