import hashlib
import random

import numpy as np

from graphweave.llm import suffix_dedup as S


def brute(rows, length):
    """Count every string of ``length`` bytes of the corpus, then cover."""
    data = [(i, (t or "").encode()) for i, t in rows]
    count = {}
    for _, b in data:
        for k in range(len(b) - length + 1):
            count[b[k : k + length]] = count.get(b[k : k + length], 0) + 1
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(b)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def digest(res):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.span_starts), hashlib.sha256(r.kept).hexdigest())
                   for r in res.collect()), key=repr)


def corpus(seed, length, alphabet, n=40):
    rnd = random.Random(seed)
    word = lambda k: "".join(rnd.choice(alphabet) for _ in range(k))
    passage = [word(length + d) for d in (-1, 0, 1, 7, 3 * length)]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randrange(4)):
            parts += [word(rnd.randrange(2 * length)), rnd.choice(passage)]
        rows.append((rnd.randrange(10**6), "".join(parts)))
    rows += [(-5, "a" * 3 * length), (-6, "ab" * length), (-7, ""), (-8, None), (-9, rows[3][1]), (-9, rows[3][1])]
    return rows + [(None, rows[4][1] + "z")]


def test_equals_brute_force(make_docs):
    for seed, length, alphabet in [(1, 12, "abcdefghij"), (2, 9, "ab"), (3, 16, "aé\u4e00 \n\0"), (4, 400, "abcdefgh ")]:
        rows = corpus(seed, length, alphabet)
        assert digest(S.remove_repeated_bytes(make_docs(rows), length)) == brute(rows, length)


def test_hot_cores_and_many_blocks(make_docs, monkeypatch):
    rnd = random.Random(9)
    word = lambda k: "".join(rnd.choice("abcdefghij") for _ in range(k))
    passage = word(30)
    rows = [(i, word(25) + passage[: rnd.randrange(16, 31)] + word(25)) for i in range(60)]
    expect = brute(rows, 16)
    monkeypatch.setattr(S, "block_count", lambda docs, text: 7)
    for hot in (1, 4, 4096):
        assert digest(S.remove_repeated_bytes(make_docs(rows), 16, hot=hot)) == expect
    rows = corpus(11, 12, "abcdefghij")
    assert digest(S.remove_repeated_bytes(make_docs(rows), 12, hot=1)) == brute(rows, 12)


def test_empty_table(make_docs):
    assert S.repeated_bytes_digest(make_docs([])).collect() == []


def test_strings_dealt_one_by_one():
    rnd = random.Random(3)
    data = np.frombuffer(("".join(rnd.choice("ab") for _ in range(300))).encode(), np.uint8)
    p = np.array([40, 120])
    rows = S._deal(0, data, p, p - 10, p + 30, np.zeros(2, bool), 16, 1)
    (_, _, raw), = rows
    kind, h1, h2, at, want = S.unpack(raw)
    assert kind[0] == 1 and len(h1) == 2 * (40 - 16 + 1) and want.all()
    by = {}
    for x, y, a in zip(h1, h2, at):
        own = p[0] if a < 100 else p[1]
        by.setdefault((x, y), set()).add((bytes(data[a : a + 16]), own - a))
    assert all(len(v) == 1 for v in by.values())


def test_suffix_array_is_sorted():
    rnd = random.Random(5)
    texts = ["a", "aaaaaaa", "abababab", "mississippi", "banana\0banana\0"]
    texts += ["".join(rnd.choice("abc") for _ in range(200)) for _ in range(10)]
    for t in texts:
        b = t.encode()
        got = S.suffix_array(np.frombuffer(b, np.uint8), len(b))
        assert got.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
        kinds = S.type_b(np.frombuffer(b, np.uint8)).tolist()
        assert kinds == [b[i:] < b[i + 1 :] for i in range(len(b))]


def test_adjacent_prefixes():
    t = np.frombuffer(b"abcdefghijkabcdefghijxabcdefghijk", np.uint8)
    o = np.array([0, 22, 11])
    assert S.adjacent_equal(S._keys(t), o, 11).tolist() == [True, False]
    assert S.adjacent_equal(S._keys(t), o, 10).tolist() == [True, True]
