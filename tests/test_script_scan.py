"""Lossless scan of script files against a character-by-character reading."""

import random
import re

import pytest

from graphweave.operators import export, script_scan


def slow(text):
    """Statements of one file, read one character at a time."""
    out, state, i, cur = [], ".", 0, ""
    while i < len(text):
        two, ch = text[i:i + 2], text[i]
        step = 1
        if state == ".":
            if ch == ";":
                out.append(cur)
                cur, i = "", i + 1
                continue
            if two in ("//", "/*"):
                state, step = {"//": "line", "/*": "block"}[two], 2
            elif ch in "'\"`":
                state = ch
        elif state in "'\"" and ch == "\\":
            step = 2
        elif state == ch:
            state = "."
        elif state == "line" and ch == "\n":
            state = "."
        elif state == "block" and two == "*/":
            state, step = ".", 2
        cur += text[i:i + step]
        i += step
    return out + [cur.removesuffix(";")]  # the file's last separator


def kept(spark, texts):
    found = []
    for t in texts:
        for s in slow(t):
            s = re.sub(script_scan._LEADING_COMMENTS.replace("++", "+"), "", s).strip()
            if re.match(export.STATEMENT_RE, s):
                found.append(s)
    return sorted(found)


@pytest.mark.parametrize("tile,block", [(1, 64), (3, 1 << 20), (1024, 200)])
def test_any_script(spark, tmpdir_path, tile, block):
    rnd = random.Random(tile)
    bits = ["'", '"', "`", "\\", ";", ";", "//", "/*", "*/", "\n", "/", "MERGE (a)", " x ", "é", "MATCH 'a;b'"]
    texts = ["", "MERGE (a)", "MERGE (a {t: 'x;y\\';z'});\n\n// don't; stop\nMATCH (b) /* ; ' */;CREATE `a;b`;"]
    texts += ["".join(rnd.choice(bits) for _ in range(rnd.randrange(120))) for _ in range(12)]
    for i, t in enumerate(texts):
        with open(f"{tmpdir_path}/part-{i}.txt", "w", newline="") as f:
            f.write(t)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        got = script_scan.statements(spark, tmpdir_path, tile=tile).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = sorted(s for s in (r.statement.strip() for r in got) if re.match(export.STATEMENT_RE, s))
    assert got == kept(spark, texts)


def test_long_quoted_text(spark, tmpdir_path):
    body = "a;'".replace("'", "\\'") * 50_000
    st = "MERGE (n:Doc {text: '" + body + "'})"
    with open(f"{tmpdir_path}/s.txt", "w") as f:
        f.write(st + ";\n\nMERGE (m);\n\n")
    got = sorted((r.statement for r in export.load_statements(spark, tmpdir_path, "quoted").collect()), key=len)
    assert got == ["MERGE (m)", st]
