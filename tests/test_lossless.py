"""Values, statements and texts come through whole; faults are told apart and reported whole."""

import datetime as dt
import io
import json
import os
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from rows import rel_rows
from graphweave.functions.literals import literal
from graphweave.operators import chunking, edges, export, extract, graph, vectors
from graphweave.plans.build import rebuild_from_store
from graphweave.sources import manifest, store
from graphweave.sources.files import docx_text, html_text


def literals(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "j string").select("j", literal(F.parse_json("j")).alias("l"))
    return dict(df.collect())


def test_nested_lists_to_any_depth(spark):
    deep = "[" * 9 + '1,"x"' + "]" * 9
    got = literals(spark, ['[[[[1,"x"]]]]', deep, '[{"a":[1,"b{"]},[2,null,true]]', "[[],[[]]]", '[["it\'s, [a]"]]'])
    assert got['[[[[1,"x"]]]]'] == "[[[[1, 'x']]]]"
    assert got[deep] == "[" * 9 + "1, 'x'" + "]" * 9
    assert got['[{"a":[1,"b{"]},[2,null,true]]'] == "['{\\\"a\\\":[1,\\\"b{\\\"]}', [2, null, true]]"
    assert got["[[],[[]]]"] == "[[], [[]]]" and got['[["it\'s, [a]"]]'] == "[['it\\'s, [a]']]"


def test_long_nested_lists_render_in_linear_time(spark):
    """Two sizes of one shape, a factor of eight apart; text copied per token would cost 64 times as much."""
    def value(n):
        return json.dumps([[i, {"k": [i, "a]b"]}, "it's"] for i in range(n)], separators=(",", ":"))

    def expected(n):
        return "[" + ", ".join("[%d, '{\\\"k\\\":[%d,\\\"a]b\\\"]}', 'it\\'s']" % (i, i) for i in range(n)) + "]"

    seconds = []
    for n in (12_500, 100_000):
        start = time.perf_counter()
        assert literals(spark, [value(n)])[value(n)] == expected(n)
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < 30 * max(seconds[0], 0.5)


def test_long_strings_inside_lists(spark):
    text = "a\"b\\\\" * 20_000  # one JSON string of many escapes is one token
    got = literals(spark, [json.dumps([[text]])])
    (shown,) = got.values()
    assert shown == "[['" + text.replace("\\", "\\\\").replace('"', '\\"') + "']]"


def test_doubles_print_as_the_rules_say(spark):
    values = [12345678.5, 0.0005, 1e10, 1.5e16, 1e-5, 123456789012345.6, -2.5e-7, 9.5e15, 1e16, 1e-4, 1e18, 3.25e-6, -1e22, 0.1]
    values += [float(f"1.1e{k}") for k in range(-8, 19)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", literal(F.col("v").cast("variant")).alias("l"))
    for v, text in df.collect():
        assert text == repr(v), (v, text)


def test_long_strings_are_whole_unless_a_cut_is_asked_for(spark):
    df = spark.createDataFrame([("a" * 40_000,)], "t string").select(F.create_map(F.lit("t"), F.col("t").cast("variant")).alias("props"))
    whole, cut = df.select(F.length(export.render_body("props")), F.length(export.render_body("props", 32000))).first()
    assert whole == 40_000 + 5 and cut == 32_003 + 5


def test_script_rows_keep_any_text(spark, tmpdir_path):
    odd = ["a;\n\nb", "';\n\nMATCH (x)", "\r\n;\n\n", "plain"]
    stmts = spark.createDataFrame([(f"MERGE (n:T {{name: '{t}'}})",) for t in odd], "statement string")
    root = export.write_script(stmts, stmts.limit(0), stmts.limit(0), tmpdir_path, dt.datetime(2024, 1, 1))
    got = sorted(r.statement for r in export.load_statements(spark, root, "rows").collect())
    assert got == sorted(r.statement for r in stmts.collect())
    assert export.latest_script(spark, tmpdir_path).first().script.endswith("knowledge_graph_20240101_000000")


def test_failed_statements_are_reported_whole(spark):
    long = "MERGE (n:T {name: '" + "x" * 5000 + "'})"

    def factory():
        def write(q):
            raise RuntimeError("no " + q)

        return write

    r = export.apply_statements(spark.createDataFrame([(long,)], "statement string"), factory).first()
    assert r.statement == long and not r.ok and long in r.error and r.statement_prefix == long[:100]


def test_words_of_any_script_stay_whole(spark):
    text = "Straße Français McDonald Übersicht Décision JavaScript iPhone LOUD Abc Ann-Marie xStraße Ärger"
    got = spark.createDataFrame([(text,)], "text string").select(extract.rule_hits(F.col("text"))["__concepts"].alias("c")).first().c
    assert got == ["Straße", "Français", "McDonald", "Übersicht", "Décision", "JavaScript", "Marie", "Ärger"]


def test_properties_must_be_a_map(spark):
    rows = [
        {"entities": [{"type": "A", "name": "x", "properties": [1]}], "relationships": []},
        {"entities": [{"type": "A", "name": "x", "properties": {"k": 1}}], "relationships": []},
        {"entities": [{"type": "A", "name": "x", "properties": None}], "relationships": []},
        {"entities": [], "relationships": [{"source": "a", "target": "b", "type": "T", "properties": "s"}]},
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "i int, response string")
    got = {r.i: r.error for r in extract.parse_results(df).collect()}
    assert got == {0: "invalid response", 1: None, 2: None, 3: "invalid response"}


def test_extractor_with_wrong_length_and_factory(spark):
    chunks = spark.createDataFrame([(i, t) for i, t in enumerate(["a", "b", "boom"])], "i int, text string").coalesce(1)
    empty = json.dumps({"entities": [], "relationships": []})

    def short(batch):
        if "boom" in list(batch["text"]) and len(batch) == 1:
            raise ValueError("e" * 3000)
        return [empty] * (1 if len(batch) == 1 else len(batch) - 1)

    got = {r.i: r.error for r in extract.call_extractor(chunks, short).collect()}
    assert got[0] is None and got[1] is None and "e" * 3000 in got[2]

    def factory():
        seen = []

        def call(batch):
            seen.append(1)
            return [json.dumps({"entities": [{"type": "N", "name": str(len(seen))}], "relationships": []})] * len(batch)

        return call

    res = extract.extract(chunks, factory=factory, partitions=0).collect()
    assert {r.result.entities[0]["name"] for r in res} == {"1"}


def test_one_failing_embedding_fails_alone(spark):
    def embed(texts):
        if any(t == "bad" for t in texts):
            raise ValueError("bad")
        return [[float(len(t))] for t in texts]

    df = spark.createDataFrame([("a",), ("bad",), ("ccc",)], "text string").coalesce(1)
    got = {r.text: r.embedding for r in vectors.embed(df, "text", embed).collect()}
    assert got == {"a": [1.0], "bad": None, "ccc": [3.0]}


def test_only_a_missing_path_means_nothing_there(spark, tmpdir_path):
    assert store.read_if_exists(spark, f"{tmpdir_path}/none") is None
    assert manifest.read(spark, f"{tmpdir_path}/none").count() == 0
    bad = os.path.join(tmpdir_path, "bad")
    os.makedirs(bad)
    with open(os.path.join(bad, "part-0.parquet"), "wb") as f:
        f.write(b"PAR1 this is not parquet")
    with pytest.raises(Exception):
        store.read_if_exists(spark, bad).count()


def test_rebuild_takes_the_latest_version(spark, tmpdir_path):
    def record(name, when, ent):
        with open(os.path.join(tmpdir_path, name), "w") as f:
            json.dump({"document_name": "d", "extraction_time": when, "total_chunks": 1, "relationships": [],
                       "entities": [{"type": "Person", "properties": {"name": ent}}]}, f)

    record("a.json", "2024-01-01", "Old")
    record("b.json", "2024-02-01", "New")
    with open(os.path.join(tmpdir_path, "c.json"), "w") as f:
        json.dump({"entities": [{"type": "Person", "properties": {"name": "Loose"}}], "relationships": []}, f)
    names = lambda latest: {r.name for r in rebuild_from_store(spark, tmpdir_path, latest)[0].collect()}
    assert names(False) == {"Old", "New", "Loose"} and names(True) == {"New", "Loose"}
    same = spark.createDataFrame([("d", "1", "t"), ("d", "2", "t")], "document_name string, content_md5 string, extraction_time string")
    assert [r.content_md5 for r in store.latest_only(same).collect()] == ["2"]


def test_html_header_is_not_the_head(spark):
    pages = ["<header>Head</header><p>KEEP ME</p><script>x()</script>tail", "<head><title>t</title></head><b>x</b>",
             "<SCRIPT src='a'>1</script ><style>p</style>ok"]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in pages], "h string").select(html_text("h")).collect()]
    assert got == ["Head KEEP ME tail", "x", "ok"]


def test_docx_takes_body_paragraphs_only():
    ns = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    xml = f"""<w:document xmlns:w="{ns}"><w:body>
      <w:p><w:pPr><w:tabs><w:tab w:val="left"/></w:tabs></w:pPr><w:r><w:t>One</w:t><w:tab/><w:t>two</w:t></w:r></w:p>
      <w:tbl><w:tr><w:tc><w:p><w:r><w:t>Cell</w:t></w:r></w:p></w:tc></w:tr></w:tbl>
      <w:p><w:r><w:t>Outer</w:t><w:pict><w:txbxContent><w:p><w:r><w:t>Box</w:t></w:r></w:p></w:txbxContent></w:pict></w:r>
      <w:hyperlink><w:r><w:t>link</w:t></w:r></w:hyperlink></w:p></w:body></w:document>"""
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("word/document.xml", xml)
    assert docx_text(raw.getvalue()) == "One\ttwo\nOuterlink\n"


def test_edge_ids_keep_fields_apart(spark):
    rows = [("a|KNOWS", "b", "X"), ("a", "b", "KNOWS|X")]
    df = spark.createDataFrame(rows, "src_key string, dst_key string, type string").withColumn("props", F.expr("cast(map() as map<string,variant>)"))
    assert graph.edge_id(df).select("eid").distinct().count() == 2


def test_entity_name_comes_from_the_node(spark):
    nodes = spark.createDataFrame(
        [("Person_ann", "Person", "Ann"), ("Chunk_c", "Chunk", "c"), ("Document_d", "Document", "d")],
        "entity_key string, type string, name string",
    )
    rels = rel_rows(spark, [("f", "d", 0, 0, "c", "ANN", "MENTIONS"), ("f", "d", 0, 1, "c", " ann ", "MENTIONS"), ("f", "d", 0, 2, "c", "d", "BELONGS_TO")])
    got = graph.document_mentions(edges.resolve(nodes, rels, "normalized")).collect()
    assert [(r.entity_name, r.document_name) for r in got] == [("Ann", "d")]


@pytest.mark.parametrize("size,overlap", [(1500, 499), (7, 5), (5, 0), (10, 9), (4, 1)])
def test_chunks_of_any_size_and_overlap(spark, size, overlap):
    texts = ["", "x", "é" * 3, "".join(chr(97 + i % 26) for i in range(4001)), "🙂ab" * 10]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "document_name string, text string")
    step = size - overlap
    want = sorted(
        (str(i), k, t[k * step : k * step + size])
        for i, t in enumerate(texts) if t
        for k in range(max(1, -(-(len(t) - overlap) // step)))
    )
    got = sorted((r.document_name, r.chunk_number, r.text) for r in chunking.chunk(df, size, overlap).collect())
    assert got == want
