"""Completion rules P6-P12 as a table: response of one chunk -> expected rows.

Chunk number 4 of document ``d`` throughout; ``C`` is its chunk name. Entities are written
``Type:name``, relationships ``source>TYPE>target``, in output order."""

import json

import pytest
from pyspark.sql import functions as F

from graphweave.operators import extract, shape

C = "d_chunk_4"
LINK = f"{C}>BELONGS_TO>d"


def ent(spec, **props):
    kind, name = spec.split(":", 1)
    return {"type": kind, "name": name, **({"properties": props} if props else {})}


def rel(spec):
    s, t, o = spec.split(">")
    return {"source": s, "type": t, "target": o}


CASES = {
    # rule: (entities, relationships, expected entities, expected relationships)
    "P12 failed chunk": (None, None, [f"Chunk:{C}", "Document:d"], [LINK]),
    "P8 P9 P10 all added": ([], [], ["Document:d", f"Chunk:{C}"], [LINK]),
    "P11 a mention per entity": (
        [ent("Person:Ann"), ent("Concept:Bob")], [],
        ["Person:Ann", "Concept:Bob", "Document:d", f"Chunk:{C}"], [LINK, f"{C}>MENTIONS>Ann", f"{C}>MENTIONS>Bob"],
    ),
    "P11 same name twice": (
        [ent("Person:Ann"), ent("Concept:Ann")], [],
        ["Person:Ann", "Concept:Ann", "Document:d", f"Chunk:{C}"], [LINK, f"{C}>MENTIONS>Ann", f"{C}>MENTIONS>Ann"],
    ),
    "P11 empty name": ([ent("Person:")], [], ["Person:", "Document:d", f"Chunk:{C}"], [LINK, f"{C}>MENTIONS>"]),
    "P6 a name property goes before the name": (
        [ent("Person:Ann", name="Eve")], [], ["Person:Eve", "Document:d", f"Chunk:{C}"], [LINK, f"{C}>MENTIONS>Eve"],
    ),
    "P6 an empty name property too": (
        [ent("Person:Ann", name="")], [], ["Person:", "Document:d", f"Chunk:{C}"], [LINK, f"{C}>MENTIONS>"],
    ),
    "P7 unknown document is renamed": ([ent("Document:unknown")], [], ["Document:d", f"Chunk:{C}"], [LINK]),
    "P7 empty document is renamed": ([ent("Document:")], [], ["Document:d", f"Chunk:{C}"], [LINK]),
    "P7 other documents keep their name": ([ent("Document:report")], [], ["Document:report", f"Chunk:{C}"], [LINK]),
    "P7 by name property": ([ent("Document:report", name="unknown")], [], ["Document:d", f"Chunk:{C}"], [LINK]),
    "P8 a returned document is not added again": (
        [ent("Document:a"), ent("Document:b")], [], ["Document:a", "Document:b", f"Chunk:{C}"], [LINK],
    ),
    "P9 the chunk itself is not added again": ([ent(f"Chunk:{C}")], [], [f"Chunk:{C}", "Document:d"], [LINK]),
    "P9 another chunk does not count": (
        [ent("Chunk:d_chunk_5")], [], ["Chunk:d_chunk_5", "Document:d", f"Chunk:{C}"], [LINK],
    ),
    "P9 the entity's own name decides, not its property": (
        [ent(f"Chunk:{C}", name="other")], [], ["Chunk:other", "Document:d"], [LINK],
    ),
    "P10 a returned link is not added again": ([], [rel(LINK)], ["Document:d", f"Chunk:{C}"], [LINK]),
    "P10 CONTAINS from the document is a link": (
        [], [rel(f"d>CONTAINS>{C}")], ["Document:d", f"Chunk:{C}"], [f"d>CONTAINS>{C}"],
    ),
    "P10 BELONGS_TO the wrong way is none": (
        [], [rel(f"d>BELONGS_TO>{C}")], ["Document:d", f"Chunk:{C}"], [f"d>BELONGS_TO>{C}", LINK],
    ),
    "P10 CONTAINS the wrong way is none": (
        [], [rel(f"{C}>CONTAINS>d")], ["Document:d", f"Chunk:{C}"], [f"{C}>CONTAINS>d", LINK],
    ),
    "P10 another document is none": (
        [], [rel(f"{C}>BELONGS_TO>e")], ["Document:d", f"Chunk:{C}"], [f"{C}>BELONGS_TO>e", LINK],
    ),
    "order: given, link, mentions": (
        [ent("Person:Ann")], [rel("Ann>KNOWS>Bob")],
        ["Person:Ann", "Document:d", f"Chunk:{C}"], ["Ann>KNOWS>Bob", LINK, f"{C}>MENTIONS>Ann"],
    ),
}


@pytest.fixture(scope="module")
def completed(spark):
    rows = []
    for k, (ents, rels, _, _) in enumerate(CASES.values()):
        text = None if ents is None else json.dumps({"entities": ents, "relationships": rels})
        rows.append((f"case{k}", "d", 4, "t", text))
    df = spark.createDataFrame(rows, "path string, document_name string, chunk_number int, text string, response string")
    df = df.withColumn("error", F.when(F.col("response").isNull(), F.lit("failed")))
    e, r = shape.complete(extract.parse_results(df, "response"))
    return e.collect(), r.collect()


@pytest.mark.parametrize("k,name", list(enumerate(CASES)))
def test_completion(completed, k, name):
    ents, rels = completed
    mine = sorted((x for x in ents if x.path == f"case{k}"), key=lambda x: x.pos)
    assert [f"{x.type}:{x.name}" for x in mine] == CASES[name][2]
    links = sorted((x for x in rels if x.path == f"case{k}"), key=lambda x: x.pos)
    assert [f"{x.source}>{x.type}>{x.target}" for x in links] == CASES[name][3]
    assert [x.pos for x in mine] == list(range(len(mine))) and [x.pos for x in links] == list(range(len(links)))
