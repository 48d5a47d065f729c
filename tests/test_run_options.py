"""Options of the batch run: request text, type restriction, embeddings and index statements."""

import os

from graphweave.operators import export
from graphweave.plans.build import run_batch


def files(folder):
    os.makedirs(folder)
    for name, text in [("one", "Alpha meets Beta."), ("two", "Gamma alone.")]:
        with open(os.path.join(folder, f"{name}.txt"), "w") as f:
            f.write(text)


def test_request_types_embeddings(spark, tmpdir_path):
    src, work = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "work")
    files(src)

    def factory():
        from json import dumps

        def call(batch):
            out = []
            for text, request in zip(batch["text"], batch["request"]):
                assert "Entity types: Person, Place" in request and request.endswith(text) and "Focus areas: ships" in request
                ents = [{"type": "Person" if w[0] in "AB" else "Thing", "name": w} for w in ("Alpha", "Beta", "Gamma") if w in text]
                rels = [{"source": "Alpha", "target": "Beta", "type": t} for t in ("KNOWS", "HATES")] if "Alpha" in text else []
                out.append(dumps({"entities": ents, "relationships": rels}))
            return out

        return call

    out = run_batch(
        spark, src, work, "r1", extractor_factory=factory, request={"focus_areas": ["ships"]},
        entity_types=["Person", "Place"], relationship_types=["KNOWS"], embed=True,
        embedding_fn=lambda texts: [[float(len(t)), 1.0] for t in texts], embedding_dims=2,
    )
    nodes = {(r.type, r.name) for r in out["nodes"].collect()}
    assert ("Person", "Alpha") in nodes and not any(t == "Thing" for t, _ in nodes)
    rels = [(r.source, r.type, r.target) for r in out["relationships"].collect()]
    assert ("Alpha", "KNOWS", "Beta") in rels and not any(t == "HATES" for _, t, _ in rels)
    assert not any(t == "MENTIONS" and o == "Gamma" for _, t, o in rels)
    script = export.latest_script(spark, os.path.join(work, "output")).first().script
    stmts = [r.statement for r in export.load_statements(spark, script, "rows").collect()]
    assert sum("CREATE VECTOR INDEX chunk_embeddings" in s and "`vector.dimensions`: 2" in s for s in stmts) == 1
    assert sum("embedding: [17, 1]" in s or "embedding: [17.0, 1.0]" in s for s in stmts) == 1
