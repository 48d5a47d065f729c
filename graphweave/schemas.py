"""Schemas of the tables that flow between operators (DDL strings)."""

PROPS = "map<string,variant>"

# Extractor response, one per chunk: entities carry a required name; properties
# default to an empty map.
ENTITY_RESPONSE = f"struct<type:string,name:string,properties:{PROPS}>"
REL_RESPONSE = f"struct<source:string,target:string,type:string,properties:{PROPS}>"
RESPONSE = f"struct<entities:array<{ENTITY_RESPONSE}>,relationships:array<{REL_RESPONSE}>>"

# Extraction record as kept by the per-document JSON store (one object per
# document version): entities are {type, properties} with the name inside.
STORED_ENTITY = f"struct<type:string,properties:{PROPS}>"
RECORD = (
    "document_name string, extraction_time string, total_chunks int, "
    f"entities array<{STORED_ENTITY}>, relationships array<{REL_RESPONSE}>, _corrupt_record string"
)

# Long tables (one row per entity / relationship occurrence).
ENTITY_ROWS = (
    "path string, document_name string, chunk_number int, pos int, "
    f"type string, name string, props {PROPS}, extraction_error string"
)
REL_ROWS = (
    "path string, document_name string, chunk_number int, pos int, "
    f"source string, target string, type string, props {PROPS}"
)

MANIFEST = (
    "path string, document_name string, content_md5 string, run_id string, status string, "
    "error string, n_chunks int, finished_at timestamp"
)

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"
