"""DataFrame operators of the document-to-graph build."""
