"""Sources and sinks: files, the extraction store, the manifest and scripts."""
