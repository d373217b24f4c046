"""Landing files, rule files and table sinks."""
