"""DataFrame operators over documents, lines, sections, tables and index entries."""
