"""SQL surface: the tables of the document model as temporary views."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .operators import integrity, lines, outline, split, structure


def register_views(docs: DataFrame, key: str = "doc_id", text: str = "text") -> list[str]:
    """Views lines, pages, chapters, sections, tables, body_files, outlines and page_map over documents."""
    base = lines.with_pages(lines.explode_lines(docs, key, text))
    shaped = structure.structure_lines(base.drop("page"), key=key)
    found = outline.outline(base, key)
    views = {
        "lines": base,
        "pages": lines.page_touches(base, key),
        "chapters": structure.chapters(shaped, key),
        "sections": structure.sections(shaped, key),
        "tables": split.table_spans(base, key),
        "body_files": split.split_chunks(shaped, [key, "chapter_id"]),
        "outlines": found,
        "page_map": found.select(key, "label", "page"),
        "repeated_texts": integrity.repeated_pages(docs, text),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
