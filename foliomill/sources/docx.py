"""Word documents to rows: one for each paragraph or table, in their order.

A .docx file is a zip of XML, so parsing one file is a small helper; listing,
spreading and everything after are Spark's.  Old .doc files need a program that
isn't there: their rows say so.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
BLOCKS = "path string, status string, error string, block_pos int, kind string, style string, runs array<struct<text:string,bold:boolean>>, grid array<array<struct<cell_id:int,text:string>>>"


def _runs(p: ElementTree.Element) -> list[dict]:
    out = []
    for r in p.iter(f"{W}r"):
        bold = r.find(f"{W}rPr/{W}b")
        text = "".join(t.text or "" for t in r.iter(f"{W}t"))
        out.append({"text": text, "bold": bold is not None and bold.get(f"{W}val") not in ("0", "false")})
    return out


def _style(p: ElementTree.Element, names: dict[str, str]) -> str | None:
    found = p.find(f"{W}pPr/{W}pStyle")
    return names.get(found.get(f"{W}val"), found.get(f"{W}val")) if found is not None else None


def _grid(table: ElementTree.Element) -> list[list[dict]]:
    """Cells by row and grid column; a merged cell has one number in all its places."""
    grid, number, above = [], 0, {}
    for row in table.findall(f"{W}tr"):
        cells, column = [], 0
        for cell in row.findall(f"{W}tc"):
            span = cell.find(f"{W}tcPr/{W}gridSpan")
            merge = cell.find(f"{W}tcPr/{W}vMerge")
            text = "\n".join("".join(t.text or "" for t in p.iter(f"{W}t")) for p in cell.iter(f"{W}p"))
            if merge is not None and merge.get(f"{W}val") != "restart" and column in above:
                one = above[column]
            else:
                one = {"cell_id": number, "text": text}
                number += 1
            for _ in range(int(span.get(f"{W}val")) if span is not None else 1):
                cells.append(one)
                above[column] = one
                column += 1
        grid.append(cells)
    return grid


def parse_docx(content: bytes) -> list[dict]:
    """Blocks of one file."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = {}
        if "word/styles.xml" in z.namelist():
            for s in ElementTree.fromstring(z.read("word/styles.xml")).iter(f"{W}style"):
                name = s.find(f"{W}name")
                names[s.get(f"{W}styleId")] = name.get(f"{W}val") if name is not None else s.get(f"{W}styleId")
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{W}body")
    out = []
    for e in body if body is not None else ():
        if e.tag == f"{W}p":
            out.append({"kind": "paragraph", "style": _style(e, names), "runs": _runs(e), "grid": None})
        elif e.tag == f"{W}tbl":
            out.append({"kind": "table", "style": None, "runs": None, "grid": _grid(e)})
    return [{"block_pos": i} | b for i, b in enumerate(out)]


def blocks_of(path: str, content: bytes | None) -> list[dict]:
    """Rows of one file by column; one with its error, if it can't be read.  An old .doc needs no content."""
    try:
        if path.lower().endswith(".doc"):
            raise ValueError("no converter for .doc")
        return [{"path": path, "status": "ok", "error": None} | b for b in parse_docx(content)]
    except (ValueError, KeyError, zipfile.BadZipFile, ElementTree.ParseError) as e:
        return [{"path": path, "status": "failed", "error": str(e), "block_pos": None, "kind": None, "style": None, "runs": None, "grid": None}]


def docx_blocks(files: DataFrame) -> DataFrame:
    """Blocks of binary files (path, content); a file that can't be read gives one row with its error."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [b for path, content in zip(batch["path"], batch["content"], strict=True) for b in blocks_of(path, content)]
            columns = [c.split()[0] for c in BLOCKS.split(", ")]
            frame = pd.DataFrame(rows, columns=columns)
            frame["block_pos"] = frame["block_pos"].astype("Int32")
            yield frame

    return files.select("path", "content").mapInPandas(parse, BLOCKS)


def docx_markdown(blocks: DataFrame) -> DataFrame:
    """path, text, n_paragraphs and n_tables of the files that were read."""
    at = lambda r, i: (i == 0) | (F.get(r, i - 1)["cell_id"] != F.get(r, i)["cell_id"])

    def shown(r, k):
        """Cells of a row that begin here: neither a place of the cell to the left nor one of the row above."""
        above = F.get(F.col("grid"), k - 1)
        fresh = F.transform(r, lambda x, i: F.struct(x.alias("x"), (at(r, i) & ((k == 0) | ~F.coalesce(F.exists(above, lambda y: y["cell_id"] == x["cell_id"]), F.lit(False)))).alias("f")))
        return F.transform(F.filter(fresh, lambda y: y["f"]), lambda y: y["x"])

    kept = F.transform("grid", shown)
    columns = lambda x: F.array_max(F.transform(F.col("grid"), lambda r: F.size(F.filter(r, lambda y: y["cell_id"] == x["cell_id"]))))
    rows = lambda x: F.size(F.filter(F.col("grid"), lambda r: F.exists(r, lambda y: y["cell_id"] == x["cell_id"])))
    texts = F.transform(kept, lambda r: F.transform(r, lambda x: x["text"]))
    spans = F.transform(kept, lambda r: F.transform(r, lambda x: F.struct(rows(x).alias("rs"), columns(x).alias("cs"))))
    part = F.when(F.col("kind") == "table", T.html_table(texts, spans)).otherwise(T.docx_paragraph(F.coalesce("style", F.lit("")), F.col("runs")))
    parts = blocks.where("status = 'ok'").select("path", "kind", F.struct("block_pos", part.alias("part")).alias("p"))
    joined = parts.groupBy("path").agg(F.array_sort(F.collect_list("p")).alias("p"), F.count_if(F.col("kind") == "paragraph").alias("n_paragraphs"), F.count_if(F.col("kind") == "table").alias("n_tables"))
    text = F.array_join(F.filter(F.transform("p", lambda x: x["part"]), lambda x: x != ""), "\n\n")
    return joined.select("path", F.concat(T.compress_blank_lines(text), F.lit("\n")).alias("text"), "n_paragraphs", "n_tables")
