"""Small workbooks made inside tasks, to feed the workbook scan with table data."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from datetime import date
from functools import lru_cache
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame

_TYPES = (
    '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
    '<Default Extension="xml" ContentType="application/xml"/></Types>'
)
_MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_REL = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


@lru_cache(maxsize=20_000)
def column_name(index: int) -> str:
    name = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        name = chr(65 + rest) + name
    return name


def write_workbook(sheets: dict[str, dict[int, list]]) -> bytes:
    """Sheets of row number (from 0) -> cells: text, numbers, dates (styled), booleans, None for blanks."""
    shared: dict[str, int] = {}

    def cell(row: int, at: int, value) -> str:
        if value is None:
            return ""
        ref = f'r="{column_name(at)}{row + 1}"'
        if type(value) is str:
            return f'<c {ref} t="s"><v>{shared.setdefault(value, len(shared))}</v></c>'
        if isinstance(value, bool):
            return f'<c {ref} t="b"><v>{int(value)}</v></c>'
        if isinstance(value, date):
            return f'<c {ref} s="1"><v>{(value - date(1899, 12, 30)).days}</v></c>'
        if isinstance(value, (int, float)):
            return f"<c {ref}><v>{value!r}</v></c>"
        return f'<c {ref} t="s"><v>{shared.setdefault(str(value), len(shared))}</v></c>'

    parts = {"[Content_Types].xml": _TYPES}
    for n, rows in enumerate(sheets.values(), 1):
        body = "".join(
            f'<row r="{r + 1}">' + "".join(cell(r, i, v) for i, v in enumerate(values)) + "</row>" for r, values in sorted(rows.items())
        )
        parts[f"xl/worksheets/sheet{n}.xml"] = f"<worksheet {_MAIN}><sheetData>{body}</sheetData></worksheet>"
    listed = "".join(f'<sheet name="{escape(s)}" sheetId="{n}" r:id="rId{n}"/>' for n, s in enumerate(sheets, 1))
    parts["xl/workbook.xml"] = f"<workbook {_MAIN} {_REL}><sheets>{listed}</sheets></workbook>"
    links = "".join(f'<Relationship Id="rId{n}" Target="worksheets/sheet{n}.xml"/>' for n in range(1, len(sheets) + 1))
    parts["xl/_rels/workbook.xml.rels"] = f"<Relationships>{links}</Relationships>"
    texts = "".join(f"<si><t>{escape(t)}</t></si>" for t in shared)
    parts["xl/sharedStrings.xml"] = f"<sst {_MAIN}>{texts}</sst>"
    parts["xl/styles.xml"] = f'<styleSheet {_MAIN}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>'
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as book:
        for name, content in parts.items():
            book.writestr(name, content)
    return buffer.getvalue()


def write_files(df: DataFrame) -> DataFrame:
    """Write each row's ``content`` to its ``path`` in the shared folder, from the tasks; returns the paths."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                # A URI would read % and + as escapes; below its scheme the path is taken as it is.
                scheme, _, place = path.partition("://")
                store, place = (fs.FileSystem.from_uri(f"{scheme}:///")[0], place) if place else (fs.LocalFileSystem(), path)
                store.create_dir(place.rpartition("/")[0], recursive=True)
                with store.open_output_stream(place) as out:
                    out.write(content)
            yield batch[["path"]]

    return df.select("path", "content").mapInPandas(write, "path string")


def cells_to_workbooks(scanned: DataFrame, sheet: str, sheet_index: int) -> DataFrame:
    """``path, content``: one workbook per ``_file`` with its rows in order, behind ``sheet_index`` other sheets."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        body = {i: list(cells) for i, cells in enumerate(rows.sort_values("_row")["cells"])}
        others = {f"Notas {i}": {0: ["nada"]} for i in range(sheet_index)}
        return pd.DataFrame({"path": [rows["_file"].iloc[0]], "content": [write_workbook({**others, sheet: body})]})

    return scanned.groupBy("_file").applyInPandas(pack, "path string, content binary")


def pack_workbooks(df: DataFrame) -> DataFrame:
    """One workbook per ``path`` from columns o_orderkey, o_totalprice, day, prioridad (bounded groups)."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        body = {0: ["N° Operación", "Precio", "Fecha", "Prioridad"]}
        for i, r in enumerate(rows.itertuples(index=False), 1):
            body[i] = [int(r.o_orderkey), float(r.o_totalprice), date.fromisoformat(r.day), r.prioridad]
        content = write_workbook({"Notas": {0: ["nada"]}, "Base": body})
        return pd.DataFrame({"path": [rows["path"].iloc[0]], "content": [content]})

    return df.groupBy("path").applyInPandas(pack, "path string, content binary")
