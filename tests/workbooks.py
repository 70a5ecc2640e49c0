"""Minimal .xlsx writer for tests (inline and shared strings, numbers)."""

import zipfile
from xml.sax.saxutils import escape

_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_R = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def _letter(i):
    return chr(65 + i)


def write(path, sheets):
    """``sheets``: name -> list of rows; a row is a list of cells (None leaves a gap)."""
    shared, order = {}, []

    def cell(ref, v):
        if isinstance(v, (int, float)):
            return f'<c r="{ref}"><v>{v}</v></c>'
        if v.startswith("="):  # marks an inline string
            return f'<c r="{ref}" t="inlineStr"><is><t>{escape(v[1:])}</t></is></c>'
        if v not in shared:
            shared[v] = len(order)
            order.append(v)
        return f'<c r="{ref}" t="s"><v>{shared[v]}</v></c>'

    parts = {}
    for n, rows in enumerate(sheets.values(), start=1):
        body = "".join(
            f'<row r="{r}">' + "".join(cell(f"{_letter(c)}{r}", v) for c, v in enumerate(row) if v is not None) + "</row>"
            for r, row in enumerate(rows, start=1) if row
        )
        parts[f"xl/worksheets/sheet{n}.xml"] = f"<worksheet {_NS}><sheetData>{body}</sheetData></worksheet>"
    parts["xl/sharedStrings.xml"] = f"<sst {_NS}>" + "".join(f"<si><t>{escape(s)}</t></si>" for s in order) + "</sst>"
    parts["xl/workbook.xml"] = f"<workbook {_NS} {_R}><sheets>" + "".join(
        f'<sheet name="{escape(name)}" sheetId="{n}" r:id="rId{n}"/>' for n, name in enumerate(sheets, start=1)
    ) + "</sheets></workbook>"
    parts["xl/_rels/workbook.xml.rels"] = (
        '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(
            f'<Relationship Id="rId{n}" Type="x" Target="worksheets/sheet{n}.xml"/>' for n in range(1, len(sheets) + 1)
        ) + "</Relationships>"
    )
    with zipfile.ZipFile(path, "w") as z:
        for name, xml in parts.items():
            z.writestr(name, '<?xml version="1.0" encoding="UTF-8"?>' + xml)
