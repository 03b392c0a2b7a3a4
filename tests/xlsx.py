"""Smallest workbook writer the reader tests need."""

import zipfile
from xml.sax.saxutils import escape

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def column(i):
    name = ""
    i += 1
    while i:
        i, rest = divmod(i - 1, 26)
        name = chr(65 + rest) + name
    return name


def cell(row, col, value, shared):
    at = f'r="{column(col)}{row + 1}"'
    if isinstance(value, bool):
        return f'<c {at} t="b"><v>{int(value)}</v></c>'
    if isinstance(value, tuple):
        return f'<c {at} s="{value[1]}"><v>{value[0]}</v></c>'
    if isinstance(value, (int, float)):
        return f"<c {at}><v>{value}</v></c>"
    if value.startswith("="):
        return f'<c {at} t="str"><f>x</f><v>{escape(value[1:])}</v></c>'
    if value.startswith("'"):
        return f'<c {at} t="inlineStr"><is><t>{escape(value[1:])}</t></is></c>'
    if value not in shared:
        shared.append(value)
    return f'<c {at} t="s"><v>{shared.index(value)}</v></c>'


def write_workbook(path, sheets, broken=(), styles=None):
    """``sheets``: name -> rows of cells (None for no cell, a pair for a number and its style).

    ``styles``: number formats, by id or by code.
    """
    shared = []
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        entries, relations = [], []
        for n, (name, rows) in enumerate(sheets.items(), 1):
            entries.append(f'<sheet name="{escape(name)}" sheetId="{n}" r:id="rId{n}"/>')
            relations.append(f'<Relationship Id="rId{n}" Target="worksheets/sheet{n}.xml"/>')
            body = ""
            for r, row in enumerate(rows):
                cells = "".join(cell(r, c, v, shared) for c, v in enumerate(row) if v is not None)
                if cells:
                    body += f'<row r="{r + 1}">{cells}</row>'
            end = "" if name in broken else "</sheetData></worksheet>"
            book.writestr(f"xl/worksheets/sheet{n}.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{body}{end}')
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets>{"".join(entries)}</sheets></workbook>',
        )
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{PACKAGE}">{"".join(relations)}</Relationships>')
        items = "".join(f'<si><r><t xml:space="preserve">{escape(s)}</t></r></si>' for s in shared)
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{items}</sst>')
        if styles:
            codes = [f if isinstance(f, str) else None for f in styles]
            own = "".join(f'<numFmt numFmtId="{164 + i}" formatCode="{escape(c, {chr(34): "&quot;"})}"/>' for i, c in enumerate(codes) if c)
            used = "".join(f'<xf numFmtId="{164 + i if isinstance(f, str) else f}"/>' for i, f in enumerate(styles))
            book.writestr("xl/styles.xml", f'<styleSheet xmlns="{MAIN}"><numFmts>{own}</numFmts><cellXfs>{used}</cellXfs></styleSheet>')
