"""Readers of spreadsheets and vector tiles by the standard library: functions from bytes to text."""

from __future__ import annotations

import datetime
import io
import re
import struct
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Numbers of built-in formats that show dates or times (fixed values of the file format).
_DATE_FORMATS = {*range(14, 23), *range(45, 48)}


def row_line(header: list[str], cells: list) -> str:
    """`column: value` of the cells under the header that aren't blank, joined by ` | `."""
    return " | ".join(f"{name}: {cell}" for name, cell in zip(header, cells) if cell is not None and str(cell).strip())


def _strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for x in si if x.tag != _MAIN + "rPh" for t in x.iter(_MAIN + "t")) for si in root.iter(_MAIN + "si")]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show dates."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    bare = lambda code: re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code).lower()
    own = {int(f.get("numFmtId")) for f in root.iter(_MAIN + "numFmt") if re.search("[ymdhs]", bare(f.get("formatCode", "")))}
    styles = root.find(_MAIN + "cellXfs")
    return {k for k, x in enumerate(styles if styles is not None else []) if int(x.get("numFmtId", 0)) in _DATE_FORMATS | own}


def _cell(c, strings: list[str], dates: set[int]):
    kind, v = c.get("t", "n"), c.find(_MAIN + "v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in c.iter(_MAIN + "t"))
    if v is None or v.text is None:
        return None
    if kind == "s":
        return strings[int(v.text)]
    if kind == "b":
        return v.text == "1"
    if kind != "n":
        return v.text
    x = float(v.text)
    if int(c.get("s", 0)) in dates:
        at = datetime.datetime(1899, 12, 30) + datetime.timedelta(days=x)
        return at if x >= 1 else at.time()
    return int(x) if x.is_integer() and not re.search("[.eE]", v.text) else x


def _column(name: str) -> int:
    n = 0
    for c in re.match("[A-Z]*", name)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheets(content: bytes) -> Iterator[tuple[str, list[list]]]:
    """Name and rows of every sheet of a workbook, in order; rows begin with the first of the sheet."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings, dates = _strings(book), _date_styles(book)
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(_MAIN + "sheet"):
            target = links[sheet.get(_LINK)]
            rows: list[list] = []
            for row in ElementTree.fromstring(book.read(target[1:] if target.startswith("/") else "xl/" + target)).iter(_MAIN + "row"):
                rows += [[] for _ in range(int(row.get("r", len(rows) + 1)) - 1 - len(rows))]
                cells: list = []
                for c in row.iter(_MAIN + "c"):
                    at = _column(c.get("r", "")) if c.get("r") else len(cells)
                    cells += [None] * (at - len(cells)) + [_cell(c, strings, dates)]
                rows.append(cells)
            yield sheet.get("name"), rows


def xlsx_text(content: bytes) -> str:
    """Every sheet: a block with its name, then one for each row under the header, which is the first row."""
    blocks = []
    for name, rows in sheets(content):
        if rows:
            header = ["" if c is None else str(c) for c in rows[0]]
            blocks += [f"Hoja: {name}", *[b for b in (row_line(header, r) for r in rows[1:]) if b]]
    return "\n\n".join(blocks)


def _fields(data: bytes) -> Iterator[tuple[int, int, object]]:
    """(field, wire type, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, kind, varint()
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            yield key >> 3, kind, data[at : at + size]
            at += size
        elif kind == 2:
            size = varint()
            if at + size > len(data):
                raise ValueError("message ends inside a field")
            yield key >> 3, kind, data[at : at + size]
            at += size
        else:
            raise ValueError(f"unknown wire type {kind}")


def _numbers(data: bytes) -> list[int]:
    out, n, shift = [], 0, 0
    for b in data:
        n |= (b & 127) << shift
        shift += 7
        if b < 128:
            out.append(n)
            n = shift = 0
    return out


def _value(data: bytes):
    for field, _, v in _fields(data):
        if field == 1:
            return v.decode()
        if field in (2, 3):
            return struct.unpack("<f" if field == 2 else "<d", v)[0]
        if field == 4:
            return v - (1 << 64) if v >= 1 << 63 else v
        if field == 5:
            return v
        if field == 6:
            return (v >> 1) ^ -(v & 1)
        if field == 7:
            return bool(v)
    return None


def tile_text(content: bytes) -> str:
    """A line `layer | key: value | ...` for each feature of a vector tile; blank values and repeated lines are left out."""
    lines: dict[str, None] = {}
    for field, _, layer in _fields(content):
        if field != 3:
            continue
        parts = list(_fields(layer))
        name = next(v.decode() for f, _, v in parts if f == 1)
        keys = [v.decode() for f, _, v in parts if f == 3]
        values = [_value(v) for f, _, v in parts if f == 4]
        for f, _, feature in parts:
            if f == 2:
                tags = [n for g, kind, v in _fields(feature) if g == 2 for n in (_numbers(v) if kind == 2 else [v])]
                pairs = [(keys[k], values[v]) for k, v in zip(tags[::2], tags[1::2])]
                told = [f"{k}: {v}" for k, v in dict(pairs).items() if v is not None and str(v).strip() and str(v).lower() != "null"]
                if told:
                    lines[" | ".join([name, *told])] = None
    return "\n".join(lines)
