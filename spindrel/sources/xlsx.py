"""Workbook files (OOXML) as a Spark data source, `workbook`: read with a partition per sheet,
written by all tasks at once.

A reader lists the sheets; each is then a partition that opens the file itself, seeks to its own
part and reads the shared strings and styles once. A writer takes rows ordered by sheet and
row: every task deflates what it has of a sheet as a piece that ends on a flush, beside the
target; the commit joins the pieces of each sheet, whose checksums add up, into one zip
file without inflating them or seeing a row. Pieces of failed attempts are never named in a commit.

Files lie where pyarrow finds them: a local path, or an address with a scheme it knows.
"""

from __future__ import annotations

import json
import posixpath
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree
from xml.sax.saxutils import quoteattr

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: kind is cell (row, col), merge or link (row..row1, col..col1), column (col..col1, its width as
#: value) or run (of the rich text of a cell: row1 is its number, formula `bold` or `strike`,
#: fill its colour); formula of a cell has no leading "=".
PARTS = "sheet_index int, sheet string, kind string, row int, col int, row1 int, col1 int, formula string, value string, link string, fill string"
_NAMES = [c.split()[0] for c in PARTS.split(", ")]
_ARROW = pa.schema([(n, pa.int32() if c.endswith(" int") else pa.string()) for n, c in zip(_NAMES, PARTS.split(", "), strict=True)])
#: Parts that leave a task together, bytes of a sheet that are deflated at once, and bytes copied at once by a commit.
BATCH, CHUNK, COPY = 4096, 1 << 20, 8 << 20
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_OFFICE = "http://schemas.openxmlformats.org/package/2006"
_PLACE = re.compile(r"([A-Z]+)([0-9]+)")
#: Fonts of rich text: words that were deleted and added.
RUN = {"del": '<rPr><strike/><color rgb="FF9B2C24"/></rPr>', "add": '<rPr><b/><color rgb="FF1E7B34"/></rPr>', "keep": ""}


def column_number(letters: str) -> int:
    n = 0
    for c in letters:
        n = 26 * n + ord(c) - 64
    return n


def column_letters(n: int) -> str:
    out = ""
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


# ---- reading


def _span(ref: str) -> tuple[int, int, int, int]:
    (c0, r0), (c1, r1) = (_PLACE.match(x.replace("$", "")).groups() for x in (ref.split(":") * 2)[:2])
    return int(r0), column_number(c0), int(r1), column_number(c1)


def _relations(z: zipfile.ZipFile, part: str) -> dict[str, str]:
    """Relation id to target: a path inside the file, or an address outside it."""
    folder, name = posixpath.split(part)
    path = f"{folder}/_rels/{name}.rels"
    if path not in z.namelist():
        return {}
    out = {}
    for r in ElementTree.fromstring(z.read(path)):
        target = r.get("Target")
        outside = r.get("TargetMode") == "External"
        out[r.get("Id")] = target if outside else target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"{folder}/{target}")
    return out


def _sheets(z: zipfile.ZipFile) -> list[tuple[str, str]]:
    places, book = _relations(z, "xl/workbook.xml"), ElementTree.fromstring(z.read("xl/workbook.xml"))
    return [(s.get("name"), places[s.get(_REL + "id")]) for s in book.iterfind(f"{_MAIN}sheets/{_MAIN}sheet")]


def _rich_text(node) -> tuple[str, list[tuple]]:
    """Text of a string item (phonetic readings are not part of it) and its runs: text, mark, colour."""
    text, runs = [], []
    for child in node:
        if child.tag == _MAIN + "t":
            text.append(child.text or "")
        elif child.tag == _MAIN + "r":
            own = "".join(t.text or "" for t in child.iter(_MAIN + "t"))
            look = child.find(_MAIN + "rPr")
            mark = next((m for tag, m in (("strike", "strike"), ("b", "bold")) if look is not None and look.find(_MAIN + tag) is not None), None)
            colour = look.find(_MAIN + "color") if look is not None else None
            runs.append((own, mark, colour.get("rgb") if colour is not None else None))
            text.append(own)
    return "".join(text), runs


def _fills(z: zipfile.ZipFile) -> list[str | None]:
    """Solid fill colour by cell style."""
    if "xl/styles.xml" not in z.namelist():
        return []
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    colours = []
    for f in root.iterfind(f"{_MAIN}fills/{_MAIN}fill/{_MAIN}patternFill"):
        fg = f.find(_MAIN + "fgColor")
        colours.append(fg.get("rgb") if f.get("patternType") not in (None, "none") and fg is not None else None)
    return [colours[int(x.get("fillId", 0))] if int(x.get("fillId", 0)) < len(colours) else None for x in root.iterfind(f"{_MAIN}cellXfs/{_MAIN}xf")]


def _strings(z: zipfile.ZipFile) -> list[tuple[str, list[tuple]]]:
    out = []
    if "xl/sharedStrings.xml" in z.namelist():
        with z.open("xl/sharedStrings.xml") as f:
            for _, node in ElementTree.iterparse(f):
                if node.tag == _MAIN + "si":
                    out.append(_rich_text(node))
                    node.clear()
    return out


_V, _F, _IS, _C, _ROW, _COL, _MERGE, _HYPER = (_MAIN + x for x in ("v", "f", "is", "c", "row", "col", "mergeCell", "hyperlink"))


def _value(c, strings) -> tuple[str | None, list[tuple]]:
    kind = c.get("t")
    if kind == "inlineStr":
        node = c.find(_IS)
        return _rich_text(node) if node is not None else (None, [])
    v = c.find(_V)
    if v is None or v.text is None:
        return None, []
    if kind == "s":
        return strings[int(v.text)]
    if kind == "b":
        return ("True" if v.text == "1" else "False"), []
    return v.text, []


def _parts_of(z: zipfile.ZipFile, index: int, name: str, part: str, last: int | None = None) -> Iterator[tuple]:
    """Parts of a sheet; of its cells those up to column `last`."""
    strings, fills, outside = _strings(z), _fills(z), _relations(z, part)
    columns: dict[str, int] = {}  # by letters
    with z.open(part) as f:
        for _, node in ElementTree.iterparse(f):
            tag = node.tag
            if tag == _V or tag == _F or tag == _C:
                continue
            if tag == _ROW:
                for c in node.iterfind(_C):
                    place = c.get("r")
                    letters = place.rstrip("0123456789")
                    col = columns.get(letters)
                    if col is None:
                        col = columns[letters] = column_number(letters)
                    if last is not None and col > last:
                        continue
                    row = int(place[len(letters) :])
                    style, formula = int(c.get("s", 0)), c.find(_F)
                    text, runs = _value(c, strings)
                    yield index, name, "cell", row, col, None, None, formula.text if formula is not None else None, text, None, fills[style] if style < len(fills) else None
                    for i, (own, mark, colour) in enumerate(runs):
                        yield index, name, "run", row, col, i, None, mark, own, None, colour
                node.clear()
            elif tag == _COL:
                yield index, name, "column", None, int(node.get("min")), None, int(node.get("max")), None, node.get("width"), None, None
            elif tag == _MERGE:
                r0, c0, r1, c1 = _span(node.get("ref"))
                yield index, name, "merge", r0, c0, r1, c1, None, None, None, None
            elif tag == _HYPER and outside.get(node.get(_REL + "id")):
                r0, c0, r1, c1 = _span(node.get("ref"))
                yield index, name, "link", r0, c0, r1, c1, None, None, outside[node.get(_REL + "id")], None


@dataclass
class _Sheet(InputPartition):
    index: int
    name: str
    part: str


class _Reader(DataSourceReader):
    def __init__(self, path: str, last: int | None = None):
        self.path, self.last = path, last

    def partitions(self) -> list[InputPartition]:
        system, at = located(self.path)
        with system.open_input_file(at) as f, zipfile.ZipFile(f) as z:
            return [_Sheet(i, *s) for i, s in enumerate(_sheets(z))]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        system, at = located(self.path)
        with system.open_input_file(at) as f, zipfile.ZipFile(f) as z:
            rows = []
            for row in _parts_of(z, partition.index, partition.name, partition.part, self.last):
                rows.append(row)
                if len(rows) == BATCH:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)


# ---- writing


class _Piece:
    """Text that is deflated on its way into a file; the end is a flush, so that more can follow."""

    def __init__(self, out=None):
        self.out, self.deflate, self.held, self.wait = out, zlib.compressobj(1, zlib.DEFLATED, -15), [], 0
        self.crc = self.size = self.packed = 0
        self.bytes = b""

    def _put(self, data: bytes) -> None:
        self.packed += len(data)
        if self.out is None:
            self.bytes += data
        else:
            self.out.write(data)

    def add(self, text: str | memoryview) -> None:
        self.held.append(text.encode() if isinstance(text, str) else text)
        self.wait += len(text)
        if self.wait >= CHUNK:
            self._send()

    def _send(self) -> None:
        raw = b"".join(self.held)
        self.held, self.wait = [], 0
        self.crc, self.size = zlib.crc32(raw, self.crc), self.size + len(raw)
        self._put(self.deflate.compress(raw))

    def end(self, last: bool = False) -> "_Piece":
        self._send()
        self._put(self.deflate.flush(zlib.Z_FINISH if last else zlib.Z_FULL_FLUSH))
        return self


def _times(a: int, b: int) -> int:
    """Product of polynomials over two elements modulo that of CRC-32; the lowest power is the highest bit."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def joined_crc(first: int, second: int, size: int) -> int:
    """The checksum of two byte strings in a row, out of theirs and the `size` of the second."""
    shift, power = 1 << 31, 1 << 23  # one, and one byte
    while size:
        if size & 1:
            shift = _times(shift, power)
        power, size = _times(power, power), size >> 1
    return _times(shift, first) ^ second


@dataclass
class _Pieces(WriterCommitMessage):
    """(sheet index, first row, file, checksum, size, packed size) of each."""

    found: list[tuple[int, int, str, int, int, int]]


def _columns(widths: list[float], rest: float | None) -> str:
    """Column widths: of the first ones, and of all that follow."""
    cols = [f'<col min="{i}" max="{i}" width="{w}" customWidth="1"/>' for i, w in enumerate(widths, 1)]
    if rest is not None:
        cols.append(f'<col min="{len(widths) + 1}" max="16384" width="{rest}" customWidth="1"/>')
    return f"<cols>{''.join(cols)}</cols>" if cols else ""


def _sheet_name(name: str) -> str:
    return re.sub(r"[\[\]:*?/\\]", " ", name)[:31]


class _Writer(DataSourceArrowWriter):
    """Options: styles (fill, bold) and sheets (index, name) as JSON lists, widths and rest of
    columns, by_sheet their widths by name."""

    def __init__(self, options: dict[str, str]):
        self.path, self.scratch = options["path"], f"{options['path']}.{uuid.uuid4().hex}"
        self.styles = [tuple(x) for x in json.loads(options["styles"])]
        self.sheets = json.loads(options["sheets"])
        self.widths, self.rest, self.by_sheet = (json.loads(options[k]) for k in ("widths", "rest", "by_sheet"))

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        """Rows are cells (sheet_index, row, xml) in order; Python sees the rows of a sheet, not its cells."""
        found, piece, sheet, row, first, file = [], None, None, None, None, None
        system, folder = located(self.scratch)

        def close():
            if piece:
                piece.add("</row>")
                piece.end()
                piece.out.close()
                found.append((sheet, first, file, piece.crc, piece.size, piece.packed))

        for batch in batches:
            if not batch.num_rows:
                continue
            at, rows = (batch.column(c).to_numpy() for c in ("sheet_index", "row"))
            cells = batch.column("xml").cast(pa.large_string())
            ends = np.frombuffer(cells.buffers()[1], np.int64)[cells.offset : cells.offset + len(cells) + 1]
            text = memoryview(cells.buffers()[2])
            starts = [0, *(np.flatnonzero((np.diff(at) != 0) | (np.diff(rows) != 0)) + 1).tolist()]
            for i, j in zip(starts, [*starts[1:], len(cells)], strict=True):
                if int(at[i]) != sheet:
                    close()
                    system.create_dir(folder, recursive=True)
                    sheet, row, first, file = int(at[i]), None, int(rows[i]), uuid.uuid4().hex
                    piece = _Piece(system.open_output_stream(f"{folder}/{file}"))
                if int(rows[i]) != row:
                    piece.add(("</row>" if row is not None else "") + f'<row r="{rows[i]}">')
                    row = int(rows[i])
                piece.add(text[ends[i] : ends[j]])  # the cells of a row lie in a row
        close()
        return _Pieces(found)

    def _written(self, z: zipfile.ZipFile, name: str, head: str, pieces: list[tuple], folder: str, system: fs.FileSystem) -> None:
        """A sheet: its head, the pieces as they are, its end."""
        before, after = _Piece(), _Piece()
        before.add(head)
        after.add("</sheetData></worksheet>")
        before.end(), after.end(last=True)
        parts = [(before.crc, before.size, before.packed), *(p[3:] for p in pieces), (after.crc, after.size, after.packed)]
        info = zipfile.ZipInfo(name)
        info.compress_type, info.CRC = zipfile.ZIP_DEFLATED, 0
        for crc, n, _ in parts:
            info.CRC = joined_crc(info.CRC, crc, n)
        info.file_size, info.compress_size, info.header_offset = sum(p[1] for p in parts), sum(p[2] for p in parts), z.fp.tell()
        z.fp.write(info.FileHeader(zip64=max(info.file_size, info.compress_size) >= zipfile.ZIP64_LIMIT))
        z.fp.write(before.bytes)
        for p in pieces:
            with system.open_input_stream(f"{folder}/{p[2]}") as f:
                while data := f.read(COPY):
                    z.fp.write(data)
        z.fp.write(after.bytes)
        z.filelist.append(info)
        z.NameToInfo[name] = info
        z.start_dir, z._didModify = z.fp.tell(), True

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        pieces: dict[int, list[tuple]] = {}
        for p in sorted((p for m in messages if m for p in m.found), key=lambda p: p[:2]):
            pieces.setdefault(p[0], []).append(p)
        ns, rel, kinds = _MAIN[1:-1], _REL[1:-1], "application/vnd.openxmlformats-officedocument.spreadsheetml"
        sheets = sorted(self.sheets) or [[0, "Sheet1"]]
        system, at = located(self.path)
        _, folder = located(self.scratch)
        with system.open_output_stream(at) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for i, (index, name) in enumerate(sheets, 1):
                own = _columns(self.by_sheet[name], None) if name in self.by_sheet else _columns(self.widths, self.rest)
                pane = '<sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews>'
                self._written(z, f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{ns}">{pane}{own}<sheetData>', pieces.get(index, []), folder, system)
            colours = sorted({f for f, _ in self.styles if f})
            fill = {c: i + 2 for i, c in enumerate(colours)}  # the first two are reserved
            z.writestr("xl/styles.xml", f'<styleSheet xmlns="{ns}"><fonts count="2"><font/><font><b/></font></fonts><fills count="{len(colours) + 2}"><fill><patternFill patternType="none"/></fill>'
                       '<fill><patternFill patternType="gray125"/></fill>' + "".join(f'<fill><patternFill patternType="solid"><fgColor rgb={quoteattr(c)}/></patternFill></fill>' for c in colours)
                       + '</fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs>'
                       + "".join(f'<xf fontId="{int(b)}" fillId="{fill.get(c, 0)}" applyFill="1" applyFont="1"/>' for c, b in self.styles) + "</cellXfs></styleSheet>")
            z.writestr("xl/workbook.xml", f'<workbook xmlns="{ns}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name={quoteattr(_sheet_name(n))} sheetId="{i}" r:id="r{i}"/>' for i, (_, n) in enumerate(sheets, 1)) + "</sheets></workbook>")
            z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_OFFICE}/relationships">' + "".join(f'<Relationship Id="r{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
                       + f'<Relationship Id="styles" Type="{rel}/styles" Target="styles.xml"/></Relationships>')
            z.writestr("_rels/.rels", f'<Relationships xmlns="{_OFFICE}/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
            z.writestr("[Content_Types].xml", f'<Types xmlns="{_OFFICE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                       f'<Override PartName="/xl/workbook.xml" ContentType="{kinds}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kinds}.styles+xml"/>'
                       + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kinds}.worksheet+xml"/>' for i in range(1, len(sheets) + 1)) + "</Types>")
        self.abort(messages)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, folder = located(self.scratch)
        if system.get_file_info(folder).type != fs.FileType.NotFound:
            system.delete_dir(folder)


class WorkbookSource(DataSource):
    """`spark.read.format("workbook").load(path)` gives PARTS; rows to write are cells (sheet_index, row, xml) in order."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return PARTS

    def reader(self, schema) -> DataSourceReader:
        last = self.options.get("last_column")
        return _Reader(self.options["path"], int(last) if last else None)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(dict(self.options))
