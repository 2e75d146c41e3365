"""Unpacks one ``.xlsx`` workbook (ECMA-376): its sheets, and the stored cells of a sheet.

A helper for the tasks in ``workbook.py``: standard library only. It opens the archive, follows its
links, cuts the XML of a sheet, or of the shared strings, into blocks of whole elements, and reads the
cells, or strings, of one block. What a cell means is decided by Spark (``operators/cells.py``).
"""

from __future__ import annotations

import codecs
import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET
from xml.parsers import expat

#: A stored cell: position from 0, kind, style number, text; of a shared string its number.
Cell = tuple[int, str, int, str]
#: Bytes of XML that make a block; one element is never cut.
BLOCK_BYTES = 1 << 20
#: What is read again when a block grows, so that no tag is missed; longer than any tag of a row.
_OVERLAP = 1 << 16


class Book:
    """One workbook: ``sheets`` is the ordered list of (name, member of the archive).

    ``formats`` has the number format of each cell style: its code, or ``id:`` and the number of a
    built-in one. ``date1904`` tells which day is day 0.
    """

    def __init__(self, content: bytes):
        self._zip = zipfile.ZipFile(io.BytesIO(content))
        self._members = set(self._zip.namelist())
        main = next(
            (target for kind, target in self._links("").values() if kind == "officeDocument"),
            "xl/workbook.xml",
        )
        links = self._links(main)
        root = self._xml(main)
        self.sheets = []
        for sheet in _children(root, "sheets", "sheet"):
            ref = next(v for k, v in sheet.attrib.items() if k.endswith("}id"))
            if links.get(ref, ("", ""))[1] in self._members:
                self.sheets.append((sheet.attrib["name"], links[ref][1]))
        options = next(iter(_children(root, "workbookPr")), None)
        self.date1904 = options is not None and options.get("date1904") in ("1", "true")
        self._parts = {kind: target for kind, target in links.values() if target in self._members}

    @property
    def formats(self) -> list[str]:
        if "styles" not in self._parts:
            return []
        root = self._xml(self._parts["styles"])
        codes = {f.get("numFmtId"): f.get("formatCode", "") for f in _children(root, "numFmts", "numFmt")}
        used = [xf.get("numFmtId", "0") for xf in _children(root, "cellXfs", "xf")]
        return [codes.get(number, f"id:{number}") for number in used]

    def blocks(self, member: str) -> Iterator[tuple[str, int, bytes]]:
        """The rows of a sheet as XML: (prefix of its names, number of the first row from 0, whole ``<row>`` elements)."""
        with self._zip.open(member) as stream:
            yield from _cut(_as_utf8(stream), b"row")

    def string_blocks(self) -> Iterator[tuple[str, int, bytes]]:
        """The shared strings as XML: (prefix of its names, number of the first one, whole ``<si>`` elements)."""
        if "sharedStrings" in self._parts:
            with self._zip.open(self._parts["sharedStrings"]) as stream:
                yield from _cut(_as_utf8(stream), b"si")

    def strings(self, wanted: set[int]) -> dict[int, str]:
        """The wanted shared strings that there are, read only as far as the last of them."""
        found: dict[int, str] = {}
        if wanted:
            for prefix, first, xml in self.string_blocks():
                found.update((n, text) for n, text in enumerate(block_strings(prefix, xml), first) if n in wanted)
                if len(found) == len(wanted):
                    break
        return found

    def rows(self, member: str) -> Iterator[tuple[int, list[Cell]]]:
        """(row number from 0, its cells) of the rows that hold any text, in the order of the sheet."""
        for block in self.blocks(member):
            yield from block_rows(*block)

    def header(self, member: str) -> list[Cell]:
        """The cells of row 0."""
        number, cells = next(self.rows(member), (0, []))
        return [] if number else cells

    def _xml(self, member: str) -> ET.Element:
        return ET.fromstring(self._zip.read(member))

    def _links(self, part: str) -> dict[str, tuple[str, str]]:
        """Relationship id -> (kind, member) of one part of the package."""
        folder, name = posixpath.split(part)
        member = posixpath.join(folder, "_rels", f"{name}.rels")
        if member not in self._members:
            return {}
        links = {}
        for link in self._xml(member):
            target = link.get("Target", "")
            target = target[1:] if target.startswith("/") else posixpath.normpath(posixpath.join(folder, target))
            links[link.get("Id")] = (link.get("Type", "").rsplit("/", 1)[-1], target)
        return links


class _StringEvents:
    """Shared strings, one per ``<si>``: its own text or its rich-text runs, no phonetic hints."""

    def __init__(self):
        self.done: list = []
        self._text: list[str] = []
        self._reading = self._hint = False

    def start(self, tag: str, attributes: dict) -> None:
        if tag == "t":
            self._reading = not self._hint
        elif tag == "rPh":
            self._hint = True

    def data(self, text: str) -> None:
        if self._reading:
            self._text.append(text)

    def end(self, tag: str) -> None:
        if tag == "t":
            self._reading = False
        elif tag == "rPh":
            self._hint = False
        elif tag == "si":
            # An underscore that would start an escape is itself escaped as _x005F_.
            self.done.append("".join(self._text).replace("x005F_", ""))
            self._text.clear()


class _SheetEvents(_StringEvents):
    """Rows of a sheet as (row number from 0, cells with text)."""

    def __init__(self, first: int):
        super().__init__()
        self._columns = _Columns()
        self._number, self._at = first - 1, -1
        self._cells: list[Cell] = []
        self._cell: dict = {}

    def start(self, tag: str, attributes: dict) -> None:
        if tag == "c":
            self._cell = attributes
        elif tag == "v":
            self._reading = True
        elif tag == "row":
            self._number = int(attributes["r"]) - 1 if "r" in attributes else self._number + 1
            self._cells = []
            self._at = -1
        else:
            super().start(tag, attributes)

    def end(self, tag: str) -> None:
        if tag == "c":
            cell, text = self._cell, self._text
            self._at = self._columns[cell["r"].rstrip("0123456789")] if "r" in cell else self._at + 1
            if text:
                raw = text[0] if len(text) == 1 else "".join(text)
                self._cells.append((self._at, cell.get("t", "n"), int(cell.get("s", "0")), raw))
                text.clear()
        elif tag == "v":
            self._reading = False
        elif tag == "row":
            if self._cells:
                self.done.append((self._number, self._cells))
        else:
            super().end(tag)


def block_rows(prefix: str, first: int, xml: bytes) -> Iterator[tuple[int, list[Cell]]]:
    """(row number from 0, its cells) of the rows of a block that hold any text."""
    return _parse(prefix, xml, _SheetEvents(first))


def block_strings(prefix: str, xml: bytes) -> Iterator[str]:
    """The strings of a block."""
    return _parse(prefix, xml, _StringEvents())


#: A block is parsed inside an element of its own.
_ROOT, _END = b"<block>", b"</block>"


def _parse(prefix: str, xml: bytes, events: _StringEvents) -> Iterator:
    """What ``events`` completes, chunk by chunk of the XML."""
    parser = expat.ParserCreate("utf-8")
    parser.buffer_text = True
    named = len(prefix) + 1 if prefix else 0
    parser.StartElementHandler = lambda tag, attributes: events.start(tag[named:], attributes)
    parser.EndElementHandler = lambda tag: events.end(tag[named:])
    parser.CharacterDataHandler = events.data
    parser.Parse(_ROOT)
    for n in range(0, len(xml), 65_536):
        parser.Parse(xml[n : n + 65_536])
        yield from events.done
        events.done.clear()
    parser.Parse(_END, True)
    yield from events.done


def _as_utf8(stream) -> Iterator[bytes]:
    """The XML in ``stream`` chunk by chunk, in UTF-8 whatever its own encoding."""
    start = stream.read(200).removeprefix(codecs.BOM_UTF8)
    named = re.match(rb"""<\?xml[^>]*\bencoding\s*=\s*["']([\w.-]+)""", start)
    wide = start.startswith((codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE))
    encoding = "utf-16" if wide else named[1].decode() if named else "utf-8"
    if codecs.lookup(encoding).name in ("utf-8", "ascii"):
        yield start
        while chunk := stream.read(BLOCK_BYTES):
            yield chunk
    else:
        decoder = codecs.getincrementaldecoder(encoding)()
        yield decoder.decode(start).encode()
        while chunk := stream.read(BLOCK_BYTES):
            yield decoder.decode(chunk).encode()
        yield decoder.decode(b"", True).encode()


def _cut(chunks: Iterator[bytes], tag: bytes) -> Iterator[tuple[str, int, bytes]]:
    """XML cut behind elements called ``tag``: (prefix of names, number of the first element, whole elements).

    An element is numbered by its ``r``, from 1, or follows the one before it. What lies before the first
    and after the last of them must be well-formed. There is at least one block, which may be empty.
    """
    token = re.compile(
        rb"<!--.*?-->|<!\[CDATA\[.*?\]\]>|<(?P<close>/?)(?:[\w.-]+:)?" + tag
        + rb"(?=[\s/>])(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
    outside = expat.ParserCreate("utf-8")
    names: list[str] = []
    outside.StartElementHandler = lambda name, _: names.append(name) if not names else None
    held, seen = b"", 0
    # Whole elements that are not given out yet, the number of the first, and where one is open.
    start, end, first, opened = None, 0, 0, None
    number, given, more = -1, False, True
    while more:
        chunk = next(chunks, None)
        more = chunk is not None
        held += chunk or b""
        limit = _unclosed(held, seen) if more else len(held)
        for found in token.finditer(held, seen, limit):
            seen = found.end()
            if found["close"] is None:
                continue  # a comment or literal text
            if not found["close"]:
                named = re.search(rb"(?:^|\s)r\s*=\s*[\"']([^\"']*)", found["attributes"])
                number = int(named[1]) - 1 if named else number + 1
                opened = found.start()
                if start is None:
                    outside.Parse(held[end:opened])
                    start, end, first = opened, opened, number
            if found["close"] or found["attributes"].endswith(b"/"):
                end, opened = found.end(), None
        # What was looked through needs no second look, but for a tag that may go on.
        seen = max(seen, limit - _OVERLAP)
        if start is not None and end - start >= BLOCK_BYTES:
            yield names[0].rpartition(":")[0], first, held[start:end]
            given, held, seen = True, held[end:], seen - end
            start, end, first, opened = None, 0, number, opened and opened - end
            if opened is not None:
                outside.Parse(held[:opened])
                start = end = opened
        elif start is None:
            outside.Parse(held[end:seen])
            held, seen, end = held[seen:], 0, 0
    if start is not None and end > start:
        yield names[0].rpartition(":")[0], first, held[start:end]
        given = True
    outside.Parse(held[end:], True)
    if not given:
        yield names[0].rpartition(":")[0], 0, b""


def _unclosed(held: bytes, seen: int) -> int:
    """Where a comment or literal text begins that goes on in the next chunk; else the end."""
    for opening, closing in ((b"<!--", b"-->"), (b"<![CDATA[", b"]]>")):
        at = held.rfind(opening, seen)
        if at >= 0 and held.find(closing, at) < 0:
            return at
    return len(held)


class _Columns(dict):
    """Position from 0 of a column's letters, remembered: A is 0, Z is 25, AA is 26."""

    def __missing__(self, letters: str) -> int:
        number = 0
        for letter in letters:
            number = number * 26 + int(letter, 36) - 9
        self[letters] = number - 1
        return number - 1


def _local(node: ET.Element) -> str:
    return node.tag.rpartition("}")[2]


def _children(node: ET.Element, *path: str) -> list[ET.Element]:
    found = [node]
    for name in path:
        found = [child for parent in found for child in parent if _local(child) == name]
    return found
