"""What runs inside the tasks: unpack archives and read XML elements from bytes.

Standard library and Arrow only. The module is pickled by value, so executors need no copy of
the package.
"""

from __future__ import annotations

import io
import logging
import sys
import zipfile
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import cloudpickle

log = logging.getLogger(__name__)

Element = ElementTree.Element


#: Bytes of XML up to which a file's tree is built at once.
_WHOLE = 32 << 20
_BATCH_ROWS = 512
_BATCH_BYTES = 4 << 20


def batches_of(rows: Iterable[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Arrow batches bounded by rows and, for rows with a ``content``, by bytes."""
    pending: list[dict] = []
    size = 0
    for row in rows:
        pending.append(row)
        size += len(row.get("content", b""))
        if len(pending) >= _BATCH_ROWS or size >= _BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(pending, schema)
            pending, size = [], 0
    if pending:
        yield pa.RecordBatch.from_pylist(pending, schema)


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one; only the current cell is copied out of the batch."""
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns, strict=True))
        for i in range(batch.num_rows):
            yield {name: column[i].as_py() for name, column in columns.items()}


def unpack(packed: bytes, suffix: str, first_only: bool = False) -> Iterator[tuple[str, bytes]]:
    with zipfile.ZipFile(io.BytesIO(packed)) as archive:
        names = [n for n in archive.namelist() if n.endswith(suffix)]
        for name in names[:1] if first_only else names:
            yield name, archive.read(name)


def first_xml(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """The first ``.xml`` member of each archive; an archive without one is skipped."""
    for row in rows_of(batches):
        found = list(unpack(row["content"], ".xml", first_only=True))
        if not found:
            log.warning("no XML in %s", row["archive"])
        for member, content in found:
            yield {"archive": row["archive"], "member": member, "content": content}


def inner_archives(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Every ``.zip`` member of each archive, still packed."""
    for row in rows_of(batches):
        for member, content in unpack(row["content"], ".zip"):
            yield {"archive": row["archive"], "member": member, "content": content}


def inner_xml(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Every ``.xml`` member of each inner archive."""
    for row in rows_of(batches):
        for member, content in unpack(row["content"], ".xml"):
            yield {"archive": row["archive"], "member": f"{row['member']}/{member}", "content": content}


def pack_members(members: Iterable[tuple[str, bytes]]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive:
        for name, content in members:
            archive.writestr(name, content)
    return out.getvalue()


class _Discard:
    """Parser target that builds nothing."""


def check(content: bytes) -> None:
    """Raise ``ParseError`` if the XML is malformed."""
    parser = ElementTree.XMLParser(target=_Discard())
    parser.feed(content)
    parser.close()


def well_formed(content: bytes) -> bool:
    try:
        check(content)
        return True
    except ElementTree.ParseError:
        return False


def elements(content: bytes, tag: str, any_depth: bool, whole: int = _WHOLE) -> Iterator[Element]:
    """The elements called ``tag`` below the root. Files of over ``whole`` bytes are read as a stream, which takes longer."""
    if len(content) <= whole:
        yield from ElementTree.fromstring(content).findall(f".//{tag}" if any_depth else tag)
        return
    path: list[Element] = []
    inside = 0
    for event, element in ElementTree.iterparse(io.BytesIO(content), events=("start", "end")):
        if event == "start":
            inside += bool(path) and element.tag == tag
            path.append(element)
            continue
        path.pop()
        if path and element.tag == tag:
            inside -= 1
            if any_depth or len(path) == 1:
                yield element
        if path and not inside:
            path[-1].remove(element)  # done with: free it


def own_text(parent: Element, tag: str) -> str | None:
    """Text before the first child of the first child called ``tag``."""
    child = parent.find(tag)
    return None if child is None else (child.text or "")


def malformed(members: Iterable[dict]) -> Iterator[dict]:
    for row in members:
        if not well_formed(row["content"]):
            yield {"archive": row["archive"], "member": row["member"]}


cloudpickle.register_pickle_by_value(sys.modules[__name__])
