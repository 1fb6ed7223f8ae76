"""XML elements appended to typed columns: offsets and values, from which Arrow makes nested arrays at once.

A shape says where a value is found below an element. Its builder keeps one flat list per leaf, however
deep the shape, so a record costs no dict and no conversion of its own. Standard library and Arrow only;
pickled by value, so executors need no copy of the package.
"""

from __future__ import annotations

import copy
import logging
import sys
from collections.abc import Callable, Iterable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import cloudpickle

log = logging.getLogger(__name__)

Element = ElementTree.Element


class Text:
    """One string per element, by any rule."""

    def __init__(self, of: Callable[[Element], str | None]):
        self.of, self.values = of, []

    def add(self, element: Element) -> None:
        self.values.append(self.of(element))

    def cut(self, n: int) -> None:
        del self.values[n:]

    def take(self) -> pa.Array:
        made, self.values = pa.array(self.values, pa.string()), []
        return made


class Leaves:
    """Per element a struct of the texts, up to their first child, of its first children of each name; null without such a child."""

    def __init__(self, *names: str):
        self.names, self.values = list(names), []

    def add(self, element: Element) -> None:
        # Most elements have just these children, in order.
        if [child.tag for child in element] == self.names:
            self.values += [child.text or "" for child in element]
            return
        texts: dict[str, str] = {}
        for child in element:
            texts.setdefault(child.tag, child.text or "")
        self.values += [texts.get(name) for name in self.names]

    def cut(self, n: int) -> None:
        del self.values[n * len(self.names):]

    def take(self) -> pa.Array:
        arrays = [pa.array(self.values[k::len(self.names)], pa.string()) for k in range(len(self.names))]
        self.values = []
        return pa.StructArray.from_arrays(arrays, self.names)


class Record:
    """A struct per element, of shapes that look below it."""

    def __init__(self, **fields):
        self.fields = fields
        self.adders = [f.add for f in fields.values()]

    def add(self, element: Element) -> None:
        for add in self.adders:
            add(element)

    def cut(self, n: int) -> None:
        for field in self.fields.values():
            field.cut(n)

    def take(self) -> pa.Array:
        return pa.StructArray.from_arrays([f.take() for f in self.fields.values()], list(self.fields))


class First:
    """The shape of the first child of a name; null without one."""

    def __init__(self, tag: str, item):
        self.tag, self.item, self.missing, self.empty = tag, item, [], Element(tag)

    def add(self, element: Element) -> None:
        child = element.find(self.tag)
        self.missing.append(child is None)
        self.item.add(self.empty if child is None else child)

    def cut(self, n: int) -> None:
        del self.missing[n:]
        self.item.cut(n)

    def take(self) -> pa.Array:
        made, missing = self.item.take(), pa.array(self.missing, pa.bool_())
        self.missing = []
        return pa.StructArray.from_arrays(made.flatten(), [f.name for f in made.type], mask=missing)


def children(tag: str) -> Callable[[Element], list[Element]]:
    return lambda element: element.findall(tag)


def below(tag: str, parent: str | None = None) -> Callable[[Element], list[Element]]:
    """All elements called ``tag`` at any depth, or those directly in one called ``parent`` at any depth. Faster than a path."""
    if parent is None:
        return lambda element: [x for x in element.iter(tag) if x is not element]
    return lambda element: [x for held in element.iter(parent) if held is not element for x in held.findall(tag)]


class Every:
    """A list of the shapes of all elements found; with ``holder``, found in the first child of that name, null without one."""

    def __init__(self, found: Callable[[Element], list[Element]], item, holder: str | None = None):
        self.found, self.item, self.holder = found, item, holder
        self.ends, self.missing = [0], []

    def add(self, element: Element) -> None:
        if self.holder is not None:
            element = element.find(self.holder)
        self.missing.append(element is None)
        found = () if element is None else self.found(element)
        for child in found:
            self.item.add(child)
        self.ends.append(self.ends[-1] + len(found))

    def cut(self, n: int) -> None:
        del self.ends[n + 1:], self.missing[n:]
        self.item.cut(self.ends[-1])

    def take(self) -> pa.Array:
        ends, missing = pa.array(self.ends, pa.int32()), pa.array(self.missing, pa.bool_())
        self.ends, self.missing = [0], []
        return pa.ListArray.from_arrays(ends, self.item.take(), mask=missing)


_BATCH = 2048


def read_records(members: Iterable[dict], elements: Callable[[bytes], Iterator[Element]], fail_fast: bool,
                 shape: Record, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """``archive, member, record`` of every file. A malformed file is an error or gives no record at all."""
    record, archives, names = copy.deepcopy(shape), [], []

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(archives, pa.string()), pa.array(names, pa.string()), record.take()], schema.names)
        archives.clear()
        names.clear()
        return made.cast(schema)

    for row in members:
        before = len(names)
        try:
            for element in elements(row["content"]):
                record.add(element)
                archives.append(row["archive"])
                names.append(row["member"])
                # Records of a file that may turn out malformed wait for its end.
                if fail_fast and len(names) >= _BATCH:
                    yield batch()
        except ElementTree.ParseError:
            if fail_fast:
                raise
            log.info("malformed XML in %s/%s", row["archive"], row["member"])
            record.cut(before)
            del archives[before:], names[before:]
        if len(names) >= _BATCH:
            yield batch()
    if names:
        yield batch()


def read_texts(batches: Iterable[pa.RecordBatch], fail_fast: bool, shape: Record, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The record of the one element that each text of the last column is, beside the other columns. A malformed text is
    an error or gives the record of an element without anything, as a null one does."""
    record, nothing = copy.deepcopy(shape), Element("nothing")
    for batch in batches:
        for text in batch.columns[-1]:
            try:
                record.add(ElementTree.fromstring(text.as_py()) if text.is_valid else nothing)
            except ElementTree.ParseError:
                if fail_fast:
                    raise
                record.add(nothing)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], record.take()], schema.names).cast(schema)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
