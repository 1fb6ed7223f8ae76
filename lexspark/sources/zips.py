"""ZIP archives of any size, read by many tasks: a data source whose partitions are ranges of the central directory.

The plan scans the directory of a large archive once and keeps ranges of about ``split`` packed bytes; a
task reads its range and, by their offsets, the members in it. Archives of no more bytes than that are
not opened by the plan: tasks get as many of them as make up their bytes, and read the directories. Members are handed on packed, to be unpacked where they
are read. An inner archive that is stored as it is has a directory of its own, which is planned like any
other. One that is deflated can be entered at its beginning only: a large one is inflated by several
tasks, each of which keeps every so-many-th member.

Files are opened by ``pyarrow.fs`` (local, s3, gs, hdfs and others that it knows). Pickled by value.
"""

from __future__ import annotations

import fnmatch
import io
import struct
import sys
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Packed bytes of the members of a partition; and tasks among which a deflated inner archive is dealt out at most.
SPLIT, SHARES = 32 << 20, 64
#: Bytes read or inflated at once, and bytes of a batch handed on.
_STEP, _BATCH = 1 << 20, 1 << 20
#: A cell of a table is no longer than this.
_CELL = (1 << 31) - 1024

_MANY = 0xFFFFFFFF


class Layout(NamedTuple):
    """The fields of a fixed part of an archive."""

    fields: str

    @property
    def size(self) -> int:
        return struct.calcsize(self.fields)

    def unpack(self, data: bytes, at: int = 0) -> tuple:
        return struct.unpack_from(self.fields, data, at)


# The records of the ZIP format.
_END, _END64, _LOCATOR = Layout("<4s4H2LH"), Layout("<4sQ2H2L4Q"), Layout("<4sLQL")
_ENTRY, _LOCAL = Layout("<4s6H3L5H2L"), Layout("<4s5H3L2H")

STORED, DEFLATED = 0, 8
SCHEMA = pa.schema([
    ("archive", pa.string()), ("member", pa.string()), ("method", pa.int32()), ("crc", pa.int64()), ("content", pa.binary())])


class Entry(NamedTuple):
    name: str
    flags: int
    method: int
    crc: int
    packed: int
    size: int
    header: int


class Directory(NamedTuple):
    """Where a central directory lies, and by how much offsets in it fall short of places in the file."""

    start: int
    size: int
    shift: int


class Window:
    """Part of a file that reads as a file."""

    def __init__(self, file: BinaryIO, start: int, size: int):
        self.file, self.start, self.size = file, start, size

    def at(self, offset: int, size: int) -> bytes:
        if offset < 0 or offset + size > self.size:
            raise ValueError("an offset beyond the archive")
        self.file.seek(self.start + offset)
        found = self.file.read(size)
        if len(found) != size:
            raise ValueError("the archive ends early")
        return found


def directory(file: Window) -> Directory:
    """The central directory of an archive, also of one with over 65,535 members or 4 GB, or with something before it."""
    tail = min(file.size, (1 << 16) + _END.size + _LOCATOR.size)
    data = file.at(file.size - tail, tail)
    place = data.rfind(b"PK\5\6")
    if place < 0 or len(data) < place + _END.size:
        raise ValueError("not a ZIP archive")
    _, _, _, _, entries, size, start, _ = _END.unpack(data, place)
    end = file.size - tail + place
    if entries == 0xFFFF or size == _MANY or start == _MANY:
        sign, _, at, _ = _LOCATOR.unpack(data, place - _LOCATOR.size) if place >= _LOCATOR.size else (b"", 0, 0, 0)
        if sign == b"PK\6\7":
            # Something may stand before the archive: then the record lies right before its locator.
            for at in (at, end - _LOCATOR.size - _END64.size):
                record = _END64.unpack(file.at(at, _END64.size))
                if record[0] == b"PK\6\6":
                    size, start, end = record[8], record[9], at
                    break
            else:
                raise ValueError("no end record of a large ZIP archive")
    return Directory(end - size, size, end - size - start)


def entries(file: Window, start: int, size: int, shift: int) -> Iterator[tuple[int, Entry]]:
    """The entries of a range of a central directory, each with the place it begins."""
    data, used, at, end = b"", 0, start, start + size
    read = start
    while at < end:
        while len(data) - used < _ENTRY.size or len(data) - used < _ENTRY.size + sum(struct.unpack_from("<3H", data, used + 28)):
            step = min(_STEP, end - read)
            if step <= 0:
                raise ValueError("the directory of the archive ends early")
            data, used, read = data[used:] + file.at(read, step), 0, read + step
        sign, _, _, flags, method, _, _, crc, packed, full, n_name, n_extra, n_comment, _, _, _, header = _ENTRY.unpack(data, used)
        if sign != b"PK\1\2":
            raise ValueError("a damaged directory")
        text = used + _ENTRY.size
        name = data[text:text + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        full, packed, header = _large(data[text + n_name:text + n_name + n_extra], full, packed, header)
        yield at, Entry(name, flags, method, crc, packed, full, header + shift)
        length = _ENTRY.size + n_name + n_extra + n_comment
        used, at = used + length, at + length


def _large(extra: bytes, *values: int) -> list[int]:
    """Values, those that need it from the extra field for large archives."""
    wide: list[int] = []
    while len(extra) >= 4:
        kind, size = struct.unpack_from("<2H", extra)
        if kind == 1:
            wide = list(struct.unpack_from(f"<{size // 8}Q", extra, 4))
        extra = extra[4 + size:]
    return [wide.pop(0) if x == _MANY and wide else x for x in values]


def packed(file: Window, entry: Entry) -> bytes:
    """A member's bytes as they lie in the archive."""
    if entry.flags & 1 or entry.method not in (STORED, DEFLATED):
        raise ValueError(f"{entry.name} is encrypted, or packed by an unknown method")
    if entry.packed > _CELL:
        raise ValueError(f"{entry.name} has {entry.packed} packed bytes, more than a cell holds")
    return file.at(_data(file, entry), entry.packed)


def _data(file: Window, entry: Entry) -> int:
    sign, *_, n_name, n_extra = _LOCAL.unpack(file.at(entry.header, _LOCAL.size))
    if sign != b"PK\3\4":
        raise ValueError(f"no member at the place of {entry.name}")
    return entry.header + _LOCAL.size + n_name + n_extra


def unpacked(content: bytes, method: int, crc: int) -> bytes:
    """A member's bytes; an error if they aren't those that were packed."""
    full = content if method == STORED else zlib.decompress(content, -zlib.MAX_WBITS)
    if zlib.crc32(full) != crc:
        raise ValueError("a damaged member")
    return full


class _Stream:
    """What a deflated member inflates to, from its beginning on."""

    def __init__(self, file: Window, entry: Entry):
        start, self.left = _data(file, entry), entry.packed
        self.file, self.at, self.engine, self.ready = file, start, zlib.decompressobj(-zlib.MAX_WBITS), b""

    def more(self) -> bytes:
        """The next bytes; none at the end."""
        while not self.ready and not self.engine.eof:
            if not self.engine.unconsumed_tail:
                step = min(_STEP, self.left)
                data, self.at, self.left = self.file.at(self.at, step), self.at + step, self.left - step
            else:
                data = self.engine.unconsumed_tail
            self.ready = self.engine.decompress(data, _STEP)
            if not data and not self.ready:
                raise ValueError("a damaged member")
        out, self.ready = self.ready, b""
        return out

    def take(self, n: int) -> bytes:
        """The next ``n`` bytes, or fewer at the end."""
        out = bytearray()
        while len(out) < n and (data := self.more()):
            out += data
        self.ready = bytes(out[n:]) + self.ready
        return bytes(out[:n])

    def skip(self, n: int) -> None:
        while n > 0 and (data := self.more()):
            self.ready = data[n:]
            n -= len(data)


def streamed(file: Window, entry: Entry, suffix: str, share: int, shares: int) -> Iterator[tuple[Entry, bytes]]:
    """Every ``shares``-th member of an inner archive, in the order they lie, from the ``share``-th on."""
    stream, number = _Stream(file, entry), 0
    while True:
        head = stream.take(_LOCAL.size)
        if len(head) < _LOCAL.size or head[:4] != b"PK\3\4":
            return
        _, _, flags, method, _, _, crc, size, full, n_name, n_extra = _LOCAL.unpack(head)
        name = stream.take(n_name).decode("utf-8" if flags & 0x800 else "cp437")
        full, size = _large(stream.take(n_extra), full, size)
        wanted = name.endswith(suffix)
        number += wanted
        mine = wanted and (number - 1) % shares == share
        if flags & 8:
            content, crc = _open_ended(stream, name, method)
        elif mine:
            if size > _CELL:
                raise ValueError(f"{name} has {size} packed bytes, more than a cell holds")
            content = stream.take(size)
        else:
            stream.skip(size)
        if mine:
            yield Entry(name, flags, method, crc, len(content), full, 0), content


def _open_ended(stream: _Stream, name: str, method: int) -> tuple[bytes, int]:
    """A member whose size stands behind it: it ends where what is packed ends."""
    if method != DEFLATED:
        raise ValueError(f"{name} is stored without its size")
    engine, content, crc = zlib.decompressobj(-zlib.MAX_WBITS), bytearray(), 0
    while not engine.eof:
        if not (data := stream.more()):
            raise ValueError(f"{name} ends early")
        crc = zlib.crc32(engine.decompress(data), crc)
        content += data[:len(data) - len(engine.unused_data)]
    stream.ready = engine.unused_data + stream.ready
    # The sign is optional, and sizes have eight bytes in a large archive: look where the next header begins.
    tail = stream.take(24)
    at = next(k for k in (16, 12, 24, 20) if len(tail) <= k or tail[k:k + 2] == b"PK")
    stream.ready = tail[at:] + stream.ready
    return bytes(content), crc


class Part(InputPartition):
    """A range of the directory of an archive (within ``start`` and ``size`` of a file), or a share of a deflated inner archive."""

    def __init__(self, archive: str, inside: str, start: int, size: int, place: Directory, packed: int, share: tuple[Entry, int, int] | None = None):
        self.archive, self.inside, self.start, self.size, self.place, self.packed, self.share = archive, inside, start, size, place, packed, share


class Parts(InputPartition):
    """What one task reads: as many parts of large archives, and whole small ones, as make up its bytes; ``split`` is what the plan took for many."""

    def __init__(self, split: int):
        self.parts: list[Part] = []
        self.whole: list[tuple[str, int]] = []
        self.split = split


class MembersReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.glob, self.suffix = options["path"], options.get("glob", "*.zip"), options.get("suffix", ".xml")
        self.first = options.get("first", "false").lower() == "true"
        self.inner = options.get("inner", "false").lower() == "true"
        self.split, self.tasks = int(options.get("split", str(SPLIT))), int(options.get("tasks", "1"))

    def _files(self) -> Iterator[tuple[str, int]]:
        store, root = opened(self.path)
        info = store.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.is_file else store.get_file_info(fs.FileSelector(root))
        for x in sorted(found, key=lambda f: f.path):
            if x.is_file and (info.is_file or any(fnmatch.fnmatchcase(x.base_name, g) for g in self.glob.split("|"))):
                yield x.path, x.size

    def partitions(self) -> list[Parts]:
        store, _ = opened(self.path)
        out: list[Parts] = []
        files = list(self._files())
        # As Spark does with files: fewer bytes a task where there are few in all, so that no core idles.
        self.split = min(self.split, max(_BATCH, sum(size for _, size in files) // self.tasks))
        held = self.split

        def room(size: int) -> Parts:
            """What the next part of so many bytes goes to."""
            nonlocal held
            if held + size // 2 >= self.split:
                out.append(Parts(self.split))
                held = 0
            held += size
            return out[-1]

        for archive, size in files:
            if size <= self.split:
                room(size).whole.append((archive, size))
                continue
            with store.open_input_file(archive) as file:
                for part in self._plan(archive, "", Window(file, 0, size)):
                    room(part.packed).parts.append(part)
        return out

    def _plan(self, archive: str, inside: str, file: Window) -> list[Part]:
        place = directory(file)
        suffix = ".zip" if self.inner and not inside else self.suffix
        out: list[Part] = []
        begin, held = None, 0

        def close(end: int) -> None:
            nonlocal begin, held
            if begin is not None:
                out.append(Part(archive, inside, file.start, file.size, Directory(begin, end - begin, place.shift), held))
            begin, held = None, 0

        for at, entry in entries(file, place.start, place.size, place.shift):
            if not entry.name.endswith(suffix):
                continue
            if suffix == ".zip" and not inside and self.inner:
                if entry.method == STORED:
                    close(at)
                    out += self._plan(archive, entry.name, Window(file.file, file.start + _data(file, entry), entry.packed))
                    continue
                if entry.packed > self.split:
                    close(at)
                    shares = min(SHARES, -(-entry.packed // self.split))
                    out += [Part(archive, "", file.start, file.size, place, self.split, (entry, k, shares)) for k in range(shares)]
                    continue
            if begin is None:
                begin = at
            held += entry.packed
            if self.first:
                close(self._next(file, place, at))
                return out
            if held + entry.packed // 2 >= self.split:
                close(self._next(file, place, at))
        close(place.start + place.size)
        return out

    @staticmethod
    def _next(file: Window, place: Directory, at: int) -> int:
        """Where the entry after the one at ``at`` begins."""
        return at + _ENTRY.size + sum(struct.unpack("<3H", file.at(at + 28, 6)))

    def read(self, partition: Parts | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # nothing was planned
            return
        self.split = partition.split
        yield from _batches(self._found(partition))

    def _found(self, partition: Parts) -> Iterator[tuple[str, str, Entry, bytes]]:
        store, _ = opened(self.path)
        for part in partition.parts:
            with store.open_input_file(part.archive) as file:
                yield from self._members(part, file)
        for archive, size in partition.whole:
            with store.open_input_file(archive) as file:
                # A small archive is one read.
                own = io.BytesIO(file.read()) if size <= _STEP else file
                for part in self._plan(archive, "", Window(own, 0, size)):
                    yield from self._members(part, own)

    def _members(self, part: Part, opened_file: BinaryIO) -> Iterator[tuple[str, str, Entry, bytes]]:
        file = Window(opened_file, part.start, part.size)
        if part.share is not None:
            entry, share, shares = part.share
            for found, content in streamed(file, entry, self.suffix, share, shares):
                yield part.archive, f"{entry.name}/{found.name}", found, content
            return
        suffix = ".zip" if self.inner and not part.inside else self.suffix
        for _, entry in entries(file, *part.place):
            if not entry.name.endswith(suffix) or (suffix == ".zip" and self.inner and (entry.method == STORED or entry.packed > self.split)):
                continue
            if self.inner and not part.inside:
                content = unpacked(packed(file, entry), entry.method, entry.crc)
                own = Window(io.BytesIO(content), 0, len(content))
                for _, found in entries(own, *directory(own)):
                    if found.name.endswith(self.suffix):
                        yield part.archive, f"{entry.name}/{found.name}", found, packed(own, found)
                continue
            yield part.archive, (f"{part.inside}/" if part.inside else "") + entry.name, entry, packed(file, entry)


def _batches(members: Iterable[tuple[str, str, Entry, bytes]]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    held = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*rows), SCHEMA)], schema=SCHEMA)

    for archive, name, entry, content in members:
        rows.append((archive, name, entry.method, entry.crc, content))
        held += len(content)
        if held >= _BATCH or len(rows) >= 4096:
            yield batch()
            rows, held = [], 0
    if rows:
        yield batch()


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path and the place in it."""
    return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)


def reachable(path: str) -> bool:
    """Whether the store of a path is one that can be read by ranges here."""
    try:
        opened(path)
        return True
    except (OSError, ValueError, NotImplementedError):
        return False


class ArchiveMembers(DataSource):
    """Options: ``path`` (a folder or an archive), ``glob`` of archives (several with ``|`` between), ``suffix`` of members, ``first`` member only, members of
    ``inner`` archives, ``split``, the most packed bytes of a partition, and ``tasks``, how many there should be at least."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return "archive string, member string, method int, crc bigint, content binary"

    def reader(self, schema) -> DataSourceReader:
        return MembersReader(dict(self.options))


def read_members(spark: SparkSession, path: str, glob: str = "*.zip", suffix: str = ".xml", first: bool = False,
                 inner: bool = False, split: int = SPLIT) -> DataFrame:
    """``(archive, member, method, crc, content)`` of the members of archives, packed, read by ranges. A member of an inner archive is
    ``inner.zip/file.xml``. Archives may have any size; a packed member has at most 2 GB."""
    spark.dataSource.register(ArchiveMembers)
    return spark.read.format("zip_members").options(
        glob=glob, suffix=suffix, first=str(first).lower(), inner=str(inner).lower(), split=str(split), tasks=str(spark.sparkContext.defaultParallelism)).load(path)


def unpacked_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """``archive, member, content`` of packed members, unpacked one by one."""
    for batch in batches:
        for archive, member, method, crc, content in zip(*(batch.column(i) for i in range(5))):
            yield {"archive": archive.as_py(), "member": member.as_py(), "content": unpacked(content.as_py(), method.as_py(), crc.as_py())}


cloudpickle.register_pickle_by_value(sys.modules[__name__])
