"""SimHash near-duplicates: exact comparison of fingerprints in tiles, with numpy."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import fresh, stash
from lexspark.llm.components import components

#: Fingerprints in a tile: 512 KB of exclusive-ors for a pair of tiles.
TILE = 256
#: Rows of a block that one task may hold; a larger block is cut into chunks, and their pairs go to tasks of their own.
CHUNK = 16_384
#: Shingles hashed at a time, so that a very long text takes no more memory than a short one.
STEP = 1 << 16


def fingerprint(text: str | None, size: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text's word shingles, as a signed number; 0 without words."""
    tokens = (text or "").encode("utf-8", "replace").lower().split()
    if not tokens:
        return 0
    last = max(1, len(tokens) - size + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, last, STEP):
        stop = min(last, start + STEP)
        part = tokens[start:stop + size - 1]
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(s, seed) for s in map(b" ".join, zip(*(part[k:] for k in range(size))))), np.uint64
        ) if len(tokens) >= size else np.array([xxhash.xxh64_intdigest(b" ".join(tokens), seed)], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > last, bitorder="little").view("<i8")[0])


def _row(id_column: str, text_column: str) -> Column:
    return F.xxhash64(F.col(id_column).cast("string"), F.col(text_column).cast("string"))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id, row, fp`` for every row; ``row`` is a hash of id and text."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array((fingerprint(t.as_py(), size, seed) for t in batch.column(2)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), made], ["doc_id", "row", "fp"])

    return docs.select(F.col(id_column).alias("doc_id"), _row(id_column, text_column).alias("row"), F.col(text_column).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, row bigint, fp bigint")


def _labels(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The component of each row and column of a table of links, counted over both together."""
    rows, columns = near.shape
    left, right = np.arange(rows), np.full(columns, rows + columns)
    while True:
        down = np.minimum(right, np.where(near, left[:, None], rows + columns).min(axis=0))
        up = np.minimum(left, np.where(near, down[None, :], rows + columns).min(axis=1))
        if (down == right).all() and (up == left).all():
            return left, right
        left, right = up, down


def _edges(a: np.ndarray, b: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join what is within the radius between two tiles: a forest, never all pairs."""
    near = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
    if a is b:
        np.fill_diagonal(near, False)
    rows, columns = near.any(axis=1), near.any(axis=0)
    if rows.any():
        a, b = a[rows], b[columns]
        left, right = _labels(near[np.ix_(rows, columns)])
        own = left != np.arange(len(a))
        yield a[own], a[left[own]]
        joined = right < len(a)
        yield b[joined], a[right[joined]]


class _Blocks:
    """Compares the rows of one block after another; rows come sorted by block and population count."""

    def __init__(self, radius: int):
        self.radius = radius
        self.key: bytes | None = None
        self.small: list[np.ndarray] = []
        self.rows: list[np.ndarray] = []
        self.sides: list[np.ndarray] = []

    def close(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The links inside the block that has ended; of a pair of chunks, those between the chunks."""
        fps = np.concatenate(self.rows) if self.rows else np.zeros(0, np.uint64)
        sides = np.concatenate(self.sides) if self.sides else np.zeros(0, bool)
        self.rows, self.sides = [], []
        if len(fps) < TILE // 4 and not sides.any():
            # Small blocks share a tile; a link between two blocks is a link all the same.
            if len(fps) > 1:
                self.small.append(fps)
            if sum(map(len, self.small)) >= TILE:
                yield from self.rest()
            return
        counts = np.bitwise_count(fps).astype(np.int64)
        groups = [np.flatnonzero(sides), np.flatnonzero(~sides)] if sides.any() else [np.arange(len(fps))] * 2
        for x in range(0, len(groups[0]), TILE):
            one = groups[0][x:x + TILE]
            a = fps[one]
            for y in range(0 if sides.any() else x, len(groups[1]), TILE):
                two = groups[1][y:y + TILE]
                if counts[two[-1]] < counts[one[0]] - self.radius:
                    continue
                if counts[two[0]] > counts[one[-1]] + self.radius:
                    break
                yield from _edges(a, a if two is one or (not sides.any() and x == y) else fps[two], self.radius)

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if self.small:
            fps = np.unique(np.concatenate(self.small))
            self.small = []
            yield from _edges(fps, fps, self.radius)


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Blocks(radius)

        def flush(last: bool = False):
            for a, b in itertools.chain(block.close(), block.rest() if last else ()):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
            fps = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            first = batch.column("first").to_numpy(zero_copy_only=False).astype(bool)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
            for start, stop in zip(cuts, cuts[1:]):
                if start == stop:
                    continue
                key = keys[start].tobytes()
                if key != block.key:
                    yield from flush()
                    block.key = key
                block.rows.append(fps[start:stop])
                block.sides.append(first[start:stop])
        yield from flush(last=True)

    return run


def links(fps: DataFrame, radius: int = 3, chunk: int = CHUNK) -> DataFrame:
    """``a, b``: links that connect all fingerprints (``fp``, distinct) within the radius, not every pair.

    Two fingerprints at most ``radius`` bits apart agree in one of ``radius + 1`` equal parts, so a
    block holds the fingerprints with one value of one part; a block is compared in tiles ordered by
    population count, and tile pairs whose counts differ beyond the radius are skipped. A block of
    over ``chunk`` rows is cut by hash, and each pair of chunks is a block of its own.
    """
    width = 64 // (radius + 1)
    mask = F.lit((1 << width) - 1 if width < 64 else -1)
    parts = fps.select("fp", F.explode(F.array(*(
        F.struct(F.lit(i).alias("part"), F.shiftrightunsigned("fp", i * width).bitwiseAND(mask).cast("long").alias("value"))
        for i in range(radius + 1)))).alias("k")).select("k.*", "fp")
    sizes = parts.groupBy("part", "value").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks")).where("chunks > 1")
    own = F.pmod(F.xxhash64("fp"), F.coalesce("chunks", F.lit(1))).cast("int")
    dealt = parts.join(sizes, ["part", "value"], "left").withColumn("own", own).select(
        "part", "value", "own", "fp", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)).alias("other"))
    blocks = dealt.select(
        F.col("part").cast("long"), "value", F.least("own", "other").cast("long").alias("x"), F.greatest("own", "other").cast("long").alias("y"),
        "fp", (F.col("own") < F.col("other")).alias("first"), F.bit_count("fp").alias("ones"))
    keys = ["part", "value", "x", "y"]
    sorted_ = blocks.repartition(*keys).sortWithinPartitions(*keys, "ones", "fp")
    return sorted_.drop("ones").mapInArrow(_compare(radius), "a bigint, b bigint")


def _classed(docs: DataFrame, id_column: str, text_column: str, radius: int, size: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Every row's id, row hash and fingerprint; and each fingerprint's smallest id and root."""
    made = stash(fingerprints(docs, id_column, text_column, size, seed), "simhash")
    least = made.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(least.select("fp"), radius).distinct())
    named = least.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    return made, stash(named, "simhash")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = 3, size: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row; other columns of the input don't matter.

    Fingerprints at most ``radius`` bits apart are linked. ``component_id`` is the smallest doc_id a
    row reaches over links, its own included. A null or empty text has fingerprint zero, which is
    linked like any other. Rows with equal ids or texts stay rows of their own. A null id is no
    candidate for ``component_id``, which is null where all ids reached are null. No rows give no rows.
    """
    made, named = _classed(docs, id_column, text_column, radius, size, seed)
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = named.join(smallest, "root").select("fp", "component_id")
    return made.join(ids, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = 3, size: int = 3, seed: int = 42) -> DataFrame:
    """The rows of ``docs``, with all columns, that stay: of each component the one with the smallest id (null ids last).

    Of rows that share this id the one whose id and text have the smallest hash stays. Rows equal in
    id and text are one document, and stay together.
    """
    key = fresh("row")
    made, named = _classed(docs, id_column, text_column, radius, size, seed)
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row")
    # Copies fold by fingerprint first, in each task, so that no component meets in one.
    firsts = made.groupBy("fp").agg(F.min(place).alias("first")).join(named.select("fp", "root"), "fp").groupBy("root").agg(F.min("first").alias("first"))
    stay = firsts.select(F.col("first.row").alias(key)).distinct()
    return docs.withColumn(key, _row(id_column, text_column)).join(stay, key, "left_semi").drop(key)
