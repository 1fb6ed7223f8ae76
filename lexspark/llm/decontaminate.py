"""Benchmark decontamination: n-gram seeds, the rarest first, find passages, Smith-Waterman alignment scores them."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words in a seed.
SEED = 3
#: Words of an item that are aligned together; longer items are parts of about this size, and parts shifted by thirds of it.
PART, SHIFTS = 128, 3
#: An item with fewer words is looked for as it is, word by word; longer ones are aligned.
LEAST_WORDS = 8
#: Share of the highest score at which a passage is a copy.
SCORE = 0.6
MATCH, MISMATCH, GAP = 2, -1, -1
#: Bytes of items that are looked for in one pass; more items take more passes.
BLOCK_BYTES = 1 << 20

#: Scripts without spaces between words: Thai and Lao, Tibetan, Burmese, Khmer, kana, Chinese characters.
_UNSPACED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3021-\u3029\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff"
_ANY_UNSPACED = re.compile("[\u0e00-\U0003ffff]")
_WORD = re.compile(r"\w+")
_WORD_OR_CHARACTER = re.compile(rf"[^\W{_UNSPACED}]+|(?=\w)[{_UNSPACED}]")


def words(text: str) -> list[str]:
    """Runs of word characters; in scripts without spaces each character is a word."""
    text = text.lower()
    return (_WORD if text.isascii() or not _ANY_UNSPACED.search(text) else _WORD_OR_CHARACTER).findall(text)


@dataclass
class Index:
    """Parts of items: whose they are, their words, where they begin in the item; and where each n-gram stands, with the number of documents that have it.

    ``owners`` numbers the items; ``shifted`` tells the parts that lie over two others. ``short`` has
    the items of fewer than ``LEAST_WORDS`` words, by their number of words and the words.
    """

    items: list = field(default_factory=list)
    owners: list[int] = field(default_factory=list)
    shifted: list[bool] = field(default_factory=list)
    parts: list[list[str]] = field(default_factory=list)
    offsets: list[int] = field(default_factory=list)
    places: dict[tuple, list[tuple[int, int]]] = field(default_factory=dict)
    counts: list[Counter] = field(default_factory=list)
    frequency: dict[tuple, int] = field(default_factory=dict)
    short: dict[int, dict[tuple, list[int]]] = field(default_factory=dict)


def parts_of(tokens: Sequence[str]) -> Iterator[tuple[int, list[str], bool]]:
    """An item in parts of even size; and those shifted by thirds, so that a passage of 0.6 of a part lies whole in one of them."""
    number = -(-len(tokens) // PART)
    for k in range(SHIFTS * (number - 1) + 1 if number else 0):
        start, stop = (len(tokens) * x // (SHIFTS * number) for x in (k, k + SHIFTS))
        yield start, list(tokens[start:stop]), k % SHIFTS > 0


def build(rows: Sequence[tuple]) -> Index:
    """An index of items, ``(item_id, text)``, with all their n-grams."""
    index = Index()
    for owner, (item, text) in enumerate(rows):
        tokens = words(text or "")
        whole = len(tokens) < LEAST_WORDS
        if whole and tokens:
            index.short.setdefault(len(tokens), {}).setdefault(tuple(tokens), []).append(len(index.parts))
        for start, part, shifted in parts_of(tokens):
            number = len(index.parts)
            index.items.append(item)
            index.owners.append(owner)
            index.shifted.append(shifted)
            index.parts.append(part)
            index.offsets.append(start)
            index.counts.append(Counter(part))
            for k, gram in enumerate(zip(*(part[j:] for j in range(SEED)))) if not whole else ():
                index.places.setdefault(gram, []).append((number, k))
    return index


def align(item: Sequence[str], text: Sequence[str]) -> tuple[int, int, int]:
    """The best local alignment: its score, and where it begins and ends in the text."""
    names: dict[str, int] = {}
    a = np.array([names.setdefault(w, len(names)) for w in item])
    b = np.array([names.setdefault(w, len(names)) for w in text])
    steps = np.arange(len(b) + 1, dtype=np.int32) * -GAP
    table = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    for i, word in enumerate(a, 1):
        above = table[i - 1]
        row = np.maximum(above + GAP, 0)
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(b == word, MATCH, MISMATCH))
        # A gap along the row: the best cell to the left, less a gap for each step.
        table[i] = np.maximum.accumulate(row + steps) - steps
    i, j = np.unravel_index(table.argmax(), table.shape)
    score, end = int(table[i, j]), int(j)
    while table[i, j] > 0:
        if i and j and table[i, j] == table[i - 1, j - 1] + (MATCH if a[i - 1] == b[j - 1] else MISMATCH):
            i, j = i - 1, j - 1
        elif i and table[i, j] == table[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return score, int(j), end


def _passages(index: Index, number: int, tokens: list[str], found: list[tuple[int, int, int]]) -> Iterator[tuple[float, int, int]]:
    """Passages of a text that copy one part, by its seeds in the text (``frequency, at, k``), the rarest first; no two overlap."""
    part, counts = index.parts[number], index.counts[number]
    # With all its words a part may have so many others put in, and a seed at its end all of them before it.
    slack, least = int(MATCH * (1 - SCORE) / -GAP * len(part)) + 1, SCORE * MATCH * len(part)
    hits = np.array(found)
    low = np.maximum(hits[:, 1] - hits[:, 2] - slack, 0)
    high = np.minimum(hits[:, 1] - hits[:, 2] + len(part) + slack, len(tokens))
    # No alignment scores more than the words of its window that the part has.
    begin, end = int(low.min()), int(high.max())
    own = np.concatenate([[0], np.cumsum(np.fromiter(map(counts.__contains__, tokens[begin:end]), np.int64, end - begin))])
    taken: list[tuple[int, int]] = []
    failed: list[tuple[int, int]] = []
    open_ = np.flatnonzero(MATCH * (own[high - begin] - own[low - begin]) >= least)
    for x in open_[np.lexsort((hits[open_, 1], hits[open_, 0]))]:
        at = int(hits[x, 1])
        # What the window finds may be another copy beside the seed's; then the rest is tried.
        while not any(first <= at < last for first, last in taken):
            floor, ceiling = max([0, *(last for _, last in taken if last <= at)]), min([len(tokens), *(first for first, _ in taken if first > at)])
            start, stop = max(int(low[x]), floor), min(int(high[x]), ceiling)
            if MATCH * (own[stop - begin] - own[start - begin]) < least or any(a <= start and stop <= b for a, b in failed):
                break
            window = tokens[start:stop]
            # Nor more than the words both have, each as often.
            score, first, last = align(part, window) if MATCH * sum((counts & Counter(window)).values()) >= least else (0, 0, 0)
            if score < least:
                failed.append((start, stop))
                break
            # A passage at the window's edge may go on beyond it.
            while first == 0 and start > floor or start + last == stop < ceiling:
                start, stop = max(floor, start - slack) if first == 0 else start, min(ceiling, stop + slack) if start + last == stop else stop
                score, first, last = align(part, tokens[start:stop])
            taken.append((start + first, start + last))
            yield score / (MATCH * len(part)), start + first, start + last


def copies(index: Index, text: str | None) -> Iterator[tuple[int, float, int, int]]:
    """Passages of a text that copy parts of items: the part, the share of its highest score, first and last word (exclusive)."""
    tokens = words(text or "")
    hits: dict[int, list[tuple[int, int, int]]] = {}
    places, frequency = index.places, index.frequency
    for at, gram in enumerate(zip(*(tokens[j:] for j in range(SEED)))):
        if gram in places:
            rarity = frequency.get(gram, 0)
            for number, k in places[gram]:
                hits.setdefault(number, []).append((rarity, at, k))
    for size, short in index.short.items():
        free: dict[tuple, int] = {}
        for at, gram in enumerate(zip(*(tokens[j:] for j in range(size)))):
            if gram in short and at >= free.get(gram, 0):
                free[gram] = at + size
                for number in short[gram]:
                    yield number, 1.0, at, at + size
    told: dict[int, list[tuple[int, int]]] = {}
    for number in sorted(hits, key=lambda n: index.shifted[n]):
        for score, first, last in _passages(index, number, tokens, hits[number]):
            others = told.setdefault(index.owners[number], [])
            # What a shifted part finds is news only where the item has no passage yet.
            if not (index.shifted[number] and any(first < b and a < last for a, b in others)):
                others.append((first, last))
                yield number, score, first, last


def _blocks(benchmark: DataFrame, item_column: str, text_column: str) -> Iterator[Index]:
    """Indexes of the items in blocks of about ``BLOCK_BYTES``; one block is on the driver at a time."""
    rows = benchmark.select(F.col(item_column).alias("item"), F.col(text_column).cast("string").alias("text")).where("text IS NOT NULL")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    number = max(1, -(-size // BLOCK_BYTES))
    for k in range(number):
        block = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(number)) == k) if number > 1 else rows
        index = build(sorted(((r[0], r[1]) for r in block.collect()), key=lambda r: (r[0] is None, r[0], r[1])))
        if index.parts:
            yield index


def _seeds(docs: DataFrame, text_column: str, index: Index) -> Index:
    """The index with the number of documents, of all there are, that have each n-gram of the block.

    All n-grams are seeds; rarity only orders them.
    """
    grams = {gram: number for number, gram in enumerate(index.places)}
    shared = docs.sparkSession.sparkContext.broadcast(grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = shared.value, Counter()
        for batch in batches:
            for text in batch.column(0):
                tokens = words(text.as_py() or "")
                total.update(set(filter(own.__contains__, zip(*(tokens[j:] for j in range(SEED))))))
        yield pa.RecordBatch.from_arrays([pa.array([own[g] for g in total], pa.int64()), pa.array(list(total.values()), pa.int64())], ["gram", "n"])

    counted = docs.select(F.col(text_column).cast("string")).mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    names = list(grams)
    index.frequency = {names[r["gram"]]: r["n"] for r in counted}
    shared.unpersist()
    return index


def matches(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row for each passage that copies an item: ``doc_id, item_id, score, first_word, last_word, item_word``.

    ``score`` is the alignment's share of the highest, 0.6 or more; words count from 0, ``last_word``
    is exclusive, ``item_word`` is where the part of the item begins. Items of over 128 words are cut
    into parts of even size; parts shifted by thirds tell passages where those tell none. The n-grams of a block of items
    are counted over all documents; then each document is scanned where it lies. Neither side is
    shuffled, so a document that many copy burdens no task. Items of fewer than 8 words match where all
    their words stand in order. In scripts without spaces each character is a word. Null and empty
    texts match nothing; items with equal texts each match; rows with equal or null ids
    are rows of their own; other columns don't matter; an empty table on either side gives no rows.
    """
    id_kind, item_kind = docs.schema[id_column].dataType.simpleString(), benchmark.schema[item_column].dataType.simpleString()
    schema = f"doc_id {id_kind}, item_id {item_kind}, score double, first_word bigint, last_word bigint, item_word bigint"
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    out = docs.sparkSession.createDataFrame([], schema)
    for index in _blocks(benchmark, item_column, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(_seeds(docs, text_column, index))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                found = [(k, *m) for k, text in enumerate(batch.column(1)) for m in copies(own, text.as_py())]
                if found:
                    row, number, score, first, last = zip(*found)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": batch.column(0).take(pa.array(row)), "item_id": [own.items[n] for n in number], "score": list(score), "first_word": list(first), "last_word": list(last),
                        "item_word": [own.offsets[n] for n in number]}, schema=pa.schema([
                            ("doc_id", batch.column(0).type), ("item_id", pa.array([own.items[0]]).type), ("score", pa.float64()), *((c, pa.int64()) for c in ("first_word", "last_word", "item_word"))]))

        out = out.union(rows.mapInArrow(run, schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that copy no item; see ``matches``."""
    kept = docs
    place = docs.columns.index(text_column)
    for index in _blocks(benchmark, item_column, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(_seeds(docs, text_column, index))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                yield batch.filter(pa.array([next(copies(own, text.as_py()), None) is None for text in batch.column(place)], pa.bool_()))

        kept = kept.mapInArrow(run, docs.schema)
    return kept
