"""Alignment of the tokens of two tokenizers over a corpus.

Both tokenise each text whole. Where both have a token end and both go on with a token that begins
with a space, the text is cut into windows: short tuples of ids, most of them seen before, so that a
window's alignment is worked out once and then looked up. Within a window, offsets where tokens of
both end cut it into groups; the two tokens that end there are linked. How often two ids are linked
is counted over all texts.

Of two linked tokens the shorter one's bytes end the longer's. So the pairs that can be linked at
all follow from the vocabularies: each token has at most as many partners as it has bytes, and texts
with equal bytes. They are numbered once, and counts of them are a table of fixed size.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
from collections.abc import Callable, Iterable, Iterator, Sequence
from operator import add
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.bpe import LEAF, _byte_letters, _settled, breaks
from lexspark.llm.common import stash

#: Bytes of windows and their alignments that a worker remembers, besides those of the texts at hand.
MEMORY = 24 << 20

#: What stands between the packed ids of either tokenizer in a window's key; no id is as large.
BETWEEN = b"\xff" * 4


class Names(NamedTuple):
    """The byte-level tokenizer's file, its ranks and split pattern or nulls, and the piece model; ``place`` finds a file where a task runs."""

    json: str
    ranks: str | None
    pattern: str | None
    pieces: str
    place: Callable[[str], str] = str


class Spelling:
    """The bytes of a vocabulary's tokens."""

    def __init__(self, tokens: list[bytes]):
        if not all(tokens):
            raise ValueError("a token without bytes ends nowhere")
        self.tokens = tokens
        self.length = np.array([len(x) for x in tokens])
        self.space = np.array([x[:1] == b" " for x in tokens])
        self._flat, self._start = np.frombuffer(b"".join(tokens), np.uint8), self.length.cumsum() - self.length

    def write(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of tokens one after the other, and where each ends."""
        length = self.length[ids]
        ends = length.cumsum()
        return self._flat[np.arange(length.sum()) + (self._start[ids] - ends + length).repeat(length)], ends

    def spells(self, ids: np.ndarray, text: np.ndarray) -> bool:
        """Whether the bytes of the tokens are those of a text."""
        return self.length[ids].sum() == len(text) and np.array_equal(self.write(ids)[0], text)


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the pairs of tokens that can end together."""

    def __init__(self, names: Names):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(names.place(names.json))
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True
        self.fast = None
        if names.ranks and names.pattern:
            import tiktoken

            with open(names.place(names.ranks), "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("plain", pat_str=names.pattern, mergeable_ranks=ranks, special_tokens={})
        self.model = sentencepiece.SentencePieceProcessor(model_file=names.place(names.pieces))
        to_byte = {letter: b for b, letter in enumerate(_byte_letters())}
        self.a = Spelling([bytes(to_byte[c] for c in self.library.id_to_token(i)) for i in range(self.library.get_vocab_size())])
        self.b = Spelling([
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self.model.id_to_piece, range(self.model.get_piece_size())))])
        most = max(len(self.a.tokens), len(self.b.tokens))
        self._names = Spelling([f"{i},".encode() for i in range(most)])
        #: The number of each window that is known, its groups as text, and the pairs linked at their ends, packed; ``held`` bytes in all.
        self.memory: dict[bytes, int] = {}
        self.groups: list[bytes] = []
        self.links: list[bytes] = []
        self.held = 0

    @functools.cached_property
    def pairs(self) -> np.ndarray:
        """The ids of every two tokens of which one's bytes end the other's, sorted."""
        def by_bytes(own: list[bytes]) -> dict[bytes, list[int]]:
            out: dict[bytes, list[int]] = {}
            for i, x in enumerate(own):
                out.setdefault(x, []).append(i)
            return out

        a_of, b_of = by_bytes(self.a.tokens), by_bytes(self.b.tokens)
        found = [(a, b) for b, x in enumerate(self.b.tokens) for k in range(len(x)) for a in a_of.get(x[k:], ())]
        found += [(a, b) for a, x in enumerate(self.a.tokens) for k in range(1, len(x)) for b in b_of.get(x[k:], ())]
        return np.array(sorted(found), dtype=np.int64)

    @functools.cached_property
    def _codes(self) -> np.ndarray:
        return self.pairs[:, 0] * len(self.b.tokens) + self.pairs[:, 1]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a space and the text, by either tokenizer; the second adds the space itself."""
        a = []
        for part in breaks(" " + text, LEAF):
            if self.fast is not None and len(part) <= 4 * LEAF and _settled().issuperset(set(part)):
                a.append(self.fast.encode_to_numpy(part, disallowed_special=()).astype(np.uint32))
            else:
                a.append(np.array(self.library.encode(part, add_special_tokens=False).ids, np.uint32))
        return np.concatenate(a) if len(a) > 1 else a[0], np.array(self.model.encode(text), np.uint32)

    def cut(self, text: str) -> tuple[int, int, list[bytes]]:
        """How many tokens either has, and the windows in order; nothing if their bytes aren't the text's."""
        if not text:
            return 0, 0, []
        a, b = self.encode(text)
        whole = np.frombuffer(b" " + text.encode(), np.uint8)
        if not self.a.spells(a, whole) or not self.b.spells(b, whole):
            return 0, 0, []
        ends_a, ends_b = self.a.length[a].cumsum(), self.b.length[b].cumsum()
        # Ends before a token with a space, of both: there the windows are cut.
        shared = np.intersect1d(ends_a[:-1][self.a.space[a[1:]]], ends_b[:-1][self.b.space[b[1:]]], assume_unique=True)
        return len(a), len(b), list(map(
            add, _cut(a, ends_a.searchsorted(shared) + 1, BETWEEN), _cut(b, ends_b.searchsorted(shared) + 1)))

    def remember(self, keys: Iterable[bytes]) -> None:
        """Aligns the windows that aren't known yet, all at once."""
        new = [key for key in keys if key not in self.memory]
        if not new:
            return
        every = np.frombuffer(BETWEEN.join(new), np.uint32)
        between = every == np.uint32(0xFFFFFFFF)
        side = between.cumsum() % 2
        a, b = every[~between & (side == 0)], every[~between & (side == 1)]
        # Both sides of a window have as many bytes, so ends stay shared when windows follow each other.
        ends_a, ends_b = self.a.length[a].cumsum(), self.b.length[b].cumsum()
        shared, last_a, last_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        # In the text of the groups a token comes after its own kind before it, and after the other kind in groups before its own.
        place_a = np.arange(len(a)) + np.concatenate([[0], last_b + 1])[shared.searchsorted(ends_a)]
        place_b = np.arange(len(b)) + (last_a + 1)[shared.searchsorted(ends_b)]
        ids, mark = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        mark[place_a[last_a]], mark[place_b[last_b]] = ord("|"), ord(";")
        written, stops = self._names.write(ids)
        written[stops - 1] = mark
        pairs = self._codes.searchsorted(a[last_a].astype(np.int64) * len(self.b.tokens) + b[last_b]).astype(np.int32)
        stops_b = np.append(np.flatnonzero(between)[1::2], len(every))
        ends = (~between & (side == 1)).cumsum()[stops_b - 1] - 1
        text, at = written.tobytes(), stops[place_b[ends]].tolist()
        links, to = pairs.tobytes(), (4 * (last_b.searchsorted(ends) + 1)).tolist()
        self.memory.update(zip(new, range(len(self.groups), len(self.groups) + len(new))))
        self.groups += [text[i:k - 1] for i, k in zip([0, *at], at)]
        self.links += [links[i:k] for i, k in zip([0, *to], to)]
        self.held += 4 * len(every) + len(text) + len(links)

    def align(self, texts: Sequence[str]) -> list[tuple]:
        """For each text: tokens of either, links, the digest of its groups, its pairs as places in ``pairs``, and how often it has each."""
        cut = [self.cut(text) for text in texts]
        if self.held > MEMORY:
            self.memory, self.groups, self.links, self.held = {}, [], [], 0
        self.remember({key for _, _, own in cut for key in own})
        out = []
        for n_a, n_b, own in cut:
            at = [self.memory[key] for key in own]
            pairs, times = np.unique(np.frombuffer(b"".join([self.links[i] for i in at]), np.int32), return_counts=True)
            digest = hashlib.sha256(b";".join([self.groups[i] for i in at])).hexdigest() if at else ""
            links = int(times.sum())
            out.append((n_a, n_b, links, links, digest, pairs, times.astype(np.int32)))
        return out


def _cut(ids: np.ndarray, at: np.ndarray, end: bytes = b"") -> list[bytes]:
    packed, places = ids.tobytes(), (4 * at).tolist()
    return [packed[i:k] + end for i, k in zip([0, *places], [*places, len(packed)])]


@functools.cache
def vocabularies(names: Names) -> Vocabularies:
    """Both tokenizers once for all tasks of a worker."""
    return Vocabularies(names)


_ALIGNED = pa.schema([
    ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
    ("pairs", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))])


def tokens(docs: DataFrame, names: Names, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times`` for every row: its linked pairs by their numbers, and how often."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabularies(names)
        for batch in batches:
            for start in range(0, len(batch), 128):
                part = batch.slice(start, 128)
                made = own.align(part.column(1).to_pylist())
                columns = [pa.array([r[i] for r in made], field.type) for i, field in enumerate(_ALIGNED)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", *_ALIGNED.names])

    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<int>, times array<int>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, links``: how many links of all rows hold a pair."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    return each.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum(F.col("x.times").cast("long")).alias("links"))


def align(docs: DataFrame, names: Names, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row.

    The first tokenizer gets a space and the text, the second the text, to which it adds the space; names of
    special tokens are plain text. ``groups_sha256`` digests the groups as ``a1,a2|b1;a3|b2``. A pair's count is
    how many links of all rows hold it; ``count_sum`` adds them up over a row's links, ``n_best`` counts the links
    whose count is the highest of any pair with their second token, ties included. A text that is null, empty, or
    that the tokens of either don't spell has zeros and an empty digest. Rows equal in id or text stay rows of
    their own, whatever the id (null as well), and each counts; other columns don't matter; no rows give no rows.
    A text of any length is tokenised whole, by one task.
    """
    aligned = stash(tokens(docs, names, id_column, text_column), "align")
    own = vocabularies(names)
    # As many numbers as pairs can end together, whatever the corpus: less than a million for two vocabularies of this size.
    links = np.zeros(len(own.pairs), np.int64)
    counted = pair_counts(aligned).toArrow()
    links[counted["pair"].to_numpy()] = counted["links"].to_numpy()
    most = np.zeros(len(own.b.tokens), np.int64)
    np.maximum.at(most, own.pairs[:, 1], links)
    table = docs.sparkSession.sparkContext.broadcast((links, links == most[own.pairs[:, 1]]))
    kind = docs.schema[id_column].dataType.simpleString()
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = table.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times")
            at = pairs.flatten().to_numpy(zero_copy_only=False)
            n = times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum([0, *pairs.value_lengths().to_pylist()])

            def summed(values: np.ndarray) -> pa.Array:
                total = np.concatenate([[0], np.cumsum(values)])
                return pa.array(total[ends[1:]] - total[ends[:-1]], pa.int64())

            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), summed(n * best[at]), summed(n * count[at])], [*kept, "n_best", "count_sum"])

    return aligned.mapInArrow(
        run, f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint")
