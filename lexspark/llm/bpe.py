"""BPE encoding and decoding; long text without a break is encoded in halves that are joined exactly.

A text is cut first where white space follows something else: there the split pattern always
breaks, so the parts encode on their own. A part that stays long is cut by the split pattern, and a
piece of it that stays long is cut in halves down to leaves. Leaves of all texts are encoded by any
task; a pair of halves is joined by encoding a window of tokens around the join again, growing it
until its first and last token are those the two sides had. Every two neighbours then are tokens
that the merges keep apart, which makes the whole the encoding of the text.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import re
import sys
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a text that one task encodes alone.
LEAF = 1 << 16
#: Tokens on each side of a join that are encoded again at first.
WINDOW = 8


@functools.cache
def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else one from U+0100 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(spare)) for b in range(256)]


@functools.cache
def _settled() -> frozenset[str]:
    """Letters, digits and marks that are in Unicode since 3.2 with the class they have now, and plain ASCII.

    On these, all releases of the pattern engines split alike.
    """
    old = unicodedata.ucd_3_2_0
    kept = {chr(c) for c in range(0x20, 0x7F)} | {"\n", "\t", "\r"}
    for code in range(0xA1, min(sys.maxunicode, 0xFFFF)):
        letter = chr(code)
        kind = old.category(letter)
        if kind == unicodedata.category(letter) and kind[0] in "LNPSM":
            kept.add(letter)
    return frozenset(kept)


class Codec:
    """A byte-level BPE vocabulary; ``json_path`` is a tokenizers file, ``ranks_path`` the same vocabulary as ranks.

    Results are those of the tokenizers library. Where it is sure to agree, the rank form is used,
    which is several times faster.
    """

    def __init__(self, json_path: str, ranks_path: str | None = None, pattern: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(json_path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items() if t.content}
        self.fast = None
        if ranks_path and pattern:
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self.special)
        letters = _byte_letters()
        self.to_letters = {b: letters[b] for b in range(256)}
        self.to_byte = {c: b for b, c in self.to_letters.items()}

    def encode(self, text: str) -> Sequence[int]:
        """The ids of a text that is not cut."""
        if self.fast is not None and _settled().issuperset(set(text)):
            return self.fast.encode(text, allowed_special="all")
        return self.library.encode(text, add_special_tokens=False).ids

    def decode(self, ids: Sequence[int]) -> str:
        if self.fast is not None:
            try:
                return self.fast.decode_bytes(ids).decode("utf-8")
            except (UnicodeDecodeError, KeyError):
                pass
        return self.library.decode(ids, skip_special_tokens=False)

    def merge(self, letters: str) -> list[int]:
        """The ids of a piece that the pattern leaves whole, given in letters for its bytes."""
        return [t.id for t in self.library.model.tokenize(letters)]

    def letters_of(self, ids: Sequence[int]) -> str:
        return "".join(map(self.library.model.id_to_token, ids))

    def pieces(self, text: str) -> list[tuple[str, int | None]]:
        """What the pattern makes of a text, in letters for bytes; a special token comes with its id."""
        out: list[tuple[str, int | None]] = []
        names = sorted(self.special, key=len, reverse=True)
        for part in re.split("(" + "|".join(map(re.escape, names)) + ")", text) if names else [text]:
            if part in self.special:
                out.append((part, self.special[part]))
            elif part:
                out.extend((piece, None) for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(part))
        return out

    def join(self, left: list[int], right: list[int], window: int = WINDOW) -> list[int]:
        """The ids of two neighbouring parts of one piece, from the ids of the parts."""
        while left and right:
            a, b = max(0, len(left) - window), min(len(right), window)
            middle = self.merge(self.letters_of([*left[a:], *right[:b]]))
            if (a == 0 or middle[0] == left[a]) and (b == len(right) or middle[-1] == right[b - 1]):
                return [*left[:a], *middle, *right[b:]]
            window *= 2
        return [*left, *right]

    def tree(self, leaves: list[list[int]], window: int = WINDOW) -> list[int]:
        """The ids of a piece from those of its leaves, joined in pairs, and the pairs in pairs."""
        while len(leaves) > 1:
            leaves = [self.join(*leaves[i:i + 2], window) if i + 1 < len(leaves) else leaves[i] for i in range(0, len(leaves), 2)]
        return leaves[0] if leaves else []


@functools.cache
def codec(json_path: str, ranks_path: str | None = None, pattern: str | None = None) -> Codec:
    """One vocabulary for all tasks of a worker."""
    return Codec(json_path, ranks_path, pattern)


def breaks(text: str, leaf: int) -> Iterator[str]:
    """The text in parts of about ``leaf`` characters, cut only where white space follows something else."""
    start, space = 0, re.compile(r"(?<=[^\s\x1c-\x1f\x85])[ \t\n\r]")
    while len(text) - start > leaf:
        found = space.search(text, start + leaf)
        if not found:
            break
        yield text[start:found.start()]
        start = found.start()
    yield text[start:]


def halves(letters: str, leaf: int) -> list[str]:
    """A piece cut in halves, these again, down to at most ``leaf`` letters."""
    if len(letters) <= leaf:
        return [letters]
    middle = len(letters) // 2
    return [*halves(letters[:middle], leaf), *halves(letters[middle:], leaf)]


def _packed(ids: Sequence[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def _columns(kind: str, keep_ids: bool) -> tuple[str, pa.Schema]:
    ddl = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else "")
    names = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    return ddl, pa.schema(names + [("ids", pa.list_(pa.int32()))] * keep_ids)


def _row(ids: Sequence[int], decoded: str, keep_ids: bool) -> tuple:
    row = (len(ids), hashlib.sha256(_packed(ids)).hexdigest(), hashlib.sha256(decoded.encode("utf-8", "replace")).hexdigest())
    return row + (list(ids),) if keep_ids else row


def _batch(first: pa.Array, rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], field.type) for i, field in enumerate(schema)]
    return pa.RecordBatch.from_arrays([first, *columns], ["doc_id", *schema.names])


def encode(docs: DataFrame, vocabulary: tuple[str, str | None, str | None], id_column: str = "doc_id", text_column: str = "text",
           leaf: int = LEAF, keep_ids: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if kept, ``ids`` for every row.

    ``vocabulary`` is the place of the tokenizers file, and of the same vocabulary as ranks with its
    pattern or nulls. A null text counts as empty and has no tokens. Rows with equal ids or texts
    stay rows of their own, whatever their id (null as well); other columns of the input don't
    matter; no rows give no rows. Texts of over ``leaf`` characters are cut and spread over all tasks.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    ddl, schema = _columns(kind, keep_ids)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(*vocabulary)
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                made = []
                for text in part.column(1):
                    ids = own.encode(text.as_py())
                    made.append(_row(ids, own.decode(ids), keep_ids))
                yield _batch(part.column(0), made, schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The leaves of each text: whole text, or letters of a part of a piece; a special token has its id."""
        own = codec(*vocabulary)
        for batch in batches:
            for doc, key, text in zip(batch.column(0), batch.column(1), batch.column(2)):
                leaves: list[tuple[int, bool, str]] = []
                piece = 0
                for part in breaks(text.as_py(), leaf):
                    if len(part) <= 4 * leaf:
                        leaves.append((piece, False, part))
                        piece += 1
                        continue
                    for letters, special in own.pieces(part):
                        for half in halves(letters, leaf) if special is None else [letters]:
                            leaves.append((piece, special is None, half))
                        piece += 1
                for start in range(0, len(leaves), 64):
                    own_leaves = leaves[start:start + 64]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([doc.as_py()] * len(own_leaves), batch.column(0).type), pa.array([key.as_py()] * len(own_leaves), pa.int64()),
                        pa.array([len(leaves)] * len(own_leaves), pa.int64()), pa.array(range(start, start + len(own_leaves)), pa.int64()),
                        pa.array([x[0] for x in own_leaves], pa.int64()), pa.array([x[1] for x in own_leaves], pa.bool_()), pa.array([x[2] for x in own_leaves], pa.string()),
                    ], ["doc_id", "key", "n", "leaf", "piece", "merged", "text"])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(*vocabulary)
        for batch in batches:
            ids = [_packed(own.merge(t.as_py()) if m.as_py() else own.encode(t.as_py())) for m, t in zip(batch.column("merged"), batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(6)), pa.array(ids, pa.binary())], ["doc_id", "key", "n", "leaf", "piece", "merged", "ids"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts from their leaves, which come sorted; one text is held at a time."""
        own = codec(*vocabulary)
        open_: list[list[int]] = []
        piece, tail = None, []

        def close():
            nonlocal open_, tail
            tail.extend(own.tree(open_))
            open_ = []

        for batch in batches:
            for k, (doc, n, place, number, _, ids) in enumerate(zip(*(batch.column(i) for i in (0, 2, 3, 4, 5, 6)))):
                if piece is not None and number.as_py() != piece:
                    close()
                piece = number.as_py()
                open_.append(np.frombuffer(ids.as_py(), "<u4").tolist())
                if place.as_py() == n.as_py() - 1:
                    close()
                    row = _row(tail, own.decode(tail), keep_ids)
                    yield _batch(batch.column(0).slice(k, 1), [row], schema)
                    piece, tail = None, []

    small = rows.where(F.length("text") <= leaf).mapInArrow(short, ddl)
    long = rows.where(F.length("text") > leaf).select("doc_id", F.monotonically_increasing_id().alias("key"), "text")
    head = f"doc_id {kind}, key bigint, n bigint, leaf bigint, piece bigint, merged boolean"
    spread = long.mapInArrow(cut, f"{head}, text string").repartition("key", "leaf").mapInArrow(leaves, f"{head}, ids binary")
    large = spread.repartition("key").sortWithinPartitions("key", "leaf").mapInArrow(joined, ddl)
    return small.union(large)


def decode(encoded: DataFrame, vocabulary: tuple[str, str | None, str | None], ids_column: str = "ids", text_column: str = "text") -> DataFrame:
    """``encoded`` with the text of each row's ids in place of the ids; of null ids null, of none an empty text."""
    kept = [c for c in encoded.columns if c not in (ids_column, text_column)]
    schema = ", ".join([*(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in kept), f"`{text_column}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(*vocabulary)
        for batch in batches:
            texts = pa.array((None if ids.as_py() is None else own.decode(ids.as_py()) for ids in batch.column(len(kept))), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), texts], [*kept, text_column])

    return encoded.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{ids_column}`")).mapInArrow(run, schema)
