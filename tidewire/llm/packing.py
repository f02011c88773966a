"""Packing documents into token sequences: shortest-pack-first over the length histogram.

A document is cut into full sequences and a rest. Pieces are computed once, with
their lengths and checksums, and written to the shared folder; ids are not kept.
The histogram of piece lengths has at most ``size`` rows whatever the input, so the
packing itself is a small computation: lengths are placed longest first, each into
the shortest packs with room, by counts of packing patterns and not piece by piece.
Patterns come back to the pieces by rank: the n-th piece of a length takes the n-th
place that the patterns have for it. A piece's rank is its number among the pieces of
its length in the task that cut it, which the task counts and writes down with it,
plus the pieces of that length from earlier tasks. So no length is ever sorted or
gathered as a whole, however many pieces have it.

Defined results
- A null or empty text is the one token ``end_id``.
- Strings of added tokens in a text, such as special ones, are those tokens.
- Repeated rows are documents of their own; pieces equal in every column may swap places.
- Sequences have at most ``size`` tokens, offsets run from 0 without gaps.
- An empty table gives no rows. A text of any length is tokenised whole by one task.
- Other columns, whatever their names, take no part.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import written

SIZE = 2048
END_ID = 1

PIECES = """doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,
part int, nth bigint"""
PLACED = """doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,
sequence_id bigint, offset bigint"""


def _encoder(vocabulary: str, check_chars: int = 400):
    """Function from a text to its ids under a byte-level BPE file of ``tokenizers``.

    ``tiktoken`` applies the same merges to the same words several times faster. Its
    ranks are read from the vocabulary file itself, where ids follow the merges, and
    the ids of every batch's first text are compared with those of ``tokenizers``.
    Strings of special tokens in a text are ordinary text here; ``_with_added`` has them.
    """
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(vocabulary)
    exact.encode_special_tokens = True
    with open(vocabulary, encoding="utf-8") as file:
        spec = json.load(file)
    special = {token["content"] for token in spec["added_tokens"] if token["special"]}
    # Fixed: the byte-level alphabet writes printable bytes as themselves and the
    # others as the characters from U+0100 on, in order.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [byte for byte in range(256) if byte not in plain]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    ranks = {
        bytes(letters[c] for c in word): rank
        for word, rank in spec["model"]["vocab"].items()
        if word not in special
    }
    # Fixed: the word pattern of byte-level BPE.
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    fast = tiktoken.Encoding("pack", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        return fast.encode_ordinary(text)

    def check(text: str) -> None:
        head = text[:check_chars]
        if encode(head) != exact.encode(head, add_special_tokens=False).ids:
            raise ValueError("tiktoken and tokenizers disagree on this vocabulary")

    return encode, check


def _with_added(vocabulary: str, encode):
    """``encode``, with texts that hold an added token of the file sent to ``tokenizers``."""
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(vocabulary)
    with open(vocabulary, encoding="utf-8") as file:
        added = [token["content"] for token in json.load(file)["added_tokens"]]

    def encode_all(text: str) -> list[int]:
        if any(token in text for token in added):
            return exact.encode(text, add_special_tokens=False).ids
        return encode(text)

    return encode_all


def _pieces(vocabulary: str, size: int, end_id: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, check = _encoder(vocabulary)
        encode = _with_added(vocabulary, encode)
        part = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        for batch in batches:
            rows = []
            for at, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                text = text.as_py() or ""
                if at == 0:
                    check(text)
                ids = np.array([*encode(text), end_id], "<u4")
                for start in range(0, len(ids), size):
                    own = ids[start : start + size]
                    crc = zlib.crc32(own.tobytes())
                    rows.append((doc_id, start, len(own), crc, len(ids), part, seen[len(own)]))
                    seen[len(own)] += 1
            if rows:
                kinds = [*[pa.int64()] * 5, pa.int32(), pa.int64()]
                columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return cut


def token_pieces(
    docs: DataFrame,
    vocabulary: str,
    size: int = SIZE,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every document's ids in pieces of at most ``size``; the last id is ``end_id``.

    ``nth`` counts the pieces of one length within a task, so the result has to be
    written once and read from there.
    """
    given = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return given.mapInArrow(_pieces(vocabulary, size, end_id), PIECES)


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, tuple]]:
    """(packs, ((length, pieces), ...)) from counts of lengths: shortest-pack-first.

    Lengths go longest first into the shortest pack that has room; where none has,
    new packs are filled with the same length, as the newest pack is then the
    shortest. Packs alike in content move together, so the work follows the number
    of lengths and not of pieces; there are at most three patterns per length.
    """
    packs: dict[int, list[tuple[int, tuple]]] = defaultdict(list)
    fills: list[int] = []

    def add(count: int, content: tuple) -> None:
        if count:
            fill = sum(length * pieces for length, pieces in content)
            if not packs[fill]:
                heapq.heappush(fills, fill)
            packs[fill].append((count, content))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while fills and not packs[fills[0]]:
                heapq.heappop(fills)
            if fills and fills[0] + length <= size:
                count, content = packs[fills[0]].pop()
                used = min(count, left)
                if used < count:
                    packs[fills[0]].append((count - used, content))
                *before, (last, pieces) = content
                same = ((last, pieces + 1),) if last == length else ((last, pieces), (length, 1))
                add(used, (*before, *same))
                left -= used
            else:
                full, rest = divmod(left, size // length)
                add(full, ((length, size // length),))
                add(1 if rest else 0, ((length, rest),))
                left = 0
    return [pack for fill in sorted(packs) for pack in packs[fill]]


def _places(packs: list[tuple[int, tuple]]) -> np.ndarray:
    """Rows (length, first rank, pieces a pack, first sequence, offset), by length and rank."""
    rows, sequence, ranks = [], 0, Counter()
    for count, content in packs:
        offset = 0
        for length, pieces in content:
            rows.append((length, ranks[length], pieces, sequence, offset))
            ranks[length] += count * pieces
            offset += length * pieces
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _placed(places: np.ndarray):
    # A key for (length, rank); lengths are bounded by the sequence size.
    starts = (places[:, 0] << 48) + places[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank, length = (batch[name].to_numpy() for name in ("rank", "length"))
            own = places[np.searchsorted(starts, (length << 48) + rank, side="right") - 1]
            if not len(rank):
                continue
            packs, copy = np.divmod(rank - own[:, 1], own[:, 2])
            out = batch.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            out = out.append_column("sequence_id", pa.array(own[:, 3] + packs))
            yield out.append_column("offset", pa.array(own[:, 4] + copy * length))

    return place


def pack(
    docs: DataFrame,
    vocabulary: str,
    size: int = SIZE,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each piece: where it comes from, its checksum, its sequence and offset."""
    pieces = written(token_pieces(docs, vocabulary, size, end_id, id_col, text_col), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    # At most ``size`` rows.
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    places = _places(patterns({row["length"]: row["n"] for row in histogram}, size))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        "part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    ranked = pieces.join(before, ["part", "length"]).select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("before") + F.col("nth")).alias("rank"),
    )
    return ranked.mapInArrow(_placed(places), PLACED)
