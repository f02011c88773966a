"""Alignment of two tokenizers' ids over one text, by whitespace-token anchors.

A text is tokenised whole by both tokenizers. An anchor is a byte offset at which a token
of each ends and before which the next token of each is marked with a space. Anchors cut
the two id lists into windows, mostly a word each; a window's alignment follows from its
ids alone, so it is computed once and looked up by the pair of id tuples from then on.
Within a window, tokens that end together close a group and are linked.

Links of all documents are written once, as a list for each document. An id pair's count
and whether it is the best of its second id follow by aggregation; documents read both
from a sorted array while there are at most ``PAIRS`` different pairs, and beyond that by
a join, with the same result.

Defined results
- A text that is null or empty, or whose token bytes of either tokenizer are not the bytes
  of a space and the text, has no tokens: counts are 0 and ``groups_sha256`` is ''.
- Strings of special tokens in a text are plain text.
- Repeated rows are documents of their own, and each adds to the counts.
- All pairs with the highest count of a second id are best.
- A text of any length is tokenised whole by one task; an empty table gives no rows.
- Other columns of the input, whatever their names, take no part.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import skewed_join, written
from tidewire.session import run_folder

# Different id pairs whose counts are sent to every worker: 34 MB.
PAIRS = 1 << 21
# Windows a task remembers before it starts anew, and the most ids of one that is
# remembered; links in a batch of rows.
KEEP_WINDOWS = 300_000
KEEP_IDS = 64
BATCH_LINKS = 500_000
# Marks ids of the second tokenizer in a window.
_SECOND = np.uint32(1 << 31)
# Fixed: the word pattern of byte-level BPE.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups string, links array<bigint>"
DIGEST = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links array<bigint>"
SCORED = """doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint,
count_sum bigint, groups_sha256 string"""


def byte_level_bytes(vocabulary: str) -> list[bytes]:
    """Bytes of every id of a byte-level BPE file."""
    with open(vocabulary, encoding="utf-8") as file:
        spec = json.load(file)
    # Fixed: printable bytes stand for themselves, the others are written from U+0100 on, in order.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [byte for byte in range(256) if byte not in plain]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    names = {i: bytes(letters[c] for c in word) for word, i in spec["model"]["vocab"].items()}
    names |= {token["id"]: token["content"].encode() for token in spec["added_tokens"]}
    return [names.get(i, b"") for i in range(max(names) + 1)]


def piece_bytes(model) -> list[bytes]:
    """Bytes of every id of a sentencepiece model."""
    return [
        bytes([int(model.id_to_piece(i)[3:5], 16)])
        if model.is_byte(i)
        else model.id_to_piece(i).replace("▁", " ").encode()
        for i in range(model.get_piece_size())
    ]


class _Bytes:
    """Bytes of ids: joined for a list of ids, and their ends."""

    def __init__(self, names: list[bytes]):
        self.flat = np.frombuffer(b"".join(names), np.uint8)
        self.lengths = np.array([len(name) for name in names], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.spaced = np.array([name[:1] == b" " for name in names])

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.lengths[ids])

    def joined(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        lengths = self.lengths[ids]
        return self.flat[np.repeat(self.starts[ids] - ends + lengths, lengths) + np.arange(ends[-1])]


def _among(at: np.ndarray, others: np.ndarray, size: int) -> np.ndarray:
    """Which offsets in ``at`` are in ``others`` too; all are below ``size``."""
    mark = np.zeros(size, bool)
    mark[others] = True
    return mark[at]


class Aligner:
    """Both tokenizers, and the windows met so far."""

    def __init__(self, vocabulary_a: str, model_b: str, keep: int = KEEP_WINDOWS):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(vocabulary_a)
        self.exact.encode_special_tokens = True
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_b)
        names = byte_level_bytes(vocabulary_a)
        added = set(self.exact.get_added_tokens_decoder())
        ranks = {name: i for i, name in enumerate(names) if name and i not in added}
        # The same merges, several times faster; the first text of every batch is compared.
        self.fast = tiktoken.Encoding("align", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a, self.b = _Bytes(names), _Bytes(piece_bytes(self.model))
        # An id within its side of a group, as the last of A's side, as the last of B's.
        self.width = max(len(self.a.lengths), len(self.b.lengths))
        # Names are padded to eight bytes, so that a text's names are one array. Fixed: ids below ten million.
        self.names = np.array([f"{i}{mark}" for mark in ",|;" for i in range(self.width)], "S8").view(np.uint64)
        self.encode = self._fast
        self.keep = keep
        self.windows: dict[bytes, bytes] = {}

    def _fast(self, text: str) -> np.ndarray:
        return self.fast.encode_to_numpy(text, disallowed_special=())

    def _exact(self, text: str) -> np.ndarray:
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)

    def check(self, text: str) -> None:
        """From the first text on which the fast encoder differs, the exact one is used."""
        if not np.array_equal(self._fast(text), self._exact(text)):
            self.encode = self._exact

    def ids(self, text: str | None) -> tuple[np.ndarray, ...] | None:
        """Ids of both tokenizers and their ends in bytes; None where one of them changes the text."""
        if not text:
            return None
        whole = " " + text
        plain = np.frombuffer(whole.encode(), np.uint8)
        # The fast encoder's tokens are parts of the text in their order, so none is missing if their sizes add up.
        in_order = self.encode == self._fast
        found = []
        for ids, table in ((self.encode(whole), self.a), (np.array(self.model.encode(text), np.uint32), self.b)):
            if not len(ids):
                return None
            ends = table.ends(ids)
            if ends[-1] != len(plain):
                return None
            if not (in_order and table is self.a) and not np.array_equal(table.joined(ids, ends), plain):
                return None
            found += [ids, ends]
        return tuple(found)

    def align(self, text: str | None) -> tuple[int, int, str, np.ndarray]:
        """(ids of A, ids of B, groups as text, links as a * 2^32 + b)."""
        found = self.ids(text)
        if found is None:
            return 0, 0, "", np.empty(0, np.int64)
        a, ends_a, b, ends_b = found
        both, ends, sizes, of_b = self.windows_of(a, ends_a, b, ends_b)
        last = self.look_up(both, ends, sizes, of_b)
        return len(a), len(b), *self.groups(a, last[~of_b], b, last[of_b])

    def windows_of(self, a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, ...]:
        """Window by window the ids of A, then those of B with a mark; their ends; the windows' sizes; which are of B."""
        size = ends_a[-1] + 1
        cut_a, cut_b = np.flatnonzero(self.a.spaced[a[1:]]), np.flatnonzero(self.b.spaced[b[1:]])
        at_a, at_b = ends_a[cut_a], ends_b[cut_b]
        # Anchors: the same number of either side, in the same order.
        cut_a, cut_b = cut_a[_among(at_a, at_b, size)] + 1, cut_b[_among(at_b, at_a, size)] + 1
        sizes = np.diff(np.stack([np.append(cut_a, len(a)), np.append(cut_b, len(b))], 1), axis=0, prepend=0)
        of_b = np.repeat(np.arange(sizes.size) % 2 == 1, sizes.ravel())
        both, ends = np.empty(len(of_b), np.uint32), np.empty(len(of_b), np.int64)
        both[~of_b], both[of_b] = a, b | _SECOND
        ends[~of_b], ends[of_b] = ends_a, ends_b
        return both, ends, sizes.sum(1), of_b

    def look_up(self, both: np.ndarray, ends: np.ndarray, sizes: np.ndarray, of_b: np.ndarray) -> np.ndarray:
        """For every id of the windows, whether its token ends a group.

        That follows from a window's ids, so it is computed for a window that is not
        remembered and looked up by the ids from then on.
        """
        windows, packed = self.windows, both.tobytes()
        bounds = [0, *(4 * np.cumsum(sizes)).tolist()]
        keys = [packed[start:end] for start, end in zip(bounds, bounds[1:])]
        found = list(map(windows.get, keys))
        if None in found:
            new = [i for i, known in enumerate(found) if known is None]
            is_new = np.zeros(len(keys), bool)
            is_new[new] = True
            own = np.repeat(is_new, sizes)
            at, second = ends[own], of_b[own]
            shared = np.empty(len(at), bool)
            shared[~second] = _among(at[~second], at[second], ends[-1] + 1)
            shared[second] = _among(at[second], at[~second], ends[-1] + 1)
            flags = shared.tobytes()
            if len(windows) + len(new) > self.keep:
                windows.clear()
            start = 0
            for i in new:
                key = keys[i]
                end = start + len(key) // 4
                found[i] = flags[start:end]
                if end - start <= KEEP_IDS and len(windows) < self.keep:
                    windows[key] = found[i]
                start = end
        return np.frombuffer(b"".join(found), bool)

    def groups(self, a: np.ndarray, last_a: np.ndarray, b: np.ndarray, last_b: np.ndarray) -> tuple[str, np.ndarray]:
        """Groups as text, and the links of the ids that end them."""
        of_a, of_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        size_a, size_b = np.bincount(of_a), np.bincount(of_b)
        names = np.empty(len(a) + len(b), np.int64)
        names[np.arange(len(a)) + (np.cumsum(size_b) - size_b)[of_a]] = a + self.width * last_a
        names[np.arange(len(b)) + np.cumsum(size_a)[of_b]] = b + 2 * self.width * last_b
        links = a[last_a].astype(np.int64) << 32 | b[last_b]
        return self.names[names].tobytes().translate(None, b"\0")[:-1].decode("ascii"), links


def _aligned(vocabulary_a: str, model_b: str, digest: bool):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(vocabulary_a, model_b)
        rows: list[tuple] = []
        links: list[np.ndarray] = []
        waiting = 0

        def out() -> pa.RecordBatch:
            ids, n_a, n_b, n_groups, groups = zip(*rows)
            offsets = np.cumsum([0, *map(len, links)]).astype(np.int32)
            columns = [pa.array(x, pa.int64()) for x in (ids, n_a, n_b, n_groups)]
            columns.append(pa.array(groups, pa.string()))
            columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(links))))
            names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256" if digest else "groups", "links"]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for at, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                text = text.as_py()
                if at == 0:
                    aligner.check(" " + (text or ""))
                n_a, n_b, groups, found = aligner.align(text)
                if digest and groups:
                    groups = hashlib.sha256(groups.encode()).hexdigest()
                # Every end of a group is a link, as tokens have at least a byte.
                rows.append((doc_id, n_a, n_b, len(found), groups))
                links.append(found)
                waiting += len(found) + 1
                if waiting > BATCH_LINKS:
                    yield out()
                    rows, links, waiting = [], [], 0
        if rows:
            yield out()

    return align


def alignments(
    docs: DataFrame,
    vocabulary_a: str,
    model_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups, links) of every row.

    ``groups`` is text like ``a1,a2|b1;a3|b2,b3``, or its checksum ``groups_sha256``; a link is a * 2^32 + b.
    """
    id_, text = F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`")
    given = docs.select(id_.alias("doc_id"), text.alias("text"))
    return given.mapInArrow(_aligned(vocabulary_a, model_b, digest), DIGEST if digest else ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): how often an id pair is linked, and whether no pair of its second id is linked more."""
    counts = aligned.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    other = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(other)).alias("best"))


def _looked_up(pairs):
    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = pairs.value
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        for batch in batches:
            offsets = batch.column("links").offsets.to_numpy()
            values = batch.column("links").values.to_numpy()
            # Rows in runs of about BATCH_LINKS links, so that a run's look-ups stay small.
            run = (offsets[:-1] - offsets[0]) // BATCH_LINKS
            starts = np.r_[np.flatnonzero(np.diff(run, prepend=-1)), len(run)]
            sums = np.zeros((2, len(run)), np.int64)
            for i, k in zip(starts, starts[1:]):
                own = offsets[i : k + 1]
                at = np.searchsorted(keys, values[own[0] : own[-1]])
                for row, of in zip(sums, (best, counts)):
                    total = np.r_[0, np.cumsum(of[at], dtype=np.int64)][own - own[0]]
                    row[i:k] = np.diff(total)
            first = batch.select(["doc_id", "n_a", "n_b", "n_groups"]).columns
            more = [pa.array(x.astype(np.int64)) for x in (np.diff(offsets), *sums)]
            yield pa.RecordBatch.from_arrays([*first, *more, batch.column("groups_sha256")], names=names)

    return look_up


def _joined(aligned: DataFrame, pairs: DataFrame) -> DataFrame:
    """The same as ``_looked_up``, for any number of pairs. ``row`` numbers the rows of the written table."""
    given = aligned.withColumn("row", F.monotonically_increasing_id())
    held = given.select("row", F.explode("links").alias("pair")).groupBy("row", "pair").agg(F.count("*").alias("m"))
    sums = (
        skewed_join(held, pairs, ["pair"], "inner")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("n_best"),
            F.sum(F.col("m") * F.col("n")).alias("count_sum"),
        )
    )
    zero = F.lit(0).cast("bigint")
    return given.join(sums, "row", "left").select(
        *["doc_id", "n_a", "n_b", "n_groups", F.size("links").cast("bigint").alias("n_links")],
        *[F.coalesce(name, zero).alias(name) for name in ("n_best", "count_sum")],
        "groups_sha256",
    )


def align(
    docs: DataFrame,
    vocabulary_a: str,
    model_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_pairs: int = PAIRS,
) -> DataFrame:
    """One row of figures for each document: tokens, groups, links, and how usual its links are."""
    spark = docs.sparkSession
    folder = run_folder(spark, "aligned")
    found = alignments(docs, vocabulary_a, model_b, id_col, text_col, digest=True)
    found.write.option("compression", "zstd").parquet(folder)
    aligned = spark.read.schema(found.schema).parquet(folder)
    pairs = written(pair_counts(aligned), "pairs")
    if pairs.count() > max_pairs:
        return _joined(aligned, pairs)
    table = pairs.toArrow()
    keys, counts, best = (table[name].to_numpy() for name in ("pair", "n", "best"))
    order = np.argsort(keys)
    shared = spark.sparkContext.broadcast((keys[order], counts[order], best[order]))
    return aligned.mapInArrow(_looked_up(shared), SCORED)
