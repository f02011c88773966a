import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given as examples
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewire.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, texts, size):
    """Exact round trip: pieces cover each document's ids once, sequences have no gap."""
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for start in range(0, len(ids), size):
            part = ids[start : start + size]
            want[(doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    got = Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows)
    assert got == want
    sequences = defaultdict(list)
    for row in rows:
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    return len(sequences)


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = packing.pack(docs, PATH).collect()
    texts = [(row["doc_id"], row["text"]) for row in docs.select("doc_id", "text").collect()]
    sequences = check(rows, texts, packing.SIZE)
    assert sum(row["length"] for row in rows) >= 0.98 * sequences * packing.SIZE


def test_edge_rows(spark, documents):
    texts = [
        (1, None), (2, ""), (3, "word " * 7000), (None, "no id"), (4, "same"), (4, "same"), (5, "x" * 64),
        (6, "a <|endofxtext|> b"), (7, "日本語 😀 \u0000  "), *[(100 + i, "hot " * 63) for i in range(200)],
    ]
    docs = documents(*[(i, text, "en") for i, text in texts])
    docs = docs.withColumnRenamed("n_chars", "length").withColumnRenamed("source", "part")
    for size in (packing.SIZE, 64):
        check(packing.pack(docs, PATH, size=size).collect(), texts, size)
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_ids_equal_those_of_tokenizers():
    encode, check_text = packing._encoder(PATH)
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    points = [c for c in range(0, 0x30000, 7) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}2  {chr(c)}'s" for c in points] + ["<|endoftext|> x"]
    for text, exact in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert encode(text) == exact.ids
    check_text(texts[0])


@settings(max_examples=60, deadline=None)
@examples(st.dictionaries(st.integers(1, 32), st.integers(1, 5000), max_size=32))
def test_patterns_keep_every_piece(histogram):
    packs = packing.patterns(histogram, 32)
    placed = Counter()
    for count, content in packs:
        assert count > 0 and sum(length * pieces for length, pieces in content) <= 32
        for length, pieces in content:
            placed[length] += count * pieces
    assert placed == Counter(histogram)
    # Two packs at most half full would have been one.
    half = sum(count for count, content in packs if 2 * sum(a * b for a, b in content) <= 32)
    assert half <= 1


def test_short_pieces_fill_packs():
    assert sum(count for count, _ in packing.patterns({10: 100_000_000}, 2048)) == -(-100_000_000 // 204)


def test_added_tokens_are_those_of_tokenizers(spark, documents):
    tokenizer = Tokenizer.from_file(PATH)
    encode = packing._with_added(PATH, packing._encoder(PATH)[0])
    added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    texts = ["plain text", *[f"a {token} b{token}{token}\n {token}" for token in added]]
    assert added
    for text in texts:
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids
    rows = list(enumerate(texts))
    check(packing.pack(documents(*[(i, text, "en") for i, text in rows]), PATH).collect(), rows, packing.SIZE)
