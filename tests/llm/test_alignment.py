import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given as examples
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewire.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


@pytest.fixture(scope="module")
def tokenizers():
    exact = Tokenizer.from_file(A)
    exact.encode_special_tokens = True
    return exact, sentencepiece.SentencePieceProcessor(model_file=B)


def ends(names):
    out, end = [], 0
    for name in names:
        end += len(name)
        out.append(end)
    return out


def plain(tokenizers, rows):
    """Groups and links by the ends of all tokens, without anchors or windows."""
    exact, model = tokenizers
    a_names, b_names = alignment.byte_level_bytes(A), alignment.piece_bytes(model)
    docs = []
    for doc_id, text in rows:
        a = exact.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if b"".join(a_names[i] for i in a) != whole or b"".join(b_names[i] for i in b) != whole:
            a, b = [], []
        a_ends, b_ends = ends([a_names[i] for i in a]), ends([b_names[i] for i in b])
        shared = sorted(set(a_ends) & set(b_ends))
        groups, start = [], 0
        for end in shared:
            own = [[str(i) for i, at in zip(*side) if start < at <= end] for side in ((a, a_ends), (b, b_ends))]
            groups.append("|".join(",".join(side) for side in own))
            start = end
        links = [(x, y) for x, at in zip(a, a_ends) for y, at_b in zip(b, b_ends) if at == at_b]
        docs.append((doc_id, len(a), len(b), groups, links))
    counts = Counter(link for doc in docs for link in doc[-1])
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [
        (
            doc_id, n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links),
            sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for doc_id, n_a, n_b, groups, links in docs
    ]


ROWS = [
    (1, None), (2, ""), (3, " "), (4, "Hello world, hello worlds"), (4, "Hello world, hello worlds"),
    (5, "a <|endoftext|> b <s> </s> <unk> <0x41>"), (6, "▁ is changed"), (7, "日本語 😀 \u0000 naïve  two  blanks\n\tx"),
    (None, "no id"), (8, "x" * 3000), (9, "long text of words " * 900), (10, "é ﬁ     ​"),
    (11, "\n"), (12, "word"),
]


def found(df):
    return sorted(map(tuple, df.select(*NAMES).collect()), key=repr)


def test_edge_rows_equal_a_plain_version(spark, documents, tokenizers):
    docs = documents(*[(i, text, "en") for i, text in ROWS])
    docs = docs.withColumnRenamed("n_chars", "links").withColumnRenamed("source", "pair")
    want = sorted(plain(tokenizers, ROWS), key=repr)
    assert found(alignment.align(docs, A, B)) == want
    assert {row[0] for row in want if row[1] == 0} >= {1, 2, 6}
    # More pairs than are sent to workers: the join gives the same.
    assert found(alignment.align(docs, A, B, max_pairs=0)) == want
    assert alignment.align(docs.limit(0), A, B).count() == 0


def test_given_documents_equal_a_plain_version(spark, sf_dir, tokenizers):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    few = docs.filter("n_chars < 6000").limit(150).cache()
    rows = [tuple(row) for row in few.select("doc_id", "text").collect()]
    assert found(alignment.align(few, A, B)) == sorted(plain(tokenizers, rows), key=repr)


def test_groups_and_links_as_text(spark, documents):
    row = alignment.alignments(documents((1, "Hello world", "en")), A, B).first()
    groups = [[side.split(",") for side in group.split("|")] for group in row["groups"].split(";")]
    assert [int(a[-1]) << 32 | int(b[-1]) for a, b in groups] == row["links"]
    assert sum(len(a) for a, _ in groups) == row["n_a"] and sum(len(b) for _, b in groups) == row["n_b"]


@settings(max_examples=150, deadline=None)
@examples(st.text(st.sampled_from("ab  \n.é日😀1▁<>'s"), max_size=60))
def test_windows_equal_shared_ends(text):
    aligner = _aligner()
    n_a, n_b, groups, links = aligner.align(text)
    found = aligner.ids(text)
    if found is None:
        assert (n_a, n_b, groups, len(links)) == (0, 0, "", 0)
        return
    a, ends_a, b, ends_b = found
    assert (n_a, n_b) == (len(a), len(b))
    shared = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    assert len(links) == len(shared) == groups.count(";") + 1
    assert aligner.groups(a, np.isin(ends_a, shared), b, np.isin(ends_b, shared))[0] == groups
    # The windows again, now remembered or not.
    assert aligner.align(text)[2] == groups


_kept = []


def _aligner():
    if not _kept:
        # A small memory: windows are dropped and computed again.
        _kept.append(alignment.Aligner(A, B, keep=5))
    return _kept[0]


def test_ids_equal_those_of_tokenizers(tokenizers):
    aligner = _aligner()
    points = [c for c in range(1, 0x30000, 11) if not 0xD800 <= c <= 0xDFFF]
    texts = [f" a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}2  {chr(c)}'s" for c in points] + [" <|endoftext|> x"]
    for text, want in zip(texts, tokenizers[0].encode_batch(texts, add_special_tokens=False)):
        assert aligner.encode(text).tolist() == want.ids


def test_another_encoder_where_the_fast_one_differs(monkeypatch):
    aligner = alignment.Aligner(A, B)
    aligner.check(" some text")
    assert aligner.encode == aligner._fast
    monkeypatch.setattr(aligner, "_fast", lambda text: aligner._exact(text)[:1])
    aligner.check(" some text")
    assert aligner.encode == aligner._exact
    assert aligner.align("some text")[0] == 2


def test_runs_of_look_ups(spark, documents, monkeypatch):
    """Rows with more links than a run, and runs that end between rows."""
    rows = [(i, "some words in a row " * (i % 5) * (40 if i == 7 else 1), "en") for i in range(40)]
    want = found(alignment.align(documents(*rows), A, B))
    monkeypatch.setattr(alignment, "BATCH_LINKS", 13)
    assert found(alignment.align(documents(*rows), A, B)) == want
    assert len(want) == 40


def test_bytes_of_the_fast_encoder_are_joined_no_more(monkeypatch):
    """Its tokens are parts of the text in order: their sizes tell whether all are there."""
    aligner, joined, join = alignment.Aligner(A, B), [], alignment._Bytes.joined
    monkeypatch.setattr(alignment._Bytes, "joined", lambda side, *given: joined.append(side) or join(side, *given))
    want = aligner.align("Hello worlds, 日本語")
    assert joined == [aligner.b]
    aligner.encode = aligner._exact
    assert [str(x) for x in aligner.align("Hello worlds, 日本語")] == [str(x) for x in want] and want[0]
    assert joined[1:] == [aligner.a, aligner.b]
    monkeypatch.setattr(aligner, "_fast", lambda text: aligner._exact(text)[:-1])
    aligner.encode = aligner._fast
    assert aligner.align("Hello worlds")[:3] == (0, 0, "")


@settings(max_examples=50, deadline=None)
@examples(st.lists(st.tuples(st.lists(st.integers(0, 50_000), max_size=3), st.lists(st.integers(0, 31_999), max_size=3)), min_size=1))
def test_names_of_groups(groups):
    """Ids of any number of digits, in groups of any sizes, as text."""
    aligner = _aligner()
    groups = [([*a, 7], [*b, 31_999]) for a, b in groups]
    sides = [np.array([i for group in groups for i in group[side]], np.uint32) for side in (0, 1)]
    lasts = [np.array([k == 1 for group in groups for k in range(len(group[side]), 0, -1)]) for side in (0, 1)]
    text, links = aligner.groups(sides[0], lasts[0], sides[1], lasts[1])
    assert text == ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)
    assert links.tolist() == [7 << 32 | 31_999] * len(groups)
