"""Byte-level BPE, packing and token files against the libraries and exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as pt
import pytest

from starloom.llm import byte_bpe, packing, pieces, token_files
from starloom.session import scratch_path

RANKS, DEFINITION, WORDS = pt.path("byte_bpe_multi_50k.tiktoken"), pt.path("byte_bpe_50k.json"), pt.path("word_bpe_49k.json")
ODD = ["", " ", "\n", "a ", " a", "a\n\nb", "a \n b", "x\ty", "it's 's 'll don't", "日本語 テスト", "\x85 a\xa0b", "a\x1cb", "é" * 300, "a" * 700, "ab" * 3000]


def odd_texts():
    rng = random.Random(11)
    return ODD + ["".join(rng.choice(" \n\t a bé'sLl1,. 　日!") for _ in range(rng.randint(0, 30))) for _ in range(800)]


@pytest.fixture(scope="module")
def ranks():
    with open(RANKS, "rb") as f:
        return byte_bpe.read_ranks(f.read())


def library(path, end=None):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda t: tokenizer.encode(t, add_special_tokens=False).ids + ([] if end is None else [end])


def test_byte_bpe_matches_tiktoken(ranks, texts):
    import tiktoken

    reference = tiktoken.Encoding("own", pat_str=pt.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = byte_bpe.Encoder(ranks, pt.PATTERN)
    every = odd_texts() + list(texts.values())
    got = pieces.PieceIds(encoder.strings).ids(every)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [reference.encode_ordinary(t) for t in every]
    assert [encoder.decode(g) for g in got] == [t.encode() for t in every]


def test_long_rows_agree_with_the_matrix(ranks):
    encoder = byte_bpe.Encoder(ranks, pt.PATTERN)
    rng = random.Random(4)
    tokens = [bytes(rng.choice(b"abcdetion ") for _ in range(rng.randint(2, 90))) for _ in range(200)]
    assert encoder.matrix(tokens, 96) == [encoder.by_heap(t) for t in tokens]


def test_pair_table(ranks):
    pairs = byte_bpe.PairTable(ranks)
    left, right = np.array([ranks[b"t"], ranks[b"t"], -1], np.int32), np.array([ranks[b"h"], ranks[b"\x00"], 5], np.int32)
    assert pairs.ranks(left, right)[0] == ranks[b"th"]
    assert pairs.ranks(left, right)[2] == byte_bpe.NONE


def test_byte_bpe_query(spark, edge):
    rows = byte_bpe.op3_byte_bpe(spark, edge, RANKS, pt.PATTERN).collect()
    source = [(r.doc_id, r.text or "") for r in edge.collect()]
    assert sorted((str(r.doc_id), r.decoded_sha256) for r in rows) == sorted((str(d), hashlib.sha256(t.encode()).hexdigest()) for d, t in source)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3)} == {0}
    assert byte_bpe.op3_byte_bpe(spark, edge.limit(0), RANKS, pt.PATTERN).count() == 0


def test_small_memos_change_nothing(texts):
    """Memos that forget all the time, in the ids and in packing's blocks."""
    with open(DEFINITION, "rb") as f:
        encode = pieces.library_encoder(f.read(), pt.PATTERN)
    small, large, every = pieces.PieceIds(encode, 30_000), pieces.PieceIds(encode), odd_texts() + list(texts.values())[:80]
    end = b"\0\0\0\0"
    for k in range(0, len(every), 20):
        part = every[k : k + 20]
        assert small.ids(part) == large.ids(part)
        blocks = [packing.read_block(list(range(len(part))), part, ids, end) for ids in (small, large)]
        assert [d.ids for d in blocks[0].documents] == [d.ids for d in blocks[1].documents]
        assert (blocks[0].at == blocks[1].at).all()
    assert len(small.after) < len(large.after)


@pytest.mark.parametrize("path", [DEFINITION, WORDS])
def test_pieces_match_the_library(path, texts):
    with open(path, "rb") as f:
        data = f.read()
    kinds = [pieces.PieceIds(pieces.library_encoder(data)), pieces.PieceIds(pieces.library_encoder(data, pt.PATTERN))]
    if pieces.drops_spaces(data):
        kinds.append(pieces.WordIds(data))
    every, reference = odd_texts() + list(texts.values()), library(path)
    expected = [reference(t) for t in every]
    for kind in kinds:
        assert [np.frombuffer(g, "<u4").tolist() for g in kind.ids(every)] == expected


def brute_cost(at, penalties, length):
    best = [0.0] + [float("inf")] * (len(at) - 1)
    for j in range(1, len(at)):
        for i in range(j):
            if at[j] - at[i] <= length:
                best[j] = min(best[j], best[i] + length - (at[j] - at[i]) + penalties[j])
    return best[-1]


def test_windows_are_optimal():
    rng = np.random.default_rng(6)
    for _ in range(60):
        at = np.concatenate([[0], np.cumsum(rng.integers(1, 9, 40))])
        penalties = rng.choice([0.0, 1.0, 6.0], len(at))
        ends = packing.windows(at, penalties, 20)
        stops = [0, *at[ends]]
        assert max(np.diff(stops)) <= 20 and stops[-1] == at[-1]
        cost = sum(20 - n for n in np.diff(stops)) + penalties[ends].sum()
        assert abs(cost - brute_cost(at, penalties, 20)) < 1e-9


def test_packing_keeps_every_id_once(spark, edge, documents, texts):
    reference = library(DEFINITION, 0)
    for frame in (documents, edge):
        source = [(r.doc_id, r.text or "") for r in frame.collect()]
        rows = packing.op8_packing(spark, frame, DEFINITION, pt.PATTERN).collect()
        assert sum(r.length for r in rows) == sum(len(reference(t)) for _, t in source)
        ids = {d: np.array(reference(t), "<u4") for d, t in source}
        fill = {}
        for r in rows:
            assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
            assert r.doc_tokens == len(ids[r.doc_id])
            fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in fill.values():
            at = 0
            for offset, n in sorted(parts):
                assert offset == at
                at += n
            assert at <= 1024
    assert packing.op8_packing(spark, edge.limit(0), DEFINITION, pt.PATTERN).count() == 0


def test_token_files_round_trip(spark, documents, texts, edge):
    reference = library(WORDS, 2)
    for frame in (documents, edge):
        source = sorted(((r.doc_id, r.text or "") for r in frame.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
        rows = token_files.op10_token_files(spark, frame, WORDS).collect()
        rows.sort(key=lambda r: r.start)
        assert [r.doc_id for r in rows] == [d for d, _ in source]
        start = 0
        for r in rows:
            assert r.start == start
            start += r.n_tokens
        expected = sorted((str(d), len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in ((d, reference(t)) for d, t in source))
        assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in rows) == expected
    assert token_files.op10_token_files(spark, edge.limit(0), WORDS).count() == 0


def test_short_document_access_and_dictionary_hash(spark, documents, texts):
    path = scratch_path(spark, "files")
    token_files.write_tokens(documents, path, WORDS, 2)
    wanted = [3, 77, 10**9]
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in token_files.read_tokens(spark, path, wanted).collect()}
    reference = library(WORDS, 2)
    assert got == {d: reference(texts[d]) for d in wanted if d in texts}
    stored = spark.read.parquet(f"{path}/dictionary").collect()[0]
    assert stored.hash == zlib.crc32(stored.data) and len(stored.data) > 0 and stored.width == 2
