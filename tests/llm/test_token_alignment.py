"""Token alignment against a plain loop over the two libraries' own ids."""

import hashlib
import itertools
from collections import Counter, defaultdict, deque

import numpy as np
import public_tokenizers as pt
import pytest

from starloom.llm import token_alignment as ta
from starloom.llm.pieces import byte_of_letter

A, B = pt.path("byte_bpe_50k.json"), pt.path("piece_bpe_32k.model")
ODD = [
    "", " ", "\n", "  a", " a", "a ", "a\n\nb", "a\nb c", "\na", "a \n b", "x\ty", "a  b   c", "it's 's 'll don't", "日本語 テスト",
    "\x85 a\xa0b", "é" * 300, "a" * 700, " " * 90, "<|endoftext|> <s> </s> <0x41>", "a▁b", "▁", "x ▁ y", "nul\x00here", "🙂🙃 ok", "๛ก็", "A.B.C... 1,234.5",
    "word " * 500, "ﷺ ﬁ x", " a　b",
]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = byte_of_letter()
    by_id = {i: t for t, i in a.get_vocab().items()}

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(text):
        """(id, bytes) of both sides, empty where they do not give the text back."""
        one = [(i, bytes(letters[c] for c in by_id[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
        two = [(i, bytes_b(i)) for i in b.encode(text)]
        whole = (" " + text).encode()
        if not text or any(b"".join(t for _, t in side) != whole for side in (one, two)):
            return [], []
        return one, two

    return tokens


def plain_groups(one, two):
    """[(A ids, B ids)] between common ends."""
    ends_a = list(itertools.accumulate(len(t) for _, t in one))
    ends_b = list(itertools.accumulate(len(t) for _, t in two))
    left, right = deque(zip([i for i, _ in one], ends_a, strict=True)), deque(zip([i for i, _ in two], ends_b, strict=True))
    out = []
    for end in sorted(set(ends_a) & set(ends_b)):
        group = ([], [])
        for side, found in zip((left, right), group, strict=True):
            while side and side[0][1] <= end:
                found.append(side.popleft()[0])
        out.append(group)
    return out


def plain(rows, tokens):
    docs = []
    for doc_id, text in rows:
        one, two = tokens(text or "")
        found = plain_groups(one, two)
        docs.append((doc_id, len(one), len(two), found, Counter(p for a, b in found for p in itertools.product(a, b))))
    held = Counter(p for d in docs for p in d[4])
    highest = defaultdict(int)
    for (a, _), n in held.items():
        highest[a] = max(highest[a], n)
    out = []
    for doc_id, n_a, n_b, found, linked in docs:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in found)
        out.append(
            (
                doc_id, n_a, n_b, len(found), sum(linked.values()), sum(n for p, n in linked.items() if held[p] == highest[p[0]]),
                sum(n * held[p] for p, n in linked.items()), hashlib.sha256(text.encode()).hexdigest() if found else "",
            )
        )
    return sorted(map(repr, out))


def run(spark, frame):
    return sorted(repr(tuple(r)) for r in ta.op13_token_alignment(spark, frame, A, B, pt.PATTERN).collect())


def test_whole_table(spark, documents, libraries):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert run(spark, documents) == plain(rows, libraries)


def test_odd_texts_in_small_blocks(spark, libraries, monkeypatch):
    """Blocks and batches of a few texts, dense groups, pairs expanded a few at a time."""
    rows = list(enumerate(ODD)) + [(3, None), (None, "a b"), (5, "a b"), (5, "a b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert run(spark, frame) == plain(rows, libraries)


def test_edges(spark, edge, libraries):
    """Nulls, repeated rows, a very long text and columns with the result's names."""
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert run(spark, edge) == plain(rows, libraries)
    assert ta.op13_token_alignment(spark, edge.limit(0), A, B, pt.PATTERN).count() == 0


def test_memos_that_start_again(libraries, texts, monkeypatch):
    """Both memos go back to the frequent pieces in step, and nothing changes."""
    monkeypatch.setattr(ta, "MEMO_BYTES", 20_000)
    contents = [open(p, "rb").read() for p in (A, B)]
    small, every = ta.Aligner(*contents, pt.PATTERN), ODD + list(texts.values())[:60] + ODD
    expected = ta.Aligner(*contents, pt.PATTERN)
    expected.a.budget = 10**9
    for k in range(0, len(every), 5):
        assert small.batch(every[k : k + 5])[0][4] == expected.batch(every[k : k + 5])[0][4]
    assert len(small.b.memo) < len(expected.b.memo)


def test_dense_groups_and_chunks(monkeypatch):
    monkeypatch.setattr(ta, "LINKS", 7)
    rng = np.random.default_rng(3)
    for dense in (0, 4, 64):
        monkeypatch.setattr(ta, "DENSE", dense)
        group_a, group_b = (np.sort(np.concatenate([np.arange(6), rng.integers(0, 6, n)])) for n in (40, 30))
        ids_a, ids_b = rng.integers(0, 5, len(group_a)), rng.integers(0, 4, len(group_b))
        doc = np.array([0, 0, 0, 2, 2, 3])
        expected = Counter()
        for g, a in zip(group_a, ids_a, strict=True):
            expected.update((int(doc[g]), int(a) << 32 | int(b)) for h, b in zip(group_b, ids_b, strict=True) if g == h)
        wide = ta.links(group_a, ids_a + 70_000, group_b, ids_b + 70_000, doc)
        assert sorted(wide[2].tolist()) == sorted(expected.values())
        found = ta.links(group_a, ids_a, group_b, ids_b, doc)
        assert dict(zip(zip(found[0].tolist(), found[1].tolist(), strict=True), found[2].tolist(), strict=True)) == expected


def test_batches_and_pieces_change_nothing(libraries):
    """Whole texts against the piece memo, and one batch against many."""
    contents = [open(p, "rb").read() for p in (A, B)]
    one, whole = ta.Aligner(*contents, pt.PATTERN), ta.Aligner(*contents, pt.PATTERN)
    whole.b.cuts = False
    together = one.batch(ODD)[0]
    assert all((x == y) if isinstance(x, list) else (x == y).all() for x, y in zip(together, whole.batch(ODD)[0], strict=True))
    single = [one.batch([t])[0] for t in ODD]
    assert together[4] == [s[4][0] for s in single]
    assert together[3].tolist() == [int(s[3][0]) for s in single]
