"""Edit-aware counts against full recounts."""

import random

import public_tokenizers
import pytest

from starloom.llm import token_counts as tc
from starloom.llm.pieces import PieceIds, library_encoder

DEFINITION = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def count():
    with open(DEFINITION, "rb") as f:
        ids = PieceIds(library_encoder(f.read(), public_tokenizers.PATTERN))
    return lambda strings: [len(x) // 4 for x in ids.ids(strings)]


@pytest.fixture(scope="module")
def full():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(DEFINITION)
    tokenizer.encode_special_tokens = True
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def words(rng, n):
    return "".join(rng.choice(["the", " a", " blé", "\n", "  ", " 12", ".", "'s", " x", "\t", "　", " don't"]) for _ in range(n))


def test_edits_match_a_recount(count, full):
    rng = random.Random(5)
    for _ in range(150):
        text = words(rng, rng.choice([0, 1, 30, 600]))
        parts = tc.leaf_texts(text)
        assert "".join(parts) == text
        tree = tc.Tree.build([len(p) for p in parts], count(parts))
        assert tree.total == full(text)
        for _ in range(4):
            edits = []
            for _ in range(rng.randint(1, 4)):
                a = rng.randint(-1, len(text) + 2)
                edits.append((a, a + rng.choice([0, 0, 1, 5, 60]), words(rng, rng.choice([0, 1, 8]))))
            text, tree, _ = tc.edited(text, tree, edits, count)
            assert tree.total == full(text)
            assert sum(tree.chars[tree.size :]) == len(text)
            assert tree.tokens[1] == sum(tree.tokens[tree.size :])


def test_small_edit_encodes_a_small_region(count):
    text = " ".join(["word"] * 20_000)
    parts = tc.leaf_texts(text)
    tree = tc.Tree.build([len(p) for p in parts], count(parts))
    _, after, again = tc.edited(text, tree, [(50_000, 50_004, "other")], count)
    assert again < 1000
    assert after.total == 20_000


def test_query_on_edge_rows(spark, full):
    text = "mail me: a.b@c.org\nsame line\nsame line\n+49 170 1234567"
    rows = [(1, text, 7), (1, text, 7), (2, None, 7), (None, "", 7), (3, "plain", 7), (4, "a b " * 30_000, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = tc.op1_token_counts(spark, docs, DEFINITION, public_tokenizers.PATTERN).collect()
    assert len(out) == 6
    got = {r.doc_id: r for r in out}
    assert got[1].n_edits == 3 and got[1].n_tokens == full("mail me: <mail>\nsame line\n<number>")
    assert got[1].tokens_before == full(text)
    assert got[2].n_tokens == got[None].n_tokens == 0 and got[3].n_tokens == full("plain")
    assert got[4].n_tokens == full("a b " * 30_000) and got[4].reencoded == 0
    assert tc.op1_token_counts(spark, docs.limit(0), DEFINITION, public_tokenizers.PATTERN).count() == 0


def test_edit_log_join(spark, full):
    docs = spark.createDataFrame([(1, "one two three"), (2, "four")], "doc_id long, text string")
    log = spark.createDataFrame([(1, 4, 7, "2"), (1, None, 7, "x"), (9, 0, 1, "y"), (1, 0, 3, None)], "doc_id long, start long, stop long, insert string")
    state = tc.attach_edits(tc.with_trees(docs, DEFINITION, public_tokenizers.PATTERN), log)
    got = {r.doc_id: r for r in tc.apply_edits(state, DEFINITION, public_tokenizers.PATTERN).collect()}
    assert got[1].text == " 2 three" and got[1].n_tokens == full(" 2 three") and got[1].n_edits == 2
    assert got[2].text == "four" and got[2].n_edits == 0
