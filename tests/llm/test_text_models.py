"""Toxicity and the quality classifier: held-out accuracy, spans, edge rows."""

import zlib

import numpy as np

from starloom.llm import quality_classifier as qc
from starloom.llm import toxicity as tox
from starloom.llm.common import Memo

CLEAN = ["The river runs past the mill", "A quiet morning in the garden", "We read about the old harbour", "They painted the door green"]


def bags(rng, n):
    sample = []
    for i in range(n):
        sentences = [CLEAN[j] for j in rng.integers(0, len(CLEAN), rng.integers(2, 8))]
        if i % 2:
            sentences.insert(int(rng.integers(0, len(sentences))), f"The nastyword{rng.integers(0, 9)} runs past the garden")
        sample.append((". ".join(sentences) + ".", i % 2))
    return sample


def test_noisy_or_learns_from_document_labels_and_locates_sentences():
    rng = np.random.default_rng(1)
    model = tox.train(bags(rng, 200))
    memo = Memo(lambda w: float(sum(model.weights[i] for i in tox.word_features(w, len(model.weights)))))
    for text, y in bags(rng, 100):
        score, spans = tox.score_text(text, memo, model)
        assert (score >= 0.5) == bool(y)
        assert all("nastyword" in text[s["start"] : s["stop"]] for s in spans) and len(spans) == y
    unseen, _ = tox.score_text("An inflected nastywordish form appears", memo, model)
    assert unseen >= 0.5  # by its leading characters
    assert tox.score_text(" ".join(CLEAN) * 2000, memo, model)[0] < 0.01


def test_noisy_or_against_the_plain_product():
    model = tox.train(bags(np.random.default_rng(2), 100))
    word = lambda w: float(sum(model.weights[i] for i in tox.word_features(w, len(model.weights))))
    text = "You are a nastyword1 person. The river runs. A nastyword2 here"
    left, idle = 1.0, 1 / (1 + np.exp(-model.bias))
    for sentence in tox.SENTENCE.findall(text):
        p = 1 / (1 + np.exp(-model.bias - sum(map(word, sentence.split()))))
        left *= (1 - p) / (1 - idle)
    assert abs(tox.score_text(text, Memo(word), model)[0] - (1 - left)) < 1e-9


def test_one_label_only_calls_nothing_toxic():
    model = tox.train([("anything", 0)])
    assert tox.score_text("anything", Memo(lambda w: 0.0), model)[0] < 0.01


def test_toxicity_query(spark, documents, labels, edge):
    rows = tox.op2_toxicity(spark, documents, labels).collect()
    assert len(rows) == documents.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    model = tox.fit(documents, labels)
    got = tox.digest(tox.score_documents(edge, model)).collect()
    assert len(got) == 10 and all(r.score == 0 for r in got if r.doc_id in (2, 3, 4))
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert tox.score_documents(edge.limit(0), model).count() == 0
    assert tox.accepted(edge, model).columns == edge.columns
    assert tox.fit(documents, labels.limit(0)).bias == -12.0


def test_classifier_learns_words_subwords_and_repeats():
    rng = np.random.default_rng(3)
    words = ["river", "garden", "harbour", "morning", "window", "letter", "stone", "bread"]
    sample = []
    for i in range(400):
        w = [words[j] for j in rng.integers(0, len(words), 60)]
        if i % 4 == 1:
            w = [x + "$$$" for x in w]
        elif i % 4 == 3:
            w = [x for x in w[:6] for _ in range(10)]
        sample.append((" ".join(w), (i + 1) % 2))
    model = qc.train(sample[:300])
    scores = qc.WordScores(model).texts([t for t, _ in sample[300:]])
    assert np.mean([(s >= 0.5) == bool(y) for s, (_, y) in zip(scores, sample[300:], strict=True)]) > 0.95


def test_word_features_match_a_plain_loop():
    words = [b"a", "blé".encode(), b"garden"]
    bucket, owner = qc.features(words, 17)
    for i, w in enumerate(words):
        padded = "<" + w.decode() + ">"
        grams = sum(max(0, len(padded) - n + 1) for n in qc.GRAMS)
        assert (owner == i).sum() == 1 + grams
    alone, _ = qc.features([b"garden"], 17)
    assert sorted(alone) == sorted(bucket[owner == 2])


def plain_bucket(gram, bits):
    """The bucket of a character n-gram, letter by letter."""
    h = 0x811C9DC5 + len(gram)
    for c in gram:
        h = (h ^ ord(c)) * 16777619 % 2**32
    return h * 2654435769 % 2**32 >> 32 - bits


def test_scores_match_a_plain_loop():
    """Word and character n-gram buckets, their mean by word, the mean over words, and softmax."""
    rng = np.random.default_rng(9)
    words = ["river", "ünïçode", "日本語の文", "a", "stone$"]
    sample = [(" ".join(rng.choice(words[i % 2 :], 12)), i % 2) for i in range(60)]
    model = qc.train(sample, qc.Settings(bits=12, epochs=2))
    bits = len(model.scores).bit_length() - 1

    def score(text):
        total, found = 0.0, text.split()
        for w in found:
            buckets = [zlib.crc32(w.encode()) * 2654435769 % 2**32 >> 32 - bits]
            padded = f"<{w}>"
            buckets += [plain_bucket(padded[i : i + n], bits) for n in qc.GRAMS for i in range(len(padded) - n + 1)]
            total += sum(float(model.scores[b]) for b in buckets) / len(buckets)
        again = sum(a == b for a, b in zip(found, found[1:], strict=False))
        z = model.bias + (total + again * model.repeat) / max(1, len(found) + again)
        return 1 / (1 + np.exp(-z))

    texts = [t for t, _ in sample[:20]] + ["", "日本語の文 日本語の文 new", "new words 🙂"]
    assert np.allclose(qc.WordScores(model).texts(texts), [score(t) for t in texts], atol=1e-6)


def test_classifier_query(spark, documents, labels, edge):
    rows = qc.op5_quality_classifier(spark, documents, labels).collect()
    assert len(rows) == documents.count()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.8
    model = qc.fit(documents, labels)
    got = {r.doc_id: r.score for r in qc.score_documents(edge, model).collect()}
    assert got[2] == got[3] == got[4]  # no words: the bias alone
    assert qc.score_documents(edge.limit(0), model).count() == 0
