"""Scoring words takes work that grows with the words and their letters, and gives what the sums over all subsequences give."""

import time
import tracemalloc

import numpy as np
import pytest

from skuflow.llm import toxicity


@pytest.fixture(scope="module")
def model():
    return toxicity.Model(np.random.default_rng(4).normal(size=toxicity.CODES**toxicity.ORDER), -0.5)


def test_words_of_all_lengths(model):
    words = [("subsequence" * 6)[n % 7:n % 7 + n] for n in range(3, 60)] + ["é" * 10, "é" * 11, "\U0001f600ab"]

    def slow(word):
        code, total = [ord(c) % toxicity.CODES for c in word], 0.0
        for i, j in toxicity.OFFSETS:
            for a in range(len(word) - j):
                k = (code[a] * toxicity.CODES + code[a + i]) * toxicity.CODES + code[a + j]
                total += toxicity.DECAY ** (j + 1) * model.weights[k]
        return total / toxicity._norms(np.array([len(word)]))[0] + model.bias

    want = [max(map(slow, toxicity._pieces(w))) for w in words]
    assert model.word_scores(words).tolist() == pytest.approx(want, rel=1e-9)


def test_short_words_take_small_arrays(model):
    words = [f"w{i:05d}" for i in range(1 << 14)]
    tracemalloc.start()
    model.word_scores(words)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < len(words) * 8 * 100 + 8 * toxicity.CODES**toxicity.ORDER


def test_texts_are_not_united_one_by_one(model):
    texts = [" ".join(f"w{k}x{i}" for i in range(100)) for k in range(1200)]
    known = {w: 0.0 for t in texts for w in t.split()}
    began = time.process_time()
    sets = [toxicity.text_words(t) for t in texts]
    apart = time.process_time() - began
    got = model.worst(texts, known)
    assert time.process_time() - began - apart < 8 * apart
    assert got == [(0.0, max(s)) for s in sets]
    assert model.worst([None, ""], known) == [(-0.5, "")] * 2
