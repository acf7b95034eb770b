import math
from collections import Counter

import fixtures as f
import pytest

from orebelt.llm import ngram_lm


def grams(words):
    return Counter(tuple(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))


def brute(texts, alpha):
    words = [[w.lower() for w in (t or "").split()] for t in texts]
    all_grams = Counter()
    for w in words:
        all_grams.update(grams(w))
    total = sum(map(len, words))
    for w in words:
        own, score = grams(w), 0.0
        count = lambda g: all_grams[g] - own[g]  # noqa: E731, B023
        for p in range(len(w)):
            back = 1.0
            for n in range(min(3, p + 1), 0, -1):
                g = tuple(w[p - n + 1 : p + 1])
                if count(g) > 0:
                    score += math.log(back * count(g) / (count(g[:-1]) if n > 1 else total - len(w)))
                    break
                back *= alpha
            else:
                score += math.log(back / max(1, total - len(w)))
        yield len(w), score


@pytest.mark.parametrize("alpha", [0.4, 0.1])
def test_against_brute_force(spark, alpha, monkeypatch):
    monkeypatch.setattr(ngram_lm, "BLOCK_BYTES", 256)
    monkeypatch.setattr(ngram_lm, "RANGE_BYTES", 128)
    base = "the cat sat on the mat and the dog sat on the cat"
    texts = [base, base.upper(), "the dog sat", "a", "", None, "  \t\n", f.prose(3, 30), f.prose(3, 12) + " the mat", "x " * 300]
    got = {r.doc_id: r for r in ngram_lm.score_texts(f.documents(spark, texts), alpha=alpha).collect()}
    for i, (n, score) in enumerate(brute(texts, alpha)):
        assert got[i].n_words == n
        assert got[i].log_score == pytest.approx(score, rel=1e-9, abs=1e-9)
        assert got[i].n_trigram + got[i].n_bigram + got[i].n_unigram + got[i].n_unseen == n
        assert (got[i].mean_log_score is None) == (n == 0)


def test_repeated_rows_know_each_other(spark):
    got = ngram_lm.score_texts(f.documents(spark, [(1, "p q r s"), (1, "p q r s"), (None, "z")])).collect()
    assert [r.n_trigram for r in got if r.doc_id == 1] == [2, 2]
    assert [r.n_unseen for r in got if r.doc_id is None] == [1]


def test_empty_table(spark):
    assert ngram_lm.score_texts(f.documents(spark, []).limit(0)).count() == 0
