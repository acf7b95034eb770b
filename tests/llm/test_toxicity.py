import random
import zlib

import fixtures as f
import numpy as np

from orebelt.llm import toxicity


def corpus(n=600):
    """A third of the texts has insults or words with one of two stems, the rest none."""
    pick = random.Random(4)
    texts, labels = [], []
    for i in range(n):
        words = f.prose(i, 40).split()
        label = int(i % 3 == 0)
        if label:
            for _ in range(3):
                bad = pick.choice(["idiot", "Moron!", "zzlor" + f.prose(pick.randint(1, 999), 1), "éqquv" + f.prose(pick.randint(1, 999), 1)])
                words.insert(pick.randint(0, len(words)), bad)
        texts.append(" ".join(words))
        labels.append((i, label))
    return texts, labels


def labels_of(spark, rows):
    return f.table(spark, rows, "doc_id bigint, toxic int")


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy(spark):
    texts, labels = corpus()
    got = {r.doc_id: r for r in toxicity.score_toxicity(f.documents(spark, texts), labels_of(spark, labels)).collect()}
    assert all(got[i].held_out == is_held_out(i) for i in got)
    assert all(got[i].predicted == int(got[i].score >= 0.7) and 0 <= got[i].score <= 1 for i in got)
    held = [(label, got[i].predicted) for i, label in labels if got[i].held_out]
    right = sum(a == b for a, b in held) / len(held)
    assert right > 0.97


def test_held_out_labels_change_nothing(spark):
    texts, labels = corpus(240)
    turned = [(i, 1 - label if is_held_out(i) else label) for i, label in labels]
    docs = f.documents(spark, texts)
    one = f.rows(toxicity.score_toxicity(docs, labels_of(spark, labels)))
    assert one == f.rows(toxicity.score_toxicity(docs, labels_of(spark, turned)))


def test_odd_rows_and_no_labels(spark):
    docs = f.documents(spark, [(1, None), (1, ""), (2, "what an idiot"), (None, "moron " * 5), (3, "fine words"), (3, "fine words")])
    for labels in ([], [(None, 1), (2, None), (3, 0), (3, 0)]):
        got = toxicity.score_toxicity(docs, labels_of(spark, labels)).collect()
        assert len(got) == 6
        assert {r.predicted for r in got if r.doc_id in (1, 3)} == {0}
        assert all(r.held_out is False for r in got if r.doc_id is None)
    kept = toxicity.drop_toxic(docs, labels_of(spark, [])).columns
    assert kept == docs.columns


def test_empty_table(spark):
    docs = f.documents(spark, []).limit(0)
    assert toxicity.score_toxicity(docs, labels_of(spark, [])).count() == 0
    assert toxicity.drop_toxic(docs, labels_of(spark, [])).count() == 0


def test_correlated_voters_share_their_evidence():
    pick = np.random.default_rng(1)
    y = pick.random(2000) < 0.3
    one = np.where(y, pick.random(2000) < 0.5, pick.random(2000) < 0.05)
    other = np.where(y, pick.random(2000) < 0.5, pick.random(2000) < 0.05)
    votes = np.stack([one, one, one, other], axis=1).astype(np.float32)
    label = np.where(pick.random(2000) < 0.5, y, -1)
    post, share = toxicity.label_model(toxicity.Ballots(votes, label, np.ones(2000)))
    assert share[0] < 0.4 < 0.6 < share[3]
    assert ((post > 0.5) == y)[label >= 0].mean() > 0.95


def test_stems_and_forms():
    import pyarrow as pa

    from orebelt.llm.text import chunks

    votes = toxicity.Votes(["idiot", "lowei*", "lowei* x2", "lowei* x3", "élan*", "idiot often"])
    texts = pa.array(["Idiot, loweiß LOWEIN", "lowei idiots", "Élans" + " x" * 500, None, "idiot" + " x" * 500])
    fired = [[] for _ in texts]
    for chunk in chunks(texts):
        for t, v in zip(*votes.fired(chunk)):
            fired[chunk.first + t].append(int(v))
    assert [sorted(x) for x in fired] == [[0, 1, 2, 5], [], [4], [], [0]]
