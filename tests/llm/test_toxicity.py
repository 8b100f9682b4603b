from __future__ import annotations

import random

import numpy as np
import pytest

from chatlake.llm import toxicity as T
from chatlake.llm.common import table
from tests.llm.fixtures import TEXTS, documents

INSULTS = ["vrazzok", "plimfugue", "snorquet", "gubbwint"]
SYLLABLES = "an er on the re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de".split()


def corpus(rng, n):
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 80))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randrange(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = corpus(random.Random(1), 900)
    return T.fit([t for _, t, _ in rows], [y for *_, y in rows])


def test_separates_unseen_texts(model):
    rows = corpus(random.Random(2), 600)
    predicted = model.scores([t for _, t, _ in rows]) >= T.THRESHOLD
    labels = np.array([y for *_, y in rows]) == 1
    assert (predicted == labels).mean() > 0.99


def test_tolerates_gaps_and_inserted_characters(model):
    for insult in INSULTS:
        for text in (insult.upper(), insult + "!", ".".join(insult), " ".join(insult), insult[:4] + "-" + insult[4:], insult[:3] + insult[2:]):
            assert model.scores([f"the ended {text} and of"])[0] >= T.THRESHOLD, text


def test_tolerates_one_and_two_inserted_spaces(model):
    for insult in INSULTS:
        for cuts in ([3], [5], [2, 5], [3, 6]):
            text = " ".join(insult[a:b] for a, b in zip([0, *cuts], [*cuts, len(insult)]))
            assert model.scores([f"the ended {text} and of"])[0] >= T.THRESHOLD, text


def phrase_corpus(rng, n):
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 60))]
        toxic = i % 6 == 0
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = ["go", "to", "hell"]
        else:
            for x in rng.sample(["go", "to", "hell", "going to", "hello"], 2):
                words.insert(rng.randrange(len(words)), x)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_insult_of_ordinary_words():
    rows = phrase_corpus(random.Random(3), 600)
    model = T.fit([t for _, t, _ in rows], [y for *_, y in rows])
    rows = phrase_corpus(random.Random(4), 600)
    predicted = model.scores([t for _, t, _ in rows]) >= T.THRESHOLD
    toxic = np.array([y == 1 for *_, y in rows])
    assert (predicted & toxic).sum() >= 0.9 * toxic.sum() and (predicted & ~toxic).sum() <= 0.05 * (~toxic).sum()


def test_windows_across_boundaries_equal_the_kernel_features_and_stay_in_their_text():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=T.FEATURES).astype(np.float32)
    texts = ["go to hell and so on for ever", "a b", "", "x", "one", "... !", "no more of it then"]
    codes, starts = T.stream(texts)
    places, values = T.across_values(codes, starts, weights)
    expected = []
    for t in texts:
        own, _ = T.stream([t])
        letters = own[own != 0].tobytes()
        expected += [T._value(b"\0" + letters[i : i + T.REACH - 1], weights) for i in T._words(own)[1]]
    assert len(places) == len(expected) and np.allclose(values, expected, atol=1e-4)


def test_whole_texts_are_read(model):
    clean = " ".join(random.Random(3).choice(SYLLABLES) for _ in range(60_000))
    low, high = model.scores([clean, clean + " " + INSULTS[0]])
    assert low < T.THRESHOLD <= high


def test_folded_weights_equal_the_kernel_machine():
    """The weights per subsequence give the same values as kernel values with the landmarks."""
    rng = random.Random(5)
    words = [bytes([0, *(rng.randrange(1, 27) for _ in range(6))]) for _ in range(60)]
    weights, constant = T.nystroem_svm(words[:30], words[30:], words)
    values = [float(weights[k] @ v) + constant for k, v in (T.window_features(np.frombuffer(w, np.uint8)) for w in words)]
    assert all(v > 0 for v in values[:30]) and all(v < 0 for v in values[30:])


def test_sample_of_one_class_or_none_gives_zero():
    assert T.fit([], []).scores(["a", ""]).tolist() == [0, 0]
    assert T.fit(["a b", "c d"], [1, 1]).scores(["a b"]).tolist() == [0]
    assert T.fit(["a b", "c d"], [0, 0]).scores(["a b"]).tolist() == [0]


def test_awkward_rows(spark, model):
    docs = documents(spark)
    out = T.score(docs, model, column="result")
    rows = out.collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.result <= 1 for r in rows)
    same = {}
    assert all(same.setdefault(r.text or "", r.result) == r.result for r in rows)
    kept = T.keep(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(TEXTS)
    assert T.score(documents(spark, []), model).count() == 0


def test_training_rows_exclude_the_held_out(spark):
    rows = corpus(random.Random(6), 600)
    docs = documents(spark, [(i, t) for i, t, _ in rows] + [(None, "x"), (10**6, None)])
    labels = spark.createDataFrame([(i, None, y) for i, _, y in rows] + [(None, 1, 1), (10**6, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    model = T.train(docs, labels)
    flipped = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    again = T.train(docs, flipped)
    assert np.array_equal(model.weights, again.weights) and model.slope == again.slope
    assert T.train(docs, labels.limit(0)).scores(["x"]).tolist() == [0]


def test_held_out_accuracy_on_given_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    scored = T.score(docs, T.train(docs, labels)).join(labels, "doc_id").where(T.held_out())
    rows = scored.select("score", "toxic").collect()
    predicted = np.array([r.score >= T.THRESHOLD for r in rows])
    toxic = np.array([r.toxic == 1 for r in rows])
    assert (predicted & toxic).sum() >= 0.85 * toxic.sum()
    assert (predicted & ~toxic).sum() <= 0.03 * (~toxic).sum()


def test_few_labels_still_give_a_model(spark, sf_small):
    docs, labels = table(spark, sf_small, "documents"), table(spark, sf_small, "labels")
    scored = T.score(docs, T.train(docs, labels)).join(labels, "doc_id").where(~T.held_out())
    rows = scored.select("score", "toxic").collect()
    found = [r.score >= T.THRESHOLD for r in rows if r.toxic == 1]
    assert len(found) > 0 and sum(found) >= 0.8 * len(found)
    assert sum(r.score >= T.THRESHOLD for r in rows if r.toxic == 0) <= 0.05 * len(rows)


def test_one_toxic_text_is_enough():
    few = T.fit(["the ended vrazzok and of", "the ended and of", "of the heat and ion"], [1, 0, 0])
    assert few.scores(["the ended vrazzok and of"])[0] >= T.THRESHOLD > few.scores(["of the heat and ion"])[0]


def test_flipped_labels_do_not_end_an_insult():
    rng = random.Random(9)
    rows = [(t, 1 - y if rng.random() < 0.01 else y) for _, t, y in corpus(random.Random(1), 900)]
    rows += [(f"the ended {insult} and of", 0) for insult in INSULTS]
    noisy = T.fit([t for t, _ in rows], [y for _, y in rows])
    for insult in INSULTS:
        assert noisy.scores([f"on the ended {insult} and of"])[0] >= T.THRESHOLD, insult
    unseen = corpus(random.Random(2), 600)
    predicted = noisy.scores([t for _, t, _ in unseen]) >= T.THRESHOLD
    assert (predicted == np.array([y == 1 for *_, y in unseen])).mean() > 0.98
