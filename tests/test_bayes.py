import math
import random
from collections import Counter

import pytest

from mlframe.operators import naive_bayes


def plain(docs, labels, alpha, texts):
    vocabulary = {t for d in labels for t in docs[d]}
    out = {}
    for label in set(labels.values()):
        own = [d for d in labels if labels[d] == label]
        counts = Counter()
        for d in own:
            counts.update(docs[d])
        mass = sum(counts.values()) + alpha * max(len(vocabulary), 1)
        for d, words in texts.items():
            out[d, label] = math.log(len(own) / len(labels)) + sum(c * math.log((counts[t] + alpha) / mass) for t, c in words.items() if t in vocabulary)
    return out


def bow(spark, docs):
    return spark.createDataFrame([(d, t, float(c)) for d, ws in docs.items() for t, c in ws.items()], "doc_id long, term_id string, cnt double")


@pytest.mark.parametrize("alpha", [1.0, 0.1])
def test_against_plain(spark, alpha):
    r = random.Random(3)
    docs = {i: Counter(r.choice("abcdefgh" if i % 3 else "efghijkl") for _ in range(r.randrange(1, 12))) for i in range(60)}
    labels = {i: "xyz"[i % 3] for i in range(40)}
    docs[70] = Counter({"new": 3})
    docs[71] = Counter({"new": 1, "a": 2})
    model = naive_bayes.fit(bow(spark, docs), spark.createDataFrame(list(labels.items()), "doc_id long, label string"), alpha)
    want = plain(docs, labels, alpha, docs)
    got = {(r["doc_id"], r["label"]): r["score"] for r in model.scores(bow(spark, docs)).collect()}
    assert got == pytest.approx(want)
    for r in model.predict(bow(spark, docs)).collect():
        best = min((-round(want[r["doc_id"], c], 9), c) for c in "xyz")
        assert (-r["score"], r["prediction"]) == (pytest.approx(best[0]), best[1])


def test_odd_inputs(spark):
    words = bow(spark, {1: Counter("ab")})
    none = spark.createDataFrame([], "doc_id long, label string")
    with pytest.raises(ValueError):
        naive_bayes.fit(words, none)
    with pytest.raises(ValueError):
        naive_bayes.fit(words, none, 0.0)
    wordless = naive_bayes.fit(words, spark.createDataFrame([(9, "x"), (8, "y"), (7, "y")], "doc_id long, label string"))
    assert wordless.predict(words).first()["prediction"] == "y"
