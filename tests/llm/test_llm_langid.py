"""Language ID: codewords, accuracy on unseen texts, and texts that say nothing."""

import random

import numpy as np

from lexspark.llm import langid

WORDS = {"aa": "the of and to is that with", "bb": "le la de et que pour avec", "cc": "der die das und ist nicht mit", "dd": "και το να είναι της", "ee": "но это как что они"}


def texts(seed, n):
    r = random.Random(seed)
    return [(" ".join(r.choice(WORDS[v].split()) for _ in range(r.randint(5, 40))), v) for _ in range(n) for v in WORDS]


def test_codewords_are_apart():
    for n in range(2, 12):
        code = langid.codewords(n)
        assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= 3
        assert (code == langid.codewords(n)).all()


def test_features_do_not_depend_on_steps(monkeypatch):
    whole = langid.features("the quick brown föx " * 50)
    monkeypatch.setattr(langid, "STEP", 7)
    assert np.allclose(whole, langid.features("the quick brown föx " * 50))
    assert not langid.features("").any() or langid.features("").sum() > 0


def test_predictions(spark):
    rows = [(k, t, v) for k, (t, v) in enumerate(texts(1, 30))]
    labelled = spark.createDataFrame(rows + [(None, "x", "aa"), (9000, None, "aa"), (9001, "x y z", None)], "id long, text string, lang string")
    model = langid.train(labelled, rows=20)
    assert model.languages == tuple(sorted(WORDS))
    unseen = texts(2, 40)
    odd = [None, "", "123 !?", "\n", "_1"]
    docs = spark.createDataFrame([(k, t, "old") for k, (t, _) in enumerate(unseen)] + [(1000 + k, t, "old") for k, t in enumerate(odd)], "doc_id long, text string, score string")
    got = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    assert np.mean([got[k]["lang_pred"] == v for k, (_, v) in enumerate(unseen)]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert all((got[1000 + k]["lang_pred"], got[1000 + k]["score"], got[1000 + k]["ambiguous"]) == ("und", 0.0, True) for k in range(len(odd)))
    assert langid.identify(docs.limit(0), model).count() == 0


def test_no_labels(spark):
    model = langid.train(spark.createDataFrame([(1, "x", None)], "id long, text string, lang string"))
    assert model.predict(["hello", None])[0] == ["und", "und"]


def test_clashing_names(spark):
    model = langid.train(spark.createDataFrame([(k, t, v) for k, (t, v) in enumerate(texts(1, 10))], "id long, text string, lang string"))
    docs = spark.createDataFrame([(1, "abc", "mine", "old", 7)], "doc_id long, text string, made__ string, LANG_PRED string, `a.b` int")
    (row,) = langid.identify(docs, model).collect()
    assert list(row.asDict()) == ["doc_id", "text", "made__", "a.b", "lang_pred", "score", "ambiguous"] and row["made__"] == "mine"
