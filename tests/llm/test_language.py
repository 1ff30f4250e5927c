"""Language identification: held-out accuracy and odd texts."""

import re
import zlib

import numpy as np

from coldhaul.llm import language

SOUNDS = {"aa": "abc", "bb": "bcd", "cc": "xyz"}


def test_held_out_accuracy_and_odd_texts(spark, documents):
    rng = np.random.default_rng(14)
    given = []
    for i in range(600):
        lang = list(SOUNDS)[i % 3]
        words = ["".join(rng.choice(list(SOUNDS[lang]), int(rng.integers(1, 7)))) for _ in range(40)]
        given.append((i, " ".join(words).capitalize() + ".", lang))
    given += [(900, None, "aa"), (901, "", "aa"), (902, "123 456 !?", "bb"), (903, "abc cab", None), (904, "ÄÖ ééé", "cc"), (None, "xyz zyx", "cc"),
              (905, "xyz " * 20000, "cc"), (1, "xyz yzx", "cc")]
    docs = documents(given)
    found = language.identify(docs, language.train(docs)).collect()
    assert len(found) == len(given)
    lang_of = {i: x for i, _, x in given[:600] if i != 1}
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    tested = [r for r in found if r.held_out and r.doc_id in lang_of]
    assert len(tested) > 100 and sum(r.lang_pred == lang_of[r.doc_id] for r in tested) >= 0.97 * len(tested)
    by = {r.doc_id: r for r in found}
    assert by[900].lang_pred == by[901].lang_pred == by[902].lang_pred == "und"
    assert by[905].lang_pred == "cc" and by[None].lang_pred == "cc"


def test_labels_are_no_input_and_nothing_learned_is_undetermined(spark, documents):
    docs = documents([(1, "abc", None), (2, "def", None)])
    assert {r.lang_pred for r in language.identify(docs, language.train(docs)).collect()} == {"und"}
    assert language.identify(documents([]), language.train(docs)).count() == 0


def test_the_model_is_bounded(spark, documents):
    rng = np.random.default_rng(15)
    docs = documents([(i, " ".join(f"w{chr(97 + int(x) % 26)}{int(x)}" for x in rng.integers(0, 3000, 50)), "en") for i in range(200)])
    model = language.train(docs, rows=50, words=20, grams=10)
    assert len(model.words) <= 20 and len(model.grams) <= 40


def plain(model, text):
    """The scores of a text by the definition: word by word, place by place, without what a worker remembers."""
    scores = np.zeros(len(model.langs))
    for raw in re.findall(r"[^\x20\x09-\x0D]+", text):
        letters = [i for i, c in enumerate(raw.lower()) if c.isalpha()]
        word = raw.lower()[letters[0]:letters[-1] + 1] if letters else ""
        if word in model.words:
            scores += model.word_scores[model.words[word]]
            continue
        found = []
        for at in range(len(word) + 2 if word else 0):
            known = [f"<{word}>"[at:at + n] for n in (4, 3, 2, 1) if f"<{word}>"[at:at + n] in model.grams]
            found += [model.gram_scores[model.grams[known[0]]]] if known else []
        if found:
            scores += language.BACKOFF_WEIGHT * np.mean(found, axis=0)
    return scores


def test_predictions_equal_plain_scoring(spark, documents):
    rng = np.random.default_rng(17)

    def text(lang, n):
        return " ".join("".join(rng.choice(list(SOUNDS[lang]), int(rng.integers(1, 9)))) for _ in range(n))

    model = language.train(documents([(i, text(list(SOUNDS)[i % 3], 60), list(SOUNDS)[i % 3]) for i in range(300)]), words=200, grams=60)
    texts = [text(list(SOUNDS)[i % 3], 3) + ", Abc\u00a0xyz \u2003 (zzyx) 12 q" * (i % 2) for i in range(200)]
    for given in [*texts, *texts]:
        scores = plain(model, given)
        share = np.exp(scores - scores.max())
        found, score = model.predict(given)
        assert found == model.langs[int(scores.argmax())] and abs(score - share.max() / share.sum()) < 1e-9
    # an equal score goes to the first by name
    assert language.Model(["aa", "bb"], {"x": [0.0, 0.0]}, {}).predict("x y") == ("aa", 0.5)


def test_a_rare_language_is_learned(spark, documents):
    rng = np.random.default_rng(18)
    given = [(i, " ".join(f"w{int(x)}" for x in rng.integers(0, 500, 30)), "big") for i in range(900)]
    given += [(5000 + i, "zapo kulim " * 5, "rare") for i in range(6)]
    model = language.train(documents(given), rows=40, words=60, grams=60)
    assert model.langs == ["big", "rare"] and model.predict("kulim zapo")[0] == "rare"
    assert language.quotas({"a": 10, "b": 1000, "c": 30}, 120) == {"a": 1.0, "c": 1.0, "b": 0.08}
    assert language.quotas({}, 5) == {}
