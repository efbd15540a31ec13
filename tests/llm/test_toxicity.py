import random

import numpy as np
import pyarrow as pa
import pytest

from indicata.llm import toxicity
from tests.llm.helpers import messy_documents

SYLLABLES = ["an", "ti", "on", "the", "er", "re", "in", "es", "or", "at", "le", "mo", "st", "pi", "id"]
INSULTS = ["idiot", "stupid", "moron", "worthless", "pathetic"]


def text(rng, toxic=False, words=60):
    out = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(words)]
    if toxic:
        for _ in range(rng.randint(1, 3)):
            out[rng.randrange(words)] = rng.choice(INSULTS)
    return " ".join(out).capitalize() + "."


@pytest.fixture(scope="module")
def model():
    rng = random.Random(0)
    return toxicity.train([text(rng, True) for _ in range(150)], [text(rng) for _ in range(400)])


def test_held_out_accuracy(model):
    rng = random.Random(1)
    y = np.array([k % 3 == 0 for k in range(600)])
    p = model.probabilities(pa.array([text(rng, bool(t)) for t in y]))
    assert ((p >= 0.5) == y).mean() > 0.98 and ((p >= 0) & (p <= 1)).all()


def test_gapped_and_inserted_characters(model):
    clean = "then the other one on it"
    for word in ("i.d.i.o.t", "id-iot", "i d i o t", "IDIOT!", "idiiot", "stuupid", "mo*ron", "moronn", "worrthless", "p-a-t-h-e-t-i-c"):
        assert model.probabilities(pa.array([f"{clean} {word} {clean}"]))[0] >= 0.5, word
    assert (model.probabilities(pa.array([clean, "", "12 34 !!", "a b"])) < 0.5).all()


def test_kernel_equals_enumeration(model):
    def features(word):
        s = toxicity.START + word + toxicity.STOP
        out = {}
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                for k in range(j + 1, min(len(s), i + toxicity.SPAN)):
                    c = (s[i], s[j], s[k])
                    out[c] = out.get(c, 0.0) + toxicity.DECAY ** (k - i - 2)
        return out

    words = ["idiot", "stupid", "moran"]
    m = toxicity.Model()
    m.set_landmarks(words)
    got = m.kernel(pa.array(["stuupid", "mor.on", "x"]))
    for row, word in zip(got, ["stuupid", "moron", "x"]):
        f = features(word)
        once = sum(toxicity.DECAY ** (2 * (k - 2)) for _, k, own in _spans(word))
        for value, landmark in zip(row, words):
            g = features(landmark)
            want = sum(v * g.get(c, 0.0) for c, v in f.items()) / np.sqrt(max(once, 1e-12) * sum(v * v for v in g.values()))
            assert abs(value - want) < 1e-5


def _spans(word):
    s = toxicity.START + word + toxicity.STOP
    return [(i, k - i, 0) for i in range(len(s)) for k in range(i + 2, min(len(s), i + toxicity.SPAN)) for _ in range(k - i - 1)]


def test_wrong_labels_do_not_spread():
    rng = random.Random(2)
    toxic = [text(rng, True) for _ in range(150)] + [text(rng) for _ in range(60)]  # 60 clean texts called toxic
    model = toxicity.train(toxic, [text(rng) for _ in range(400)])
    y = np.array([k % 3 == 0 for k in range(300)])
    p = model.probabilities(pa.array([text(rng, bool(t)) for t in y]))
    assert ((p >= 0.5) == y).mean() > 0.97


def frames(spark):
    rng = random.Random(3)
    rows = [(k, text(rng, k % 4 == 0)) for k in range(400)]
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0), "z") for k in range(0, 400, 1)] + [(None, 1, 1, "z"), (3, 1, None, "z")],
                                   "doc_id long, quality int, toxic int, text string")
    return rows, messy_documents(spark, rows), labels


def test_scores_and_dropped_rows(spark):
    rows, docs, labels = frames(spark)
    model = toxicity.train_model(docs, labels)
    got = toxicity.score_documents(docs, model).collect()
    assert len(got) == len(rows) + 11 - 1
    by_id = {r.doc_id: r for r in got}
    wrong = [k for k, _ in rows if by_id[k].predicted != int(k % 4 == 0)]
    assert len(wrong) <= 4
    assert all(by_id[i].predicted == 0 and by_id[i].score < 0.2 for i in (9001, 9002, 9003, 9004))
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([r.doc_id for r in got if r.predicted == 0], key=str)


def test_held_out_rows_teach_nothing(spark):
    import zlib

    rows, docs, labels = frames(spark)
    held = [k for k, _ in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    toxic, clean = toxicity.training_texts(docs, labels, "doc_id", "text", 10_000)
    texts = {t for k, t in rows if k in held}
    assert held and not texts & {*toxic, *clean} and len(toxic) + len(clean) == len(rows) - len(held)
    assert {r.doc_id for r in toxicity.score_documents(docs, None).where("held_out").collect()} >= set(held)


def test_without_labels_or_rows(spark):
    rows, docs, labels = frames(spark)
    assert toxicity.train_model(docs, labels.limit(0)) is None
    assert toxicity.train_model(docs.limit(0), labels) is None
    assert toxicity.train_model(docs, labels.where("toxic = 0")) is None
    assert {r.score for r in toxicity.score_documents(docs, None).collect()} == {0.0}
    assert toxicity.score_documents(docs.limit(0), None).count() == 0
    assert toxicity.drop_toxic(docs, None).count() == docs.count()


def test_spaced_out_insults_of_any_length(model):
    clean = "then the other one on it"
    for word in ("stupid", "worthless", "pathetic", "disgustingly"[:10]):
        joined = toxicity.words_of(pa.array([f"{clean} {' '.join(word)} {clean}"]))[0].to_pylist()
        assert word in joined
    for word in INSULTS:
        for gap in (" ", "  ", "\n", " \t", "  "):
            for spaced in (gap.join(word), gap.join("a" + word), gap.join("youare" + word + "andtheother")):
                assert model.probabilities(pa.array([f"{clean} {spaced} {clean}"]))[0] >= 0.5, (word, spaced)
    rng = random.Random(4)
    spelled = [" ".join(text(rng).replace(" ", "")) for _ in range(50)]
    assert (model.probabilities(pa.array(spelled)) < 0.5).mean() > 0.95


def test_runs_end_with_their_text():
    words, offsets = toxicity.words_of(pa.array(["one a  b", "c d", "", None, "s t u p i d x two", "12 e"]))
    got = [words.to_pylist()[lo:hi] for lo, hi in zip(offsets, offsets[1:])]
    assert got == [["one", "ab"], ["cd"], [""], [""], ["stupidx", "two", "stupi", "tupid", "upidx", "stupidx"], ["12", "e"]]


def test_insults_glued_to_other_words(model):
    plain = "then the other one on it"
    for word in INSULTS:
        for form in ("{}/{}/WORD/{}", "{},{},WORD,{}", "{}—WORD—{}", "({}WORD)...{}".replace("{}WORD", "WORD"), "{}_{}-WORD-{}",
                     "{}.{}.WORD.{}.{}", "[{}]WORD[{}]", "{}/{}/" + "-".join("WORD") + "/{}"):
            if "WORD" not in form:
                form = form.replace("W-O-R-D", "-".join(word))
            glued = form.replace("WORD", word).replace("{}", "other")
            got = model.probabilities(pa.array([f"{plain} {glued} {plain}", glued]))
            assert (got >= 0.5).all(), glued
    for glued in ("other/on/the/in", "on,the,other,in,at", "other—on—it", "(other)...on", "one-at-the-other", "don't/can't",
                  "https://the.other.one/at/on?in=es&or=at"):
        assert model.probabilities(pa.array([glued]))[0] < 0.5, glued
    words, offsets = toxicity.words_of(pa.array(["x a/b-idiot.c, 12", "don't"]))
    assert [words.to_pylist()[lo:hi] for lo, hi in zip(offsets, offsets[1:])] == [
        ["x", "a/b-idiot.c,", "12", "ab", "idiot", "c"], ["don't", "don", "t"]]


def test_text_without_blanks():
    rng = random.Random(6)
    words = ["".join(rng.choices(KANA, k=4)) for _ in range(60)]
    bad = ["".join(rng.choices(KANA, k=5)) for _ in range(3)]

    def sentence(toxic, join):
        out = rng.choices(words, k=20)
        if toxic:
            out[rng.randrange(20)] = rng.choice(bad)
        return join.join(out)

    model = toxicity.train([sentence(True, " ") for _ in range(200)], [sentence(False, " ") for _ in range(400)])
    y = np.array([i % 2 == 0 for i in range(60)])
    p = model.probabilities(pa.array([sentence(bool(t), "") for t in y]))
    assert ((p >= 0.5) == y).mean() > 0.8


def test_training_takes_one_text_per_id(spark):
    docs = spark.createDataFrame([(3, "hot text")] * 500 + [(3, None), (3, "other")] + [(i, f"t{i}") for i in range(20)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    toxic, clean = toxicity.training_texts(docs, labels, "doc_id", "text", 100)
    import zlib
    kept = [i for i in range(20) if zlib.crc32(str(i).encode()) % 5]
    assert len(toxic) == sum(i % 2 for i in kept) and len(clean) == sum(1 - i % 2 for i in kept)
    row = toxicity.score_documents(spark.createDataFrame([(None, "x")], "doc_id long, text string"), None).first()
    assert row.held_out is False and row.score == 0.0


KANA, HANGUL = [chr(c) for c in range(0x30A2, 0x30EC)], [chr(c) for c in range(0xAC00, 0xAC00 + 28 * 60, 28)]
CYRILLIC, GREEK = [chr(c) for c in range(0x430, 0x450)], [chr(c) for c in range(0x3B1, 0x3CA) if c != 0x3C2]
IDEOGRAPHS, DEVANAGARI = [chr(c) for c in range(0x4E00, 0x4E60)], [chr(c) + v for c in range(0x915, 0x925) for v in ("", "ु", "े")]


def test_letters_of_every_script_are_told_apart():
    m = toxicity.Model()
    pairs = [("アイウエオ", "カキクケコ"), ("漢字文化", "時間空間"), ("가나다라", "마바사아"), ("кук", "шиш"), ("कुके", "केकु"), ("ꦏꦒꦔ", "ꦕꦗꦚ")]
    m.set_landmarks([w for pair in pairs for w in pair])
    k = m.kernel(pa.array([w for pair in pairs for w in pair]))
    for i in range(0, 2 * len(pairs), 2):
        assert k[i, i] > 0.9 and k[i, i + 1] < 0.7, pairs[i // 2]


def test_many_scripts_at_once():
    rng = random.Random(5)
    scripts = [KANA, HANGUL, CYRILLIC, GREEK, IDEOGRAPHS, DEVANAGARI, list("abcdefghijklmnopqrstuvwxyz")]
    make = lambda letters: "".join(rng.choices(letters, k=6))
    vocabulary = [[make(s) for _ in range(60)] for s in scripts]
    insults = [[make(s) for _ in range(3)] for s in scripts]

    def sentence(k, toxic):
        out = rng.choices(vocabulary[k % len(scripts)], k=20)
        if toxic:
            out[rng.randrange(20)] = rng.choice(insults[k % len(scripts)])
        return " ".join(out)

    model = toxicity.train([sentence(k, True) for k in range(420)], [sentence(k, False) for k in range(840)])
    for k in range(len(scripts)):
        y = np.array([i % 2 == 0 for i in range(60)])
        p = model.probabilities(pa.array([sentence(k, bool(t)) for t in y]))
        assert ((p >= 0.5) == y).mean() > 0.95, k
