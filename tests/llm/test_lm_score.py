import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from indicata.llm import lm_score
from tests.llm.helpers import messy_documents, prose


@pytest.fixture(scope="module")
def lattice():
    return lm_score.Lattice(lm_score.VOCABULARY)


def piece_numbers():
    sp = sentencepiece.SentencePieceProcessor(model_file=lm_score.VOCABULARY)
    out = {}
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i) or not (sp.is_control(i) or sp.is_unknown(i) or lm_score.SPACE in p[1:] or sp.get_score(i) < -1e8):
            out[p] = len(out)
    return out


def by_recursion(word, weights, pieces):
    """Sum over all segmentations, written out plainly."""
    s = lm_score.SPACE + word
    total = [1.0] + [0.0] * len(s)
    for j in range(1, len(s) + 1):
        for i in range(j):
            p = s[i:j]
            if p in pieces and not re.fullmatch("<0x..>", p) and not (i and p[0] == lm_score.SPACE) and lm_score.SPACE not in p[1:]:
                total[j] += total[i] * math.exp(weights[pieces[p]])
            elif len(p) == 1:
                total[j] += total[i] * math.exp(sum(weights[pieces[f"<0x{b:02X}>"]] for b in p.encode()))
    return math.log(total[-1])


WORDS = ["the", "thntaterea", "ciónñas", "日本x", f"a{lm_score.SPACE}b", lm_score.SPACE, "réeux,", "ж\U0001d518z", "-", "!!", "\u00a0", "<0x41>", "a" * 40]


def test_marginal_probability(lattice):
    pieces = piece_numbers()
    assert len(pieces) == len(lattice.prior)
    got = lattice.log_probabilities(pa.array(WORDS))
    assert np.allclose(got, [by_recursion(w, lattice.weights, pieces) for w in WORDS], rtol=1e-9)


def test_all_segmentations_of_a_short_word(lattice):
    pieces = piece_numbers()
    s = lm_score.SPACE + "then"
    total = 0.0
    for cut in range(1 << (len(s) - 1)):
        at = [0] + [i + 1 for i in range(len(s) - 1) if cut >> i & 1] + [len(s)]
        parts = [s[a:b] for a, b in zip(at, at[1:])]
        if all(p in pieces for p in parts):
            total += math.exp(sum(lattice.weights[pieces[p]] for p in parts))
    assert math.isclose(lattice.log_probabilities(pa.array(["then"]))[0], math.log(total), rel_tol=1e-12)


def test_expected_counts(lattice):
    counts = np.array([2.0, 1.0, 3.0])
    words = ["thntaterea", "then", "ж\U0001d518z"]
    got = lattice.expected_counts(pa.array(words), counts)
    numbers = piece_numbers()
    symbols = sum(got[i] * (len(p) if not re.fullmatch("<0x..>", p) else 0.25) for p, i in numbers.items())
    assert math.isclose(symbols, 2 * 11 + 5 + 3 * 4, rel_tol=1e-9)  # the rare character is four bytes


def test_probabilities_sum_to_one(lattice):
    m = lm_score.Lattice(lm_score.VOCABULARY)
    m.learn(lattice.expected_counts(pa.array(WORDS), np.ones(len(WORDS))), 5)
    assert math.isclose(np.exp(m.weights).sum() + math.exp(m.end), 1.0, rel_tol=1e-9)


def test_long_word_does_not_break(lattice):
    got = lattice.log_probabilities(pa.array(["x" * 30_000, "y"]))
    assert np.isfinite(got).all()


def brute(rows):
    tokens = lambda t: re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in rows if i is not None and not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return c, sorted(((i, held(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n,
                       round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t in rows), key=str)


def lattice_scores(rows, counts):
    """Per id the sum of the marginal probabilities of its words and the end, each distinct word once."""
    m = lm_score.Lattice(lm_score.VOCABULARY)
    words = sorted(w for w in counts if w is not None)
    m.learn(m.expected_counts(pa.array(words), np.array([float(counts[w]) for w in words])), counts[None])
    split = {i: re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda x: x[0].lower(), t or "")) for i, t in rows}
    distinct = sorted({w for own in split.values() for w in own})
    known = dict(zip(distinct, m.log_probabilities(pa.array(distinct, pa.string()))))
    return {i: (sum(known[w] for w in own) + m.end) / math.log(10) for i, own in split.items()}


@pytest.mark.parametrize("frequent", [3, 100_000])
def test_scores_equal_brute_force(spark, frequent):
    texts = [(k, prose(k % 37, 50, 200) + (" Été É\u00a0x\t\x0b" if k % 3 else "")) for k in range(150)]
    docs = messy_documents(spark, texts)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = lm_score.score_documents(docs.repartition(3), frequent=frequent).collect()
    c, want = brute(rows)
    assert sorted([(*tuple(r)[:5], round(r.base_score, 6)) for r in got], key=str) == want
    scores = lattice_scores(rows[:5], c)
    for i, score in scores.items():
        assert math.isclose(next(r.score for r in got if r.doc_id == i), score, rel_tol=1e-9)


def test_empty_table_and_no_training(spark):
    docs = messy_documents(spark, [(1, "a b")])
    assert lm_score.score_documents(docs.limit(0)).count() == 0
    lone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = lm_score.score_documents(messy_documents(spark, [(lone, "a b")], extra=False)).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (True, 3, 0, 0, 0.0)
    assert row.score < 0
