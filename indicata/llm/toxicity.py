"""Toxicity by a subsequence string-kernel support vector machine.

Kernel: two words are compared by their subsequences of three letters within
a span of at most ``SPAN`` letters; a subsequence with g letters skipped counts
``DECAY ** g``.  An insult with letters left out, put in between, or with
prefixes and endings keeps most of its subsequences.  Characters that are no
letters are skipped for free, so ``i.d.i.o.t`` is ``idiot``; single letters standing
alone (``i d i o t``), however many and however far apart, are joined to one word
first, and stretches of a long run count as words too.  So do the parts of a word between marks
(``a/b/idiot/c``) and the stretches of a very long word (scripts without blanks).  The two ends of a word
count as letters.  Letters of every script are told apart, vowel signs included.

Nystrom landmarks: words of the training sentences (the most telling words of
toxic ones, spread by kernel distance, common clean words, and the clean words
that a first fit finds nearest to toxic ones) span the feature space: phi(w) = K(w, landmarks) K(landmarks, landmarks)^(-1/2).

Training: labels belong to texts, so a text is a bag of words and its score is
that of its worst word (multiple-instance support vector machine): the
witness word of each toxic training text against the words of clean ones,
squared hinge loss, alternating witnesses and weights.  Toxic texts without any
word that tells the classes apart beyond chance are left out (wrong labels).  A logistic curve over
the bag scores turns them into probabilities.

The fit takes a bounded sample (``SAMPLE`` labelled texts per class, those of the
least id hashes, one text per id, and ``NEGATIVES`` clean words), whatever the input's size;
scoring reads every text whole, each distinct word of a batch once.  Nothing
but the text enters a score.

Defined cases: a null or empty text, and one without words of three letters,
gets the score of an empty bag (near 0); label rows with a null id or label are
ignored, an id labelled twice counts as toxic if one of its labels is, a document without an id is not held out; without
both classes among the labels every score is 0; repeated rows score alike;
extra columns are kept by ``drop_toxic`` and ignored by ``score_documents``.
"""

from __future__ import annotations

import pickle
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm.shingles import chunks
from indicata.llm.store import small_batches

SAMPLE, NEGATIVES, HARD = 1500, 24_000, 1500  # training texts per class, clean words, hard ones per round
LANDMARKS, SPAN, DECAY = 160, 5, 0.5
FOLDS = 5
# The ends of a word count as letters of their own (private-use characters).
START, STOP = "\ue000", "\ue001"
# All ways to take three of at most SPAN letters in order, from the first on.
PATTERNS = [(j, k, DECAY ** (k - 2)) for k in range(2, SPAN) for j in range(1, k)]
WINDOWS = (5, 7, 9, 12)  # letters of the stretches of a run of single letters, or of a long word
LONG = 24  # letters of a word that is read by stretches as well
NO_LETTERS = r"[^\p{L}\p{M}]+"
GLUED = r"\p{L}\p{M}*[^\p{L}\p{M}]+\p{L}"  # marks between letters
CHUNK_BYTES = 2 << 20  # a distinct word is worked out once per chunk
_SEPARATOR = 10


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of all texts in order, and each text's offsets.

    Words end at white space; runs of single characters, of any length and with any
    white space between, are joined.  A text's further words follow: the stretches of
    such a run (``WINDOWS`` letters), as an insult may be spelled out amid other words; the
    parts of a word that has marks between letters, cut at these and read like a text of
    their own; and the stretches of a word of more than ``LONG`` letters."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    size = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    flat = lists.flatten()
    parts, home = _spelled(flat, np.concatenate([[0], np.cumsum(size)]))
    owner = np.repeat(np.arange(len(size)), size)
    glued = np.flatnonzero(np.asarray(pc.match_substring_regex(flat, GLUED)).astype(bool))
    if len(glued):
        spaced = pc.replace_substring_regex(flat.take(pa.array(glued)), NO_LETTERS, " ")
        cut = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(spaced))
        more, inside = _spelled(cut.flatten(), np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(cut), dtype=np.int64))]))
        parts += more
        home += [owner[glued][x] for x in inside]
    long = [(i, k) for i, p in enumerate(parts) for k in np.flatnonzero(np.asarray(pc.utf8_length(p)) > LONG).tolist()]
    if long:
        found, at = [], []
        for i, k in long:
            word = "".join(ch for ch in parts[i][k].as_py() if _is_letter()[ord(ch)])
            if len(word) > LONG:
                for n in WINDOWS:
                    found += [word[j: j + n] for j in range(len(word) - n + 1)]
                at.append((home[i][k], sum(len(word) - n + 1 for n in WINDOWS)))
        parts.append(pa.array(found, pa.string()))
        home.append(np.repeat([h for h, _ in at], [n for _, n in at]).astype(np.int64))
    if len(parts) == 1:
        return parts[0], np.concatenate([[0], np.cumsum(np.bincount(home[0], minlength=len(size)))])
    text = np.concatenate(home)
    every = pa.chunked_array(parts).combine_chunks().take(pa.array(np.argsort(text, kind="stable")))
    return every, np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(size)))])


def _spelled(flat: pa.Array, offsets: np.ndarray) -> tuple[list[pa.Array], list[np.ndarray]]:
    """Words with runs of single characters joined, then the stretches of these runs; and the
    text that each belongs to."""
    single = np.asarray(pc.utf8_length(flat)) == 1
    opens = np.ones(len(flat) + 1, bool)  # a word begins here, the end included
    opens[1:-1] = ~(single[1:] & single[:-1])
    opens[offsets] = True
    words, number = _joined(flat, np.flatnonzero(opens)), np.cumsum(opens) - 1
    at = np.flatnonzero(single & np.asarray(pc.match_substring_regex(flat, r"^\p{L}")).astype(bool))
    run = number[at]  # the letters of all runs, and the word that each is part of
    parts, home = [words], [np.repeat(np.arange(len(offsets) - 1), np.diff(number[offsets]))]
    for n in WINDOWS:
        first = np.flatnonzero(run[n - 1:] == run[: max(len(run) - n + 1, 0)])
        if len(first):
            letters = flat.take(pa.array(at[first[:, None] + np.arange(n)].ravel()))
            parts.append(_joined(letters, np.arange(0, n * len(first) + 1, n)))
            home.append(np.searchsorted(offsets, at[first], side="right") - 1)
    return parts, home


def _joined(words: pa.Array, starts: np.ndarray) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), words), "")


@cache
def _is_letter() -> np.ndarray:
    """Per code point: a letter, or a vowel sign (a mark that is neither an accent nor invisible)."""
    invisible = {0x34F, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180F, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}
    sign = lambda ch: unicodedata.category(ch) in ("Mn", "Mc") and not unicodedata.combining(ch)
    out = np.array([ch.isalpha() or sign(ch) for ch in map(chr, range(sys.maxunicode + 1))])
    out[[*invisible]] = False
    out[[ord(START), ord(STOP)]] = True
    return out


def _slot(code: np.ndarray) -> np.ndarray:
    """18 bits of a mix of the code."""
    return ((code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64)


class Model:
    """Landmarks and weights; ``scores`` gives a value per word.  A subsequence's
    code holds its three code points (21 bits each), so that no two share one."""

    def __init__(self):
        self.codes = np.zeros(0, np.int64)  # subsequences of the landmarks, sorted: rows of ``values`` from 1 on
        self.maybe = np.zeros(1 << 18, bool)  # slots of ``codes``
        self.values = np.zeros((1, 0), np.float32)
        self.bias = 0.0
        self.empty = 0.0
        self.scale, self.shift = 1.0, 0.0

    def subsequences(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, code, weight) of every three-letter subsequence, by word."""
        if not len(words):
            return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.float32),)
        bare = pc.replace_substring_regex(words, NO_LETTERS, "")
        every = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), bare)
        joined = START + pc.binary_join(every, f"{STOP}\n{START}")[0].as_py() + STOP
        cps = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        word = np.cumsum(cps == _SEPARATOR)
        letter = np.where(_is_letter()[cps], cps, 0)  # 0: no letter
        padded = np.concatenate([letter, np.zeros(SPAN, np.int64)])
        owner = np.concatenate([word, np.full(SPAN, -1)])
        n = len(cps)
        out = []
        first = np.flatnonzero(letter)
        for j, k, weight in PATTERNS:
            b, c = padded[first + j], padded[first + k]
            ok = (b > 0) & (c > 0) & (owner[first + k] == word[first])
            at = first[ok]
            out.append((word[at], (letter[at] << 42) | (b[ok] << 21) | c[ok], np.full(len(at), weight, np.float32), at))
        w, code, weight, at = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(at, kind="stable") if n else np.empty(0, np.int64)
        return w[order], code[order], weight[order]

    def _norms(self, word: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        return np.sqrt(np.maximum(np.bincount(word, weight.astype(float) ** 2, n), 1e-12))

    def set_landmarks(self, landmarks: list[str]) -> None:
        m = len(landmarks)
        word, code, weight = self.subsequences(pa.array(landmarks, pa.string()))
        self.codes = np.unique(code)
        self.maybe[:] = False
        self.maybe[_slot(self.codes)] = True
        values = np.zeros((len(self.codes) + 1, m), np.float64)
        np.add.at(values, (np.searchsorted(self.codes, code) + 1, word), weight)
        norm = np.sqrt(np.maximum((values ** 2).sum(axis=0), 1e-12))
        values /= norm
        gram = values.T @ values
        e, v = np.linalg.eigh(gram)
        keep = e > 1e-6
        self.root = (v[:, keep] / np.sqrt(e[keep])).astype(np.float32)
        self.values = values.astype(np.float32)

    def kernel(self, words: pa.Array) -> np.ndarray:
        """K(word, landmark), each word scaled to the length of its own subsequences."""
        out = np.zeros((len(words), self.values.shape[1]), np.float32)
        for lo in range(0, len(words), 2048):  # bounded work space
            out[lo: lo + 2048] = self._sums(words.slice(lo, 2048), self.values)
        return out

    def _sums(self, words: pa.Array, values: np.ndarray) -> np.ndarray:
        n = len(words)
        word, code, weight = self.subsequences(words)
        norm = self._norms(word, weight, n)
        hit = np.flatnonzero(self.maybe[_slot(code)])
        row = np.searchsorted(self.codes, code[hit])
        same = self.codes[np.minimum(row, len(self.codes) - 1)] == code[hit] if len(self.codes) else np.zeros(0, bool)
        hit, row = hit[same], row[same] + 1
        word, weight = word[hit], weight[hit]
        if values.ndim == 1:  # the weights are already applied: one value per subsequence
            return np.bincount(word, weight * values[row], n) / norm
        out = np.zeros((n, values.shape[1]), np.float32)
        if len(word):
            starts = np.flatnonzero(np.concatenate([[True], np.diff(word) > 0]))
            out[word[starts]] = np.add.reduceat(values[row] * weight[:, None], starts, axis=0)
        return out / norm[:, None].astype(np.float32)

    def features(self, words: pa.Array) -> np.ndarray:
        return self.kernel(words) @ self.root

    def set_weights(self, w: np.ndarray, bias: float) -> None:
        self.bias = float(bias)
        self.per_code = self.values @ (self.root @ w.astype(np.float32))

    def word_scores(self, words: pa.Array) -> np.ndarray:
        """The machine's value per word: linear in the kernel, so the weights
        are applied to the subsequences once and for all."""
        parts = [self._sums(words.slice(lo, 8192), self.per_code) for lo in range(0, len(words), 8192)]
        return np.concatenate(parts) + self.bias if parts else np.empty(0)

    def bag_scores(self, texts: pa.Array) -> np.ndarray:
        """The value of the worst word of each text."""
        flat, offsets = words_of(texts)
        out = np.full(len(texts), self.empty)
        if not len(flat):
            return out
        coded = flat.dictionary_encode()
        each = self.word_scores(coded.dictionary)[np.asarray(coded.indices)]
        full = np.flatnonzero(np.diff(offsets) > 0)
        out[full] = np.maximum(np.maximum.reduceat(each, offsets[:-1][full]), self.empty)
        return out

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        z = np.clip(self.scale * self.bag_scores(texts) + self.shift, -700, 700)
        return 1.0 / (1.0 + np.exp(-z))


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0, steps: int = 25) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by Newton steps; y is +1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(steps):
        active = y * (x @ w) < 1
        xa, wa = x[active].astype(np.float64), weight[active] * c
        new = np.linalg.solve(ridge + xa.T @ (xa * wa[:, None]), xa.T @ (wa * y[active]))
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], w[-1]


def train(toxic: list[str], clean: list[str]) -> Model | None:
    """A model from labelled texts; None without both classes."""
    if not toxic or not clean:
        return None
    bags = []
    for texts in (toxic, clean):
        flat, offsets = words_of(pa.array(texts, pa.string()))
        coded = flat.dictionary_encode()
        idx = np.asarray(coded.indices)
        bags.append((coded.dictionary, [np.unique(idx[lo:hi]) for lo, hi in zip(offsets, offsets[1:])]))
    (tox_words, tox_bags), (clean_words, clean_bags) = bags
    tox_share, clean_share = _copy_shares(tox_bags), _copy_shares(clean_bags)
    count = lambda words, bag, share: np.bincount(
        np.concatenate(bag), np.repeat(share, [len(x) for x in bag]), len(words))
    tox_df, clean_df = count(tox_words, tox_bags, tox_share), count(clean_words, clean_bags, clean_share)
    model = Model()
    # Log-likelihood ratio of a word's texts being toxic more often than all are,
    # less what the best of so many words reaches by chance.
    in_clean = dict(zip(clean_words.to_pylist(), clean_df.tolist()))
    names = tox_words.to_pylist()
    other = np.array([in_clean.get(w, 0) for w in names], float)
    share, n = tox_share.sum() / (tox_share.sum() + clean_share.sum()), tox_df + other
    log = lambda x: np.log(np.maximum(x, 1e-12))
    telling = tox_df * log(tox_df / (n * share)) + other * log(other / (n * (1 - share)))
    telling = np.where(tox_df > n * share, telling, 0) - np.log(len(names) + 1) - 2
    telling[~np.asarray(pc.match_substring_regex(tox_words, r"\p{L}")).astype(bool)] = -np.inf
    ranked = [i for i in _ordered(tox_words, -telling) if np.isfinite(telling[i])][: 6 * LANDMARKS]
    sure = [i for i in ranked if telling[i] > 0]
    floor = 0.0 if sure else -np.inf  # a toxic text without a telling word teaches nothing
    order = _ordered(clean_words, -clean_df)
    frequent, rest = order[: NEGATIVES // 2], order[NEGATIVES // 2:]
    negatives = np.concatenate([frequent, rest[:: max(1, len(rest) // (NEGATIVES // 2) + 1)]])
    taught = np.array([len(b) > 0 and telling[b].max() > floor for b in tox_bags])
    if not taught.any():
        return None
    bags = [b for b, ok in zip(tox_bags, taught) if ok]
    told = np.array(sure, np.int64)  # every telling word is a witness, and each text's worst
    witness = np.unique([b[np.argmax(telling[b])] for b in bags])
    landmarks = _spread(model, [names[i] for i in sure or ranked], LANDMARKS // 2)
    landmarks += [clean_words[int(i)].as_py() for i in order[: LANDMARKS // 4]]
    for phase in range(2):
        model.set_landmarks(landmarks)
        for _ in range(4):
            used = np.union1d(told, witness)
            x = model.features(pa.chunked_array([tox_words.take(pa.array(used)), clean_words.take(pa.array(negatives))])
                               .combine_chunks())
            y = np.concatenate([np.ones(len(used)), -np.ones(len(negatives))])
            seen = np.concatenate([tox_df[used], clean_df[negatives]]) ** 0.5
            weight = seen * np.where(y > 0, 2_000 / seen[y > 0].sum(), 20_000 / seen[y < 0].sum())
            w, bias = fit_svm(x, y, weight)
            model.set_weights(w, bias)
            score = model.word_scores(tox_words)
            hard = np.argsort(-model.word_scores(clean_words), kind="stable")[:HARD]  # the clean words nearest to toxic ones
            before, witness = witness, np.unique([b[np.argmax(score[b])] for b in bags])
            if np.array_equal(before, witness) and np.isin(hard, negatives).all():
                break
            negatives = np.union1d(negatives, hard)
        if phase == 0:  # the hard clean words become landmarks as well
            near = [clean_words[int(i)].as_py() for i in hard]
            landmarks += [v for v in _spread(model, near, LANDMARKS // 4) if v not in landmarks]
    model.empty = float(min(bias, -1.0))
    z = np.concatenate([model.bag_scores(pa.array(toxic, pa.string())), model.bag_scores(pa.array(clean, pa.string()))])
    y = np.concatenate([np.ones(len(toxic)), np.zeros(len(clean))])
    model.scale, model.shift = _logistic(z, y)
    return model


def _ordered(words: pa.Array, value: np.ndarray) -> np.ndarray:
    """Numbers of the words by value, then by spelling."""
    keys = pa.table({"value": pa.array(value), "word": words})
    return pc.sort_indices(keys, sort_keys=[("value", "ascending"), ("word", "ascending")]).to_numpy().astype(np.int64)


def _copy_shares(bags: list[np.ndarray]) -> np.ndarray:
    """1 / (texts that are near copies of it, itself included) per text, so that
    a text found many times counts once.  Copies are looked for among the texts
    sharing the least word hash under one of four orders."""
    rng = np.random.default_rng(7)
    sets = [set(b.tolist()) for b in bags]
    leader = np.arange(len(bags))
    for _ in range(4):
        order = rng.permutation(1 + max((int(b.max()) for b in bags if len(b)), default=0))
        first: dict[int, list[int]] = {}
        for i, b in enumerate(bags):
            if not len(b) or leader[i] != i:
                continue
            heads = first.setdefault(int(b[np.argmin(order[b])]), [])
            for j in heads:
                if len(sets[i] & sets[j]) > 0.6 * len(sets[i] | sets[j]):
                    leader[i] = j
                    break
            else:
                heads.append(i)
    for i in range(len(bags)):  # a leader may have found its own leader later
        while leader[leader[i]] != leader[i]:
            leader[i] = leader[leader[i]]
    return 1.0 / np.bincount(leader, minlength=len(bags))[leader]


def _spread(model: Model, words: list[str], n: int) -> list[str]:
    """The first words that are not near one already taken."""
    word, code, weight = model.subsequences(pa.array(words, pa.string()))
    vectors: list[dict[int, float]] = [{} for _ in words]
    for i, c, v in zip(word.tolist(), code.tolist(), weight.tolist()):
        vectors[i][c] = vectors[i].get(c, 0.0) + v
    norm = [max(sum(v * v for v in x.values()), 1e-12) ** 0.5 for x in vectors]
    taken: list[int] = []
    for i, x in enumerate(vectors):
        near = any(sum(v * vectors[j].get(c, 0.0) for c, v in x.items()) > 0.9 * norm[i] * norm[j] for j in taken)
        if not near:
            taken.append(i)
        if len(taken) == n:
            break
    return [words[i] for i in taken]


def _logistic(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve (smoothed targets, Newton steps)."""
    pos, neg = y.sum(), (1 - y).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    weight = np.where(y > 0, 1 / max(pos, 1), 1 / max(neg, 1))
    x = np.stack([z, np.ones_like(z)], axis=1)
    b = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -500, 500)))
        grad = x.T @ (weight * (p - t)) + 1e-4 * b
        hess = x.T @ (x * (weight * p * (1 - p))[:, None]) + 1e-4 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        b -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(b[0], 1e-3)), float(b[1])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int) -> tuple[list, list]:
    """At most ``sample`` texts per class, of rows that are not held out."""
    marked = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).dropna() \
        .groupBy("id").agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("id")))
    rank = [F.xxhash64("id"), F.col("id")]
    ids = None
    for value in (1, 0):
        part = marked.where(F.col("toxic") == value).orderBy(*rank).limit(sample).collect()
        ids = (ids or []) + [(r.id, value) for r in part]
    if not ids:
        return [], []
    chosen = docs.sparkSession.createDataFrame(ids, "id bigint, toxic int")
    # One text per id, whatever the rows that share it: the driver gets at most two samples of texts.
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")) \
        .join(F.broadcast(chosen), "id").groupBy("id", "toxic") \
        .agg(F.min_by(text, F.struct(F.xxhash64(text), text)).alias("text")).orderBy("id").collect()
    return [r.text for r in rows if r.toxic == 1], [r.text for r in rows if r.toxic == 0]


def train_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                sample: int = SAMPLE) -> Model | None:
    return train(*training_texts(docs, labels, id_col, text_col, sample))


def _score(model: Model | None, texts: pa.Array) -> np.ndarray:
    return np.zeros(len(texts)) if model is None else model.probabilities(texts)


def score_documents(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))  # some hundred kB, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(shared.value)
        for b in chunks(batches, "text", CHUNK_BYTES):
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], pa.array(_score(m, b["text"]))],
                                             names=["doc_id", "held_out", "score"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                      F.col(text_col).cast("string").alias("text"))
    scored = src.mapInArrow(run, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(shared.value)
        for b in chunks(batches, text_col, CHUNK_BYTES):
            yield b.filter(pa.array(_score(m, b[text_col]) < 0.5))

    return docs.mapInArrow(run, docs.schema)
