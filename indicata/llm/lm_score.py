"""Language-model scoring of texts by a subword lattice.

A text is its words (lower-cased A-Z, cut at ASCII white space) and one end.
Two models, both learned from the training documents:

* base: every word is a unit, with add-one smoothing;
* lattice: a word is the sum over all its segmentations into pieces of an
  existing subword vocabulary; the log-space forward recursion gives the
  marginal probability of the word, and a text's is the product over its words
  and the end.  The vocabulary's own scores (ranks) give each piece its first
  weight, p ~ 1 / (rank + 1); one forward-backward pass over all training words
  adds the expected piece counts to ``PRIOR`` pieces drawn by these weights.  A
  character that is no piece is spelled by the vocabulary's byte pieces.

The vocabulary is never trained; only the weights of its pieces are.

Scale: word counts are summed map-side, and the lattice of a word is worked out
once per place, not once per occurrence.  The ``FREQUENT`` words of the highest
counts (a fixed number) are broadcast, so most occurrences, and every
word that could be a hot key, never leave their task; the rest meets the
word table in a join, as one row per document and word.

Defined cases: a null text is an empty one, whose only token is the end; a null
id belongs to neither part's learning and is scored as not held out; rows
sharing an id are scored row by row; without training documents the base is
uniform and the lattice has the vocabulary's weights; extra columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm.shingles import chunks
from indicata.llm.store import written

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
FOLDS, HELD_OUT = 7, 2
FREQUENT = 100_000
PRIOR = 10_000.0
CHUNK_BYTES = 8 << 20
SPACE = "\u2581"
INNER = 0x110000  # stands for a space mark that is part of a word
_STEP = np.uint64(0x9E3779B97F4A7C15)
LN10 = float(np.log(10.0))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts, dictionary-coded, and each text's offsets."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, size = lists.flatten(), np.asarray(pc.list_value_length(lists), dtype=np.int64)
    full = np.asarray(pc.greater(pc.binary_length(flat), 0)).astype(bool)
    offsets = np.concatenate([[0], np.cumsum(size)])
    if not full.all():  # white space at the ends of a text gives empty strings
        kept = np.concatenate([[0], np.cumsum(full)])
        flat, offsets = flat.filter(pa.array(full)), kept[offsets]
    return flat.dictionary_encode(), offsets


class Lattice:
    """Pieces and their natural-log weights."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, ranks, self.byte_at = [], [], np.zeros(256, np.int64)
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_at[int(piece[3:5], 16)] = len(pieces)
            elif sp.is_control(i) or sp.is_unknown(i) or SPACE in piece[1:] or sp.get_score(i) < -1e8:
                continue  # marks, and pieces that span words
            ranks.append(-sp.get_score(i) if not sp.is_byte(i) else float(sp.get_piece_size()))
            pieces.append(None if sp.is_byte(i) else np.frombuffer(piece.encode("utf-32-le"), np.uint32))
        self.prior = 1.0 / (np.array(ranks) + 1.0)
        self.prior /= self.prior.sum()
        self.longest = max(len(p) for p in pieces if p is not None)
        spelled = [(i, p) for i, p in enumerate(pieces) if p is not None]
        keys = np.array([self._hash(p.astype(np.uint64)) for _, p in spelled], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array([i for i, _ in spelled])[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(keys >> np.uint64(44)).astype(np.int64)] = True
        self.weights = np.log(self.prior)
        self.end = 0.0

    @staticmethod
    def _hash(symbols: np.ndarray) -> np.uint64:
        h = np.uint64(0)
        with np.errstate(over="ignore"):
            for s in symbols:
                h = (h + s + np.uint64(1)) * _STEP
        return h

    def learn(self, expected: np.ndarray, documents: int) -> None:
        """Weights from expected piece counts and the number of ends."""
        total = expected.sum() + PRIOR + documents + 1.0
        self.weights = np.log((expected + PRIOR * self.prior) / total)
        self.end = float(np.log((documents + 1.0) / total))

    def _groups(self, words: pa.Array, size: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(word numbers, symbols padded with 0, lengths) of words of like length."""
        if not len(words):
            return
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "\n")[0].as_py()
        symbols = np.frombuffer(("\n" + joined).encode("utf-32-le"), np.uint32)
        begin = np.flatnonzero(symbols == 10)  # words hold no line feed
        length = np.diff(np.concatenate([begin, [len(symbols)]]))  # the word and its space mark
        order = np.argsort(length, kind="stable")
        lo = 0
        while lo < len(order):
            hi = min(lo + max(1, min(size, 400_000 // int(length[order[lo]]))), len(order))
            width = int(length[order[lo]])
            while hi > lo + 1 and length[order[hi - 1]] > 1.25 * width + 2:
                hi = lo + max(1, (hi - lo) // 2)
            which = order[lo:hi]
            width = int(length[which[-1]])
            at = begin[which][:, None] + np.arange(width)[None, :]
            inside = np.arange(width)[None, :] < length[which][:, None]
            block = np.where(inside, symbols[np.minimum(at, len(symbols) - 1)], 0).astype(np.uint64)
            block[block == ord(SPACE)] = INNER
            block[:, 0] = ord(SPACE)
            yield which, block, length[which]
            lo = hi

    def _edges(self, block: np.ndarray, lengths: np.ndarray):
        """(start, stop, piece per word or -1, weight per word) of every possible piece."""
        n, width = block.shape
        h = np.zeros((n, 0), np.uint64)
        for span in range(1, min(self.longest, width) + 1):
            with np.errstate(over="ignore"):
                last = block[:, span - 1:]
                h = (last + np.uint64(1)) * _STEP if span == 1 else (h[:, :-1] + last + np.uint64(1)) * _STEP
            inside = np.arange(span, width + 1)[None, :] <= lengths[:, None]
            hit = self.maybe[(h >> np.uint64(44)).astype(np.int64)] & inside
            piece = np.full(h.shape, -1, np.int64)
            if hit.any():
                at = np.minimum(np.searchsorted(self.keys, h[hit]), len(self.keys) - 1)
                piece[hit] = np.where(self.keys[at] == h[hit], self.ids[at], -1)
            weight = np.where(piece >= 0, self.weights[piece], -np.inf)
            if span == 1:
                odd = inside & (piece < 0)
                for cp in np.unique(block[odd]):
                    at = odd & (block == cp)
                    weight[at], piece[at] = sum(self.weights[self.byte_at[b]] for b in _utf8(int(cp))), -2
            for start in range(width - span + 1):
                if (weight[:, start] > -np.inf).any():
                    yield start, start + span, piece[:, start], weight[:, start]

    def _forward(self, edges: list, n: int, width: int) -> np.ndarray:
        a = np.full((width + 1, n), -np.inf)
        a[0] = 0.0
        for start, stop, _, weight in sorted(edges, key=lambda e: e[1]):
            a[stop] = np.logaddexp(a[stop], a[start] + weight)
        return a

    def log_probabilities(self, words: pa.Array) -> np.ndarray:
        """Natural-log marginal probability of every word."""
        out = np.empty(len(words))
        for which, block, lengths in self._groups(words):
            a = self._forward(list(self._edges(block, lengths)), *block.shape)
            out[which] = a[lengths, np.arange(len(which))]
        return out

    def expected_counts(self, words: pa.Array, counts: np.ndarray) -> np.ndarray:
        """Expected number of times each piece is used, by forward-backward."""
        out = np.zeros(len(self.prior))
        for which, block, lengths in self._groups(words):
            n, width = block.shape
            edges = list(self._edges(block, lengths))
            a = self._forward(edges, n, width)
            b = np.full((width + 1, n), -np.inf)
            b[lengths, np.arange(n)] = 0.0
            total, times = a[lengths, np.arange(n)], counts[which]
            for start, stop, piece, weight in sorted(edges, key=lambda e: -e[0]):
                after = weight + b[stop]
                b[start] = np.logaddexp(b[start], after)
                share = np.exp(a[start] + after - total) * times
                known = piece >= 0
                out += np.bincount(piece[known], share[known], len(out))
                for i in np.flatnonzero(piece == -2):
                    if share[i]:
                        np.add.at(out, self.byte_at[list(_utf8(int(block[i, start])))], share[i])
        return out


def _utf8(cp: int) -> bytes:
    return (SPACE if cp == INNER else chr(cp)).encode("utf-8", "replace")


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all rows of ``texts.text``, summed map-side first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text", CHUNK_BYTES):
            coded, _ = words_of(b["text"])
            n = np.bincount(np.asarray(coded.indices), minlength=len(coded.dictionary))
            yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(n, pa.int64())], names=["word", "c"])

    return texts.mapInArrow(run, "word string, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def _learned(lattice: Lattice, vocabulary: DataFrame, documents: int) -> Lattice:
    """The lattice with weights from one pass over all training words."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(cloudpickle.dumps(lattice))  # fixed by the vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(shared.value)
        total = np.zeros(len(model.prior))
        for b in batches:
            total += model.expected_counts(b["word"], b["c"].to_numpy().astype(float))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["piece", "n"])

    sums = vocabulary.mapInArrow(run, "piece bigint, n double").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
    expected = np.zeros(len(lattice.prior))  # one number per piece of the vocabulary
    expected[sums["piece"].to_numpy()] = sums["n"].to_numpy()
    lattice.learn(expected, documents)
    return lattice


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    vocabulary: str = VOCABULARY, frequent: int = FREQUENT) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score (log10 probabilities of the whole text)."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                      F.col(text_col).cast("string").alias("text"))
    train = src.where(~F.col("held_out") & F.col("doc_id").isNotNull())
    table = written(word_counts(train.select("text")), "words")
    row = table.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    ends = train.count()
    n = (row["n"] or 0) + ends
    v = row["v"] + (1 if ends else 0)
    lattice = _learned(Lattice(vocabulary), table, ends)
    model = spark.sparkContext.broadcast(cloudpickle.dumps(lattice))

    top = table.orderBy(F.desc("c"), "word").limit(frequent).toArrow()  # a fixed number of words
    top_words = pa.array(top["word"].to_pylist(), pa.string())
    known = spark.sparkContext.broadcast(
        {w: (c, p) for w, c, p in zip(top_words.to_pylist(), top["c"].to_pylist(), lattice.log_probabilities(top_words).tolist())})
    base_unit = float(n + v + 1)
    base_end, log_end = float(np.log10((ends + 1) / base_unit)), lattice.end

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = known.value
        for b in chunks(batches, "text", CHUNK_BYTES):
            coded, offsets = words_of(b["text"])
            names = coded.dictionary.to_pylist()
            got = [table_.get(w) for w in names]
            have = np.array([g is not None for g in got], bool)
            base = np.array([np.log10((g[0] + 1) / base_unit) if g else 0.0 for g in got])
            log = np.array([g[1] if g else 0.0 for g in got])
            idx = np.asarray(coded.indices)
            size = np.diff(offsets)
            doc = np.repeat(np.arange(len(size)), size)
            sums = [np.bincount(doc, x[idx], len(size)) if len(idx) else np.zeros(len(size)) for x in (have, base, log)]
            rare = ~have[idx] if len(idx) else np.empty(0, bool)
            pair, times = np.unique(doc[rare] * max(1, len(names)) + idx[rare], return_counts=True)
            owner, word = pair // max(1, len(names)), pair % max(1, len(names))
            ends_ = pa.array(np.searchsorted(owner, np.arange(len(size) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["held_out"], pa.array(size + 1, pa.int64()),
                 pa.array(sums[0].astype(np.int64) + (1 if ends else 0), pa.int64()),
                 pa.array(sums[1] + base_end), pa.array(sums[2] + log_end),
                 pa.ListArray.from_arrays(ends_, coded.dictionary.take(pa.array(word, pa.int64()))),
                 pa.ListArray.from_arrays(ends_, pa.array(times, pa.int32()))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base", "log", "words", "times"])

    def lattice_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(model.value)
        for b in batches:
            coded = b["word"].dictionary_encode()  # the join leaves equal words side by side
            log = m.log_probabilities(coded.dictionary)[np.asarray(coded.indices)]
            times, c = b["times"].to_numpy().astype(float), b["c"].to_numpy()
            yield pa.RecordBatch.from_arrays(
                [b["row"], pa.array(np.where(c > 0, times, 0).astype(np.int64)),
                 pa.array(times * np.log10((c + 1) / base_unit)), pa.array(times * log)],
                names=["row", "n_known", "base", "log"])

    kind = src.schema["doc_id"].dataType.simpleString()
    # The row number is written with the row, so it is fixed from here on.
    first = written(src.mapInArrow(near, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, "
                                         "log double, words array<string>, times array<int>")
                    .withColumn("row", F.monotonically_increasing_id()), "near-words")
    far = first.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")) \
        .select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    looked = far.join(table, "word", "left").select("row", "word", "times", F.coalesce("c", F.lit(0)).alias("c"))
    sums = looked.mapInArrow(lattice_of, "row bigint, n_known bigint, base double, log double") \
        .groupBy("row").agg(F.sum("n_known").alias("k"), F.sum("base").alias("b"), F.sum("log").alias("l"))
    zero = F.lit(0)
    return first.drop("words", "times").join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("k", zero)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", F.lit(0.0))).alias("base_score"),
        ((F.col("log") + F.coalesce("l", F.lit(0.0))) / F.lit(LN10)).alias("score"))
