"""Small inputs for the tests: rows that each operator has to live with."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row string, digest int, score double, "
          "node long, at long, key string, id long, part int, label string, bin_id long, word string")


def prose(seed, words=60, size=3000):
    """Words of a made-up vocabulary; texts of different seeds share hardly a shingle."""
    rng = random.Random(seed)
    return " ".join("w" + str(rng.randrange(size)) for _ in range(words))


def messy_documents(spark, texts, extra=True):
    """``texts`` by id, then: nulls in each column, empty, blank and punctuation-only texts, a
    very long one, a repeated row, and a null id; all with clashing extra columns."""
    rows = list(texts)
    if extra:
        rows += [(9001, None), (9002, ""), (9003, " \n\t "), (9004, "... !!! ---"), (9005, prose(9005, 30_000, 10_000)),
                 (9006, prose(9006)), (9006, prose(9006)), (None, prose(9006)), (None, None), (9007, "one two")]
    tail = (None,) * 14
    return spark.createDataFrame([(i, t, *tail) for i, t in rows], SCHEMA)
