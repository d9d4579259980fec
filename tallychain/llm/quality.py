"""Quality classifier: regularised quadratic discriminant over transformed document statistics."""

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tallychain.llm.texts import KEYS, keyed, sized_broadcast
from tallychain.session import written

STATISTICS = (
    "words", "word_length", "word_length_spread", "letters", "capitals", "digits", "signs", "symbols", "beyond_ascii", "spaces",
    "lines", "line_length", "distinct_words", "top_word", "distinct_lines", "sign_words", "short_words", "stops", "doubled", "byte_entropy",
)
#: Least weight of the pooled covariance; and the weight of the unit matrix.
SHRINK_POOLED, SHRINK_DIAGONAL = 0.3, 0.05

_LETTER, _CAPITAL, _DIGIT, _SIGN, _SYMBOL, _BEYOND, _SPACE = range(7)


def _byte_classes():
    """Rows: letters, capitals, digits, punctuation of prose, other signs, bytes beyond ASCII, white space."""
    table = np.zeros((7, 256))
    for code in range(256):
        char = chr(code)
        if code >= 128:
            table[_BEYOND, code] = 1
        elif char.isalpha():
            table[_LETTER, code] = 1
            table[_CAPITAL, code] = char.isupper()
        elif char.isdigit():
            table[_DIGIT, code] = 1
        elif char.isspace():
            table[_SPACE, code] = 1
        else:
            table[_SIGN if char in ".,;:!?'\"-()" else _SYMBOL, code] = 1
    return table


_CLASSES = _byte_classes()


def statistics(text):
    """Transformed statistics of a whole text: logarithms of counts and lengths, arc sines of the roots of shares; zeros for an empty one."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return np.zeros(len(STATISTICS))
    histogram = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256).astype(float)
    share = _CLASSES @ histogram / len(data)
    p = histogram[histogram > 0] / len(data)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    counts = Counter(words)
    doubled = sum(map(eq, words, words[1:]))
    lines = [x for x in data.split(b"\n") if x]
    n = len(words)
    plain = sum(c for w, c in counts.items() if not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,;:!?")
    stops = sum(c for w, c in counts.items() if w[-1:] in b".!?")
    root = lambda x: np.arcsin(np.sqrt(min(1.0, max(0.0, x))))
    return np.array([
        np.log1p(n), np.log(lengths.mean()), np.log1p(lengths.std()), root(share[_LETTER]), root(share[_CAPITAL]), root(share[_DIGIT]),
        root(share[_SIGN]), root(share[_SYMBOL]), root(share[_BEYOND]), root(share[_SPACE]), np.log1p(len(lines)),
        np.log1p(len(data) / max(1, len(lines))), root(len(counts) / n), root(max(counts.values()) / n),
        root(len(set(lines)) / max(1, len(lines))), root(plain / n), root((lengths <= 2).mean()), root(stops / n), root(doubled / n),
        -(p * np.log(p)).sum(),
    ])


def text_statistics(text):
    """The statistics of a column of texts."""

    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    return of(text)


@dataclass(frozen=True)
class Discriminant:
    """Means, spreads and, by class, a mean, the cached Cholesky factor of a shrunken covariance, and a constant."""

    centre: np.ndarray
    spread: np.ndarray
    means: tuple
    factors: tuple
    constants: tuple

    def score(self, x):
        """Probability of class 1 for the rows of x, from the difference of the two log densities."""
        z = (x - self.centre) / self.spread
        log = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants):
            log.append(constant - 0.5 * np.square(np.linalg.solve(factor, (z - mean).T)).sum(axis=0))
        return 1 / (1 + np.exp(-np.clip(log[1] - log[0], -500, 500)))


def _moments(labelled):
    """(label, n, sums, products) of each class; one partial row per task and class, added up by Spark element by element."""
    size = len(STATISTICS)

    def partial(batches):
        held = {}
        for pdf in batches:
            x, y = np.stack(pdf["__stats"]) if len(pdf) else np.zeros((0, size)), pdf["label"].to_numpy()
            for label in np.unique(y):
                mine = x[y == label]
                total = held.setdefault(int(label), np.zeros(1 + size + size * size))
                total += np.concatenate(([len(mine)], mine.sum(axis=0), (mine.T @ mine).ravel()))
        yield pd.DataFrame([(k, v) for k, v in held.items()], columns=["label", "values"]).astype({"label": "int32"})

    rows = labelled.select("__stats", "label").mapInPandas(partial, "label int, values array<double>")
    summed = rows.select("label", F.posexplode("values").alias("i", "value")).groupBy("label", "i").agg(F.sum("value").alias("value"))
    out = {}
    for row in summed.collect():  # two classes times a fixed number of moments
        out.setdefault(row["label"], np.zeros(1 + size + size * size))[row["i"]] = row["value"]
    return {k: (v[0], v[1:1 + size], v[1 + size:].reshape(size, size)) for k, v in out.items()}


def fit(labelled, pooled=SHRINK_POOLED, diagonal=SHRINK_DIAGONAL):
    """The discriminant of rows (__stats, label 0 or 1); None unless both classes occur.

    A class covariance is shrunk towards the pooled one, as if that had been seen in as many rows as there
    are statistics and by ``pooled`` at least, and towards the unit matrix of standardised
    statistics by ``diagonal``, so it has a Cholesky factor whatever the rows.
    """
    moments = _moments(labelled)
    if set(moments) != {0, 1}:
        return None
    n = sum(m[0] for m in moments.values())
    centre = sum(m[1] for m in moments.values()) / n
    spread = np.sqrt(np.maximum(np.diag(sum(m[2] for m in moments.values())) / n - centre**2, 0)) + 1e-6
    means, own = [], []
    for k in (0, 1):
        count, sums, products = moments[k]
        mean = sums / count
        own.append((products / count - np.outer(mean, mean)) / np.outer(spread, spread))
        means.append((mean - centre) / spread)
    shared = sum(moments[k][0] * own[k] for k in (0, 1)) / n
    factors, constants = [], []
    for k in (0, 1):
        size = len(centre)
        lent = min(max(pooled, size / (moments[k][0] + size)), 1 - diagonal)
        factor = np.linalg.cholesky((1 - lent - diagonal) * own[k] + lent * shared + diagonal * np.eye(size))
        factors.append(factor)
        constants.append(float(np.log(moments[k][0] / n) - np.log(np.diag(factor)).sum()))
    return Discriminant(centre, spread, tuple(means), tuple(factors), tuple(constants))


def held_out(doc_id, folds=5):
    """Rows that never teach: the checksum of the id as text is divisible by ``folds``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def classify(docs, labels):
    """(doc_id, held_out, score) and a key of every row; scores from 0 to 1, high for label 1.

    ``labels`` is (doc_id, quality).  All labelled rows outside the held-out fold teach, none of
    the others; a doc_id whose labels disagree, a null label and a null id teach nothing.  The
    inputs of a score are statistics of the whole text alone, computed once and kept as a table.
    Null and empty texts have zero statistics and a score like others.  Without labels of both
    classes every score is the share of label 1 (1 without any label).  Rows that repeat are
    scored each; empty tables give none.
    """
    narrow = keyed(docs.select("doc_id", "text")).select("doc_id", *KEYS, text_statistics(F.col("text")).alias("__stats"))
    known, _ = written(narrow.withColumn("held_out", held_out(F.col("doc_id"))), "quality-statistics")
    agreed = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(
        F.min("quality").alias("label"), F.max("quality").alias("other")
    ).where("label = other")
    taught = known.where("NOT held_out").join(agreed.select("doc_id", "label"), "doc_id").select("__stats", "label")
    model = fit(taught)
    if model is None:
        share = taught.agg(F.avg("label")).first()[0]
        return known.select("doc_id", *KEYS, "held_out", F.lit(1.0 if share is None else float(share)).alias("score"))

    @F.pandas_udf("double")
    def score(stats: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(stats)) if len(stats) else [], dtype="float64")

    return known.select("doc_id", *KEYS, "held_out", score("__stats").alias("score"))


def keep_quality(docs, labels, least=0.3):
    """The rows of ``docs`` with a score of ``least`` or more."""
    bad, _ = written(classify(docs, labels).where(F.col("score") < least).select(*KEYS).distinct(), "quality-bad")
    return keyed(docs).join(sized_broadcast(bad, most=2_000_000), KEYS, "left_anti").select(*docs.columns)
