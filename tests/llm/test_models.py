import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallychain.llm import language_model, quality
from tallychain.llm.queries import QUERIES
from tests.llm.conftest import rows_of


def test_quality_on_held_out_labels(spark, sf_dir):
    scored = {r.doc_id: r for r in QUERIES["op1_quality"](spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    assert len(scored) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in scored.items())
    right = [scored[x.doc_id].predicted == x.quality for x in labels if scored[x.doc_id].held_out]
    assert sum(right) >= 0.9 * len(right)


def test_quality_without_labels_and_with_odd_rows(spark, make_docs, texts):
    kinds = "doc_id long, quality int, toxic int"
    none = spark.createDataFrame([], kinds)
    assert {r.score for r in quality.classify(make_docs(rows_of(texts)), none).collect()} == {1.0}
    odd = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (None, 1, 0), (6, None, 0), (7, 1, 0), (7, 1, 0), (9, 0, 0), (999, 1, 0)], kinds)
    rows = rows_of(texts) + [(None, "no id", None, None, None, "", "", "")]
    got = quality.classify(make_docs(rows), odd).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert quality.classify(make_docs([]), odd).count() == 0
    kept = quality.keep_quality(make_docs(rows), odd)
    assert kept.columns == make_docs(rows).columns
    assert kept.count() == sum(r.score >= 0.3 for r in got)


def test_discriminant_is_the_difference_of_log_densities():
    rnd = np.random.default_rng(3)
    cov = [np.diag([1.0, 2.0]), np.array([[1.5, 0.4], [0.4, 0.7]])]
    mean = [np.zeros(2), np.ones(2)]
    model = quality.Discriminant(np.zeros(2), np.ones(2), tuple(mean), tuple(np.linalg.cholesky(c) for c in cov),
                                 tuple(math.log(0.5) - 0.5 * math.log(np.linalg.det(c)) for c in cov))
    x = rnd.normal(size=(20, 2))
    density = [0.5 / math.sqrt(np.linalg.det(c)) * np.exp(-0.5 * np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)) for m, c in zip(mean, cov)]
    assert np.allclose(model.score(x), density[1] / (density[0] + density[1]))


def test_fit_against_numpy(spark):
    """Means, shrunken covariances and priors of Spark's moments against those of the whole matrix."""
    rnd = np.random.default_rng(8)
    size = len(quality.STATISTICS)
    x, y = rnd.normal(size=(60, size)) @ rnd.normal(size=(size, size)) + 3, np.array([0] * 9 + [1] * 51)
    x[y == 0] += 1
    rows = spark.createDataFrame([(list(map(float, a)), int(b)) for a, b in zip(x, y)], "__stats array<double>, label int").repartition(4)
    model = quality.fit(rows)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    own = [np.cov(z[y == k].T, bias=True) for k in (0, 1)]
    pooled = (9 * own[0] + 51 * own[1]) / 60
    for k, n in ((0, 9), (1, 51)):
        lent = max(quality.SHRINK_POOLED, size / (n + size))
        want = (1 - lent - quality.SHRINK_DIAGONAL) * own[k] + lent * pooled + quality.SHRINK_DIAGONAL * np.eye(size)
        assert np.allclose(model.factors[k] @ model.factors[k].T, want, atol=1e-4)
        assert np.allclose(model.means[k], z[y == k].mean(axis=0), atol=1e-4)
        assert math.isclose(model.constants[k], math.log(n / 60) - 0.5 * np.linalg.slogdet(want)[1], abs_tol=1e-3)


def brute_base(docs):
    token = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] + [""]
    taught = Counter(w for i, t in docs if zlib.crc32(str(i).encode()) % 7 != 2 for w in token(t))
    total, words = sum(taught.values()), len(taught)
    return {i: (len(token(t)), sum(taught[w] > 0 for w in token(t)), total, sum(math.log10((taught[w] + 1) / (total + words + 1)) for w in token(t))) for i, t in docs}


@pytest.mark.parametrize("block", [2_000_000, 500])
def test_language_model_counts_and_beats_the_base(spark, sf_dir, monkeypatch, block):
    monkeypatch.setattr(language_model, "BLOCK_TOKENS", block)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = brute_base([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: r for r in language_model.score(docs).collect()}
    assert set(got) == set(want)
    for i, r in got.items():
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[i][:3] and math.isclose(r.base_score, want[i][3], rel_tol=1e-9)
        assert r.score < 0 and math.isclose(r.perplexity, 10 ** (-r.score / r.n_tokens), rel_tol=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_probabilities_sum_to_one(make_docs):
    """One-word texts ask for every symbol at the start of a text; the unknown word stands for the last symbol."""
    words = ["a", "b", "c", "d e", "a a b", "a b a c"] * 4
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 != 2][:len(words)]
    asks = [i for i in range(400, 900) if zlib.crc32(str(i).encode()) % 7 == 2]
    vocabulary = ["a", "b", "c", "d", "e", "unknown"]
    rows = [(i, w, None, None, None, "", "", "") for i, w in zip(ids, words)] + [(i, w, None, None, None, "", "", "") for i, w in zip(asks, vocabulary)]
    rows.append((asks[20], "", None, None, None, "", "", ""))
    got = {r.doc_id: r for r in language_model.score(make_docs(rows)).collect()}
    alone = {w: 10 ** got[i].score for i, w in zip(asks, vocabulary)}
    end = 10 ** got[asks[20]].score
    assert 0 < end < 1 and all(0 < p < 1 for p in alone.values())
    assert sum(alone.values()) < 1 - end + 1e-6  # each is a first word and then an end
    assert alone["a"] > alone["unknown"]


def dense_model(texts, numbers):
    """Probabilities of every word (and an unknown one, the last column) after every word, from whole matrices of counts and tables."""
    size, lm = len(numbers), language_model
    counts = np.zeros((size, size), dtype=np.int64)
    for text in texts:
        words = [""] + text + [""]
        for a, b in zip(words, words[1:]):
            counts[numbers[a], numbers[b]] += 1
    before, word = np.nonzero(counts)
    n = counts[before, word]
    known = counts.sum(axis=0) > 0
    discount = lm._discount((n == 1).sum(), (n == 2).sum())
    tables, root = np.minimum(counts, 1).astype(float), np.minimum(counts.sum(axis=0), 1).astype(float)
    kinds = np.bincount(word, minlength=size)
    root_discount = lm._discount((kinds == 1).sum(), (kinds == 2).sum())
    found = []
    for sweep in range(lm.SWEEPS):
        fresh = (lm.STRENGTH + root_discount * root.sum()) / (known.sum() + 1)
        parent = (tables.sum(axis=0) - root_discount * root + fresh) / (lm.STRENGTH + tables.sum())
        weight = ((lm.STRENGTH + discount * tables.sum(axis=1))[:, None] * parent)[before, word]
        tables = np.zeros(counts.shape)
        tables[before, word] = lm.seat(n, weight, discount, lm._seeds(before, word), 2 * sweep)
        root = lm.seat(tables.sum(axis=0).astype(np.int64), np.full(size, fresh), root_discount, lm._seeds(np.arange(size)), 2 * sweep + 1)
        fresh = (lm.STRENGTH + root_discount * root.sum()) / (known.sum() + 1)
        parent = np.append(tables.sum(axis=0) - root_discount * root + fresh, fresh) / (lm.STRENGTH + tables.sum())
        own = np.append(counts - discount * tables * (counts > 0), np.zeros((size, 1)), axis=1)
        found.append((own + (lm.STRENGTH + discount * tables.sum(axis=1))[:, None] * parent) / (lm.STRENGTH + counts.sum(axis=1))[:, None])
    p = np.mean(found[-lm.KEPT:], axis=0)
    columns = np.append(known, True)
    return p, columns


@pytest.mark.parametrize("block, cell", [(2_000_000, 1_000_000), (40, 60)])
def test_language_model_against_whole_matrices(spark, make_docs, monkeypatch, block, cell):
    """Scores of a small corpus, in one cell and in many, and rows of probabilities that sum to 1."""
    monkeypatch.setattr(language_model, "BLOCK_TOKENS", block)
    monkeypatch.setattr(language_model, "CELL_TOKENS", cell)
    rnd = np.random.default_rng(5)
    texts = [[f"w{int(x)}" for x in rnd.zipf(1.4, size=int(rnd.integers(0, 30))) if x < 60] for _ in range(120)]
    docs = [(i, " ".join(t), None, None, None, "", "", "") for i, t in enumerate(texts)]
    words = sorted({w for t in texts for w in t} | {""})
    hashes = {r.word: r.h for r in spark.createDataFrame([(w,) for w in words], "word string").selectExpr("word", "xxhash64(word) AS h").collect()}
    numbers = {w: k for k, w in enumerate(sorted(words, key=lambda w: (hashes[w], w)))}
    p, columns = dense_model([t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2], numbers)
    assert np.allclose(p[:, columns].sum(axis=1), 1, rtol=0, atol=1e-9)
    for r in language_model.score(make_docs(docs)).collect():
        walk = [""] + texts[r.doc_id] + [""]
        want = sum(math.log10(p[numbers[a], numbers[b]]) for a, b in zip(walk, walk[1:]))
        assert math.isclose(r.score, want, rel_tol=1e-9)


def test_language_model_knows_every_preceding_word(make_docs):
    """Which of 200 equally frequent words comes before decides which one follows."""
    taught = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 7 != 2]
    ask = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 7 == 2][:400]
    rows = [(i, f"a{n % 200} b{n % 200}", None, None, None, "", "", "") for n, i in enumerate(taught[:1600])]
    rows += [(i, f"a{n // 2} b{(n // 2 + n % 2) % 200}", None, None, None, "", "", "") for n, i in enumerate(ask)]
    got = {r.doc_id: r.score for r in language_model.score(make_docs(rows)).collect()}
    assert all(got[right] > got[wrong] + 2 for right, wrong in zip(ask[::2], ask[1::2]))


def test_language_model_seats_are_between_one_and_all():
    customers = np.array([0, 1, 2, 5, 40, 5000])
    seeds = np.arange(6, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for weight in (1e-9, 1.0, 1e9):
        tables = language_model.seat(customers, np.full(6, weight), 0.5, seeds, 1)
        assert (tables <= customers).all() and (tables >= np.minimum(customers, 1)).all()
    assert (tables == customers).all()
    assert (language_model.seat(customers, np.full(6, 1e-9), 0.0, seeds, 1) == np.minimum(customers, 1)).all()


def test_language_model_edges(make_docs, texts):
    got = language_model.score(make_docs(rows_of(texts) + [(None, "null id", None, None, None, "", "", "")])).collect()
    assert len(got) == len(texts) + 1
    assert language_model.score(make_docs([])).count() == 0
    only = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    alone = language_model.score(make_docs([(only, "x y", None, None, None, "", "", "")])).first()
    assert (alone.n_tokens, alone.n_known, alone.train_tokens, alone.base_score, alone.score) == (3, 0, 0, 0.0, 0.0)


def test_language_model_lists_of_words_are_gone_before_texts_are_shuffled(make_docs, texts, monkeypatch):
    """The step that gives blocks their numbers has nothing to shuffle but the blocks and one row of numbers for each."""
    steps, settled = {}, language_model.settled

    def noted(df, name, *folders):
        steps[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return settled(df, name, *folders)

    monkeypatch.setattr(language_model, "settled", noted)
    assert language_model.score(make_docs(rows_of(texts))).count() == len(texts)
    assert "word" not in re.sub(r"Relation \[[^]]*\]", "", steps["lm-texts"]).replace("words#", "") and steps["lm-texts"].count("Join") == 1
    assert "lm-numbers" in steps
