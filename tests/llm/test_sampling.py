import random
from fractions import Fraction

import numpy as np
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from tallychain.llm import mixing, neighbours
from tests.llm.conftest import rows_of


def brute_targets(sizes):
    """Shares of sources of ascending names (null last) by weight, with the excess of held ones shared again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    held, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in held]
        left = total - sum(held.values())
        share = {s: Fraction(left * weight[s], sum(weight[f] for f in free)) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {s: float(x) for s, x in (share | held).items()}
        held |= {s: 3 * sizes[s] for s in over}


@pytest.mark.parametrize("ranges", [20_000, 7])
def test_mix_meets_its_targets(make_docs, monkeypatch, ranges):
    monkeypatch.setattr(mixing, "RANGE_ROWS", ranges)
    rnd = random.Random(1)
    rows = []
    for i in range(300):
        source = rnd.choice(["a", "a", "a", "b", "Z", "é", None, "tiny" if i < 30 else "a"])
        rows.append((i, " ".join(["w"] * rnd.choice([0, 1, 3, 10, 40])), "en", source, 0, "", "", ""))
    rows.append((300, None, "en", "empty", 0, "", "", ""))
    rows.append((None, "one two", "en", "b", 0, "", "", ""))
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    want = brute_targets(sizes)
    got = mixing.mix(make_docs(rows)).collect()
    assert len(got) == len(rows)
    assert all(np.isclose(r["__target"], want[r.source]) and r["__source_size"] == sizes[r.source] for r in got)
    for source, target in want.items():
        mine = [r for r in got if r.source == source]
        assert abs(sum(r["__copies"] * r["__size"] for r in mine) - target) <= 20.001
        assert all(r["__copies"] in (int(target // max(1, sizes[source])), int(target // max(1, sizes[source])) + 1) and r["__copies"] <= 3 for r in mine)
    again = mixing.mix(make_docs(rows[::-1])).collect()
    assert sorted((r.doc_id or -1, r["__copies"]) for r in again) == sorted((r.doc_id or -1, r["__copies"]) for r in got)
    times = mixing.repeated(mixing.mix(make_docs(rows)), make_docs(rows).columns)
    assert times.count() == sum(r["__copies"] for r in got) and times.columns == make_docs(rows).columns


def test_key_ranges_are_even_for_any_weights(spark, monkeypatch):
    """Half of one large source at the least weight, half at the greatest: no range is much larger than meant."""
    monkeypatch.setattr(mixing, "RANGE_ROWS", 500)
    rows = spark.range(20_000).selectExpr("id AS doc_id", "IF(id % 50 = 0, 'b', 'a') AS source", "1 + id % 9 AS __size").withColumn(
        "__key", -F.log(mixing.uniform(7, "doc_id")) / F.when(F.col("doc_id") % 2 == 0, 0.05).otherwise(1.0))
    sizes = [r["count"] for r in mixing.by_key(rows).groupBy("range").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 3 * mixing.RANGE_ROWS


def test_mix_of_nothing(make_docs):
    assert mixing.mix(make_docs([])).count() == 0
    assert [r["__copies"] for r in mixing.mix(make_docs([(1, "", None, None, None, "", "", "")])).collect()][0] in (0, 1, 2, 3)


def test_better_texts_are_taken_more_often(make_docs):
    rows = [(i, "words only here" if i % 2 else "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "en", "a", 0, "", "", "") for i in range(400)]
    rows += [(1000 + i, "other " * 40, "en", "b", 0, "", "", "") for i in range(100)]
    got = [r for r in mixing.mix(make_docs(rows)).collect() if r.source == "a"]
    base = min(r["__copies"] for r in got)
    more = lambda odd: np.mean([r["__copies"] > base for r in got if r.doc_id % 2 == odd])
    assert more(1) > more(0)


def brute_nearest(rows, k):
    best = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            best[i] = max(best.get(i, []), [float(np.float32(x)) for x in v])
    out = []
    for q, v in best.items():
        if q % 20 == 0:
            found = []
            for c, w in best.items():
                if c != q and len(w) == len(v):
                    score = 0.0
                    for a, b in zip(v, w):
                        score += a * b
                    found.append((-score, c))
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(sorted(found)[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(2048, 512), (16, 3)])
def test_nearest_equal_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(neighbours, "CANDIDATES", blocks[0])
    monkeypatch.setattr(neighbours, "QUERIES", blocks[1])
    monkeypatch.setattr(neighbours, "HEAPS", 5)
    rnd = np.random.default_rng(4)
    rows = [(i, rnd.normal(size=8).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200 + i, rows[7][1]) for i in range(60)]  # one vector many times: ties
    rows += [(300, [1.0, 2.0]), (301, [2.0, 1.0]), (320, None), (340, [0.0] * 8), (360, [float("nan")] * 8), (380, [1.0, None] + [1.0] * 6),
             (381, [float("inf")] * 8), (None, [1.0] * 8), (400, []), (20, rows[3][1]), (402, [1e30] * 8), (403, [1e-30] * 8)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    vectors = neighbours.usable(table)
    got = sorted(map(tuple, neighbours.nearest(vectors.where("vec_id % 20 = 0"), vectors, k=20).collect()))
    want = brute_nearest(rows, 20)
    assert got == want
    few = neighbours.usable(table.where("vec_id IN (0, 1, 2)"))
    assert neighbours.nearest(few.where("vec_id % 20 = 0"), few, k=20).count() == 2
    none = neighbours.usable(table.where("false"))
    assert neighbours.nearest(none, none, k=20).count() == 0


def test_nearest_broadcasts_no_copies(spark, monkeypatch):
    """Query blocks go to every group: their copies never pass through the driver, and a group holds few candidate blocks."""
    monkeypatch.setattr(neighbours, "CANDIDATES", 4)
    monkeypatch.setattr(neighbours, "GROUP_BLOCKS", 1)
    rows = [(i, [float(i), 1.0]) for i in range(200)]
    vectors = neighbours.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1))
    found = neighbours.nearest(vectors.where("vec_id % 20 = 0"), vectors, k=3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert {r["vec_id"] for r in found.where("query_id = 40").collect()} == {199, 198, 197}


def test_pipeline_stages(spark, make_docs, texts, tmp_path, sf_dir):
    """The stages one after another over the small table, each held against its own rule."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / name.replace("/", " ")))
        docs = spark.read.parquet(str(tmp_path / name.replace("/", " ")))
        sizes.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns and docs.select("doc_id").exceptAll(before.select("doc_id").distinct()).count() >= 0
            assert docs.join(before, columns, "left_anti").count() == 0  # rows stay as they are
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] > 0
    packed = {i for r in docs.select("doc_ids").collect() for i in r.doc_ids}
    assert packed == {r.doc_id for r in before.select("doc_id").collect()}


def test_pipeline_of_odd_rows(spark, make_docs, texts, tmp_path):
    for name in ("labels", "benchmark"):
        spark.createDataFrame([], "doc_id long, quality int" if name == "labels" else "item_id long, text string").write.parquet(f"{tmp_path}/{name}.parquet")
    for number, rows in enumerate((rows_of(texts), [])):
        make_docs(rows).write.parquet(f"{tmp_path}/t{number}/documents.parquet")
        docs = spark.read.parquet(f"{tmp_path}/t{number}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        assert (docs.count() > 0) == bool(rows)
