import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tallychain.llm import simhash
from tallychain.llm.components import connected_components
from tests.llm.conftest import rows_of


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(prints):
    group = {k: k for k in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if bin(prints[a] ^ prints[b]).count("1") <= 2 and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    return group


def test_fingerprints_and_groups(make_docs, texts):
    prints = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    want = brute_groups(prints)
    got = simhash.near_duplicates(make_docs(rows_of(texts))).collect()
    assert {r.doc_id: r.fp % (1 << 64) for r in got} == prints
    assert {r.doc_id: r.component_id for r in got} == want
    kept = simhash.keep_one(make_docs(rows_of(texts)))
    assert kept.columns == make_docs(rows_of(texts)).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


@pytest.mark.parametrize("paired", [64, 1])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, paired):
    """With keys of any size on either route: chains, stars and a far crowd."""
    monkeypatch.setattr(simhash, "PAIRED", paired)
    base = [0x0123456789ABCDEF, 0xF0F0F0F0F0F0F0F0, 0, (1 << 64) - 1]
    values = {b ^ (1 << i) ^ (1 << j) for b in base[:2] for i in range(0, 64, 7) for j in range(0, 64, 9)} | set(base)
    values |= {0b1111 << 4 * k for k in range(16)}
    prints = {v: v for v in values}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.close_links(spark.createDataFrame(signed, "fp long"))
    got = {r.node % (1 << 64): r.component for r in connected_components(links).collect()}
    want = brute_groups(prints)
    classes = {}
    for v in values:
        classes.setdefault(want[v], set()).add(got.get(v, ("alone", v)))
    assert all(len(c) == 1 for c in classes.values())
    assert len({next(iter(c)) for c in classes.values()}) == len(classes)


def test_components(spark):
    edges = [(1, 2), (2, 1), (2, 3), (7, 7), (10, 9), (9, 8), (8, 11)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 10: 8, 11: 8} | {100 + i: 100 for i in range(41)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_null_ids_repeated_rows_and_empty_tables(make_docs):
    rows = [(None, "a b c d", "en", "s", 1, "", "", ""), (None, "a b c d", "en", "s", 1, "", "", ""), (5, "q r s t", "en", "s", 1, "", "", ""),
            (5, "q r s t", "en", "s", 1, "", "", ""), (3, "A B c d", "en", None, 1, "", "", ""), (None, "solo text here", None, None, None, "", "", "")]
    got = simhash.near_duplicates(make_docs(rows))
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got.collect()) == [(0, 0), (0, 3), (0, 3), (3, 3), (5, 5), (5, 5)]
    kept = simhash.keep_one(make_docs(rows)).select(F.coalesce("doc_id", F.lit(0)).alias("i"), "text").collect()
    assert sorted(map(tuple, kept)) == [(0, "solo text here"), (3, "A B c d"), (5, "q r s t")]
    assert simhash.near_duplicates(make_docs([])).count() == simhash.keep_one(make_docs([])).count() == 0
