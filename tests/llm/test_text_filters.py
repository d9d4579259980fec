import hashlib
import re
from collections import defaultdict

import duckdb
import pytest

from tallychain.llm import decontaminate, substrings
from tallychain.llm.oracles import ORACLES
from tallychain.llm.queries import QUERIES
from tests.llm.conftest import rows_of

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_hits(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = WORDS.findall(lower(text))
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i:i + n])].add(item)
    out = []
    for doc, text in docs:
        words, hit, found = WORDS.findall(lower(text)), set(), set()
        for i in range(len(words)):
            for n in range(1, 11):
                names = windows.get(tuple(words[i:i + n])) if i + n <= len(words) else None
                if names:
                    hit |= set(range(i, i + n))
                    found |= names
        out.append((doc, len(words), len(hit), sorted(map(str, found - {None}))))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def items(texts):
    body = [t for t in texts if t and 40 < len(t) < 2000]
    take = lambda t, a, b: " ".join(t.split()[a:b])
    return [(1, take(body[0], 2, 14)), (2, take(body[1], 0, 10)), (3, take(body[2], 4, 25).upper()), (30, take(body[2], 4, 25)), (4, "Two; WORDS"), (5, "one"),
            (6, take(body[3], 1, 6)), (7, ""), (8, None), (9, "no such words at all in any of these texts here"), (None, take(body[4], 0, 12)),
            (10, " ".join(["same"] * 12)), (11, take(body[0], 2, 14))]


def test_decontamination_equals_brute_force(spark, make_docs, texts, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = rows_of(texts)
    rows.append(rows[6])
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in decontaminate.occurrences(make_docs(rows), bench).collect()), key=str)
    want = brute_hits([(r[0], r[1]) for r in rows], items)
    assert got == want
    clean = decontaminate.drop_contaminated(make_docs(rows), bench)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(w[0] for w in want if not w[2])
    assert clean.columns == make_docs(rows).columns


def test_decontamination_of_empty_tables(spark, make_docs, texts):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.occurrences(make_docs([]), none).count() == 0
    assert {r.n_hit for r in decontaminate.occurrences(make_docs(rows_of(texts)), none).collect()} == {0}


def brute_substrings(docs):
    first = {}
    for doc, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        for i in range(len(words) - 12):
            key = tuple(words[i:i + 13])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in docs:
        words, gone = re.findall(r"[^\x20\x09-\x0D]+", text or ""), set()
        for i in range(len(words) - 12):
            if first[tuple(words[i:i + 13])] < doc:
                gone |= set(range(i, i + 13))
        out.append((doc, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out)


def test_substrings_equal_brute_force(make_docs, texts):
    rows = rows_of(texts + [texts[8], f"{texts[20]}", "q " * 40, "q " * 13])
    rows += [rows[9], rows[9]]
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.dedup(make_docs(rows)).collect())
    assert got == brute_substrings([(r[0], r[1]) for r in rows])


@pytest.mark.parametrize("text", [None, "", " \t\r\n", "a", " a ", "a\x0bb\x0c c\r\nd", "\u00e9\x00 \x1c \u2003b", "\ud800 x", " ".join(f"w{i}" for i in range(30))])
def test_spans_are_those_of_the_words(text):
    words = (text or "").encode("utf-8", "surrogatepass").split()
    joined, begins, ends = substrings._spans(text)
    assert [joined[a:b] for a, b in zip(begins, ends)] == words
    starts = [i for i in range(len(words) - substrings.ANCHOR + 1) if i % substrings.PERIOD in substrings.COVER]
    assert substrings._cover_starts(len(words)).tolist() == (starts if len(words) >= substrings.WINDOW else [])


def test_cover_brings_any_two_places_together():
    for i in range(substrings.PERIOD):
        for j in range(substrings.PERIOD):
            assert any((i + d) % 7 in substrings.COVER and (j + d) % 7 in substrings.COVER for d in range(substrings.PERIOD))


def test_substrings_with_null_ids_and_empty_tables(make_docs):
    text = " ".join(f"n{i}" for i in range(15))
    rows = [(None, text, None, None, None, "", "", ""), (4, f"a {text}", None, None, None, "", "", ""), (None, None, None, None, None, "", "", "")]
    got = {(r.doc_id, r.n_words): (r.n_removed, r.kept) for r in substrings.dedup(make_docs(rows)).collect()}
    assert got == {(None, 15): (15, ""), (4, 16): (0, f"a {text}"), (None, 0): (0, "")}
    assert substrings.dedup(make_docs([])).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    found = QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    key = lambda r: tuple(f"{x:.12g}" if isinstance(x, float) else str(x) for x in r)
    assert sorted(map(key, want)) == sorted(map(key, (tuple(r) for r in found.select(*columns).collect())))


def test_digests_are_those_of_the_kept_words(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r.doc_id: hashlib.sha256(r.kept.encode()).hexdigest() for r in substrings.dedup(docs).collect()}
    assert kept == {r.doc_id: r.kept_sha256 for r in QUERIES["op8_substrings"](spark, sf_dir).collect()}
