"""Manifest, spelling variants and byte pairs against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest

from tallychain.llm import byte_pairs, manifest, spelling
from tallychain.llm.queries import QUERIES
from tests.llm.conftest import rows_of

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, more=0):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    n_chars = None if row["n_chars"] is None else row["n_chars"] + more
    return sha("".join(map(field, (row["doc_id"], row["source"], row["lang"], n_chars, row["text"]))))


def tree(nodes):
    """Root and the proofs of all nodes."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            other = place ^ 1
            paths[i].append((nodes[other] if other < len(nodes) else "", place % 2 == 1))
            at[i] = place // 2
        nodes = [sha("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def folded(node, path):
    for sibling, before in path:
        node = sha(sibling + node if before else node + sibling)
    return node


def brute_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for lang in langs:
        mine = sorted(groups[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees.append((mine, *tree([leaf(r) for r in mine])))
    root, above = tree([t[1] for t in trees]) if trees else (None, [])
    for (mine, subroot, paths), high in zip(trees, above):
        for r, path in zip(mine, paths):
            changed = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            got = folded(leaf(r, 1 if changed else 0), path + high)
            yield (r["doc_id"], leaf(r), subroot, root, sha("".join(s for s, _ in path + high)), got, got == root)


def compared(rows):
    return sorted(map(repr, map(tuple, rows)))


@pytest.mark.parametrize("levels", [1, 3, 10])
def test_manifest(spark, make_docs, texts, monkeypatch, levels, tmp_path):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    monkeypatch.setattr(manifest, "WIDTH", 1 << levels)
    rows = [dict(doc_id=i, text=t, lang=["en", None, "de", "en", "é"][i % 5], source=None if i % 4 == 0 else "s", n_chars=None if i % 6 == 0 else i)
            for i, t in enumerate(texts * 2)]
    rows += [dict(rows[3]), dict(rows[3]), dict(rows[3], text="other"), dict(doc_id=None, text="x", lang="en", source="s", n_chars=1), dict(doc_id=9, text=None, lang="solo", source="s", n_chars=14)]
    docs = make_docs([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "leaf", "7", "pos") for r in rows])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_manifest"](spark, str(tmp_path)).collect()
    assert compared(got) == compared(brute_manifest(rows))
    assert not all(r.verified for r in got) and sum(r.verified for r in got) > len(got) / 2


def test_manifest_of_few_rows(make_docs):
    assert manifest.documents_manifest(make_docs([])).count() == 0
    one = manifest.documents_manifest(make_docs(rows_of(["a"]))).first()
    assert one.leaf == one.subroot == one.root and one.path == [] and one.verified


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_variants(docs, length=7, damaged=31):
    count = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % damaged == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= length and n >= 2}
    found = {}
    for w, n in words.items():
        others = [v for v in words if near(v, w)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        found[w] = (best if best is not None and words[best] >= 10 * n else None, len(others))
    for w, n in words.items():
        root = w
        while found[root][0] is not None:
            root = found[root][0]
        yield (w, found[w][0], root, n, found[w][1], words.get(found[w][0]))


@pytest.fixture
def many_ranges(spark):
    """Small test data stays in several ranges."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


@pytest.fixture(scope="module")
def spelled():
    import random

    rnd = random.Random(3)
    base = ["aabbaabb", "straßeneck", "Ärgerlich", "collection", "wwwwwwwww", "tallying", "balances"]
    texts = []
    for i in range(200):
        words = []
        for _ in range(40):
            w = rnd.choice(base[:1 + i % len(base)])
            for _ in range(rnd.choice([0, 0, 0, 0, 1, 1, 2])):
                at, c = rnd.randrange(len(w)), rnd.choice("abwäß×")
                w = rnd.choice([w[:at] + w[at + 1:], w[:at] + c + w[at:], w[:at] + c + w[at + 1:]])
            words.append(w)
        texts.append(rnd.choice([" ", ", ", "\n"]).join(words))
    texts += [None, "", "short words only", "q" * 30_000, "q" * 30_000, "Q" * 29_999 + " " + "q" * 29_999, "1234567 日本語日本語日本語"]
    return texts


def test_spelling(make_docs, spelled, many_ranges):
    docs = list(enumerate(spelled)) + [(None, "collection collections"), (5, spelled[5]), (5, spelled[5])]
    got = spelling.variants(make_docs([(i, t, "en", "s", 1, "word", "k", "root") for i, t in docs])).collect()
    want = list(brute_variants(docs))
    assert len(want) > 300 and sum(w[1] is not None for w in want) > 50
    assert any(w[2] not in (w[0], w[1]) for w in want)
    assert compared(got) == compared(want)


def test_spelling_without_words(make_docs):
    assert spelling.variants(make_docs([])).count() == 0
    assert spelling.variants(make_docs(rows_of([None, "", "a b"]))).count() == 0


def test_nodes_are_shared_across_ranges(spark, many_ranges):
    words = sorted({"ab" * (i % 7) + format(i, "b") for i in range(300)})
    table, _ = spelling.trie_nodes(spark.createDataFrame([(w,) for w in words], "word string").repartition(5), "pre")
    same = spelling.same_nodes(table, "pre")
    rows = {r.word: [same.get(x, x) for x in r.pre] for r in table.collect()}
    assert table.select("part").distinct().count() > 1 and same
    nodes = {}
    for w, path in rows.items():
        for depth, node in enumerate(path):
            nodes.setdefault(node, set()).add(w[:depth])
    assert all(len(v) == 1 for v in nodes.values())
    assert len({next(iter(v)) for v in nodes.values()}) == len(nodes)


def digests(ids, content):
    return len(ids), sha(",".join(map(str, ids))), hashlib.sha256(content).hexdigest()


def test_byte_pairs(spark, make_docs, texts, tmp_path):
    more = [None, "", "a'sb'll 12 x", "  two  spaces \n\n", "日本語、テスト。", "  x\u0085", "emoji 👩‍👩‍👧 é", "<|endoftext|>", "a" * 200_000, "x" + " " * 50_000 + "y\n" + "\n" * 9_000]
    docs = make_docs(rows_of(texts + more) + rows_of(texts[:4]))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    encoding = byte_pairs.encoding_of(open(MULTI, "rb").read())
    want = [(r.doc_id, *digests(ids := encoding.encode_ordinary(r.text or ""), (r.text or "").encode())) for r in docs.collect()]
    got = QUERIES["op13_byte_pairs"](spark, str(tmp_path))
    assert compared(got.collect()) == compared(want)
    assert byte_pairs.decode(byte_pairs.encode(make_docs([]), MULTI), MULTI).count() == 0


def test_ids_against_merges_by_hand():
    """The lowest rank merges first, match by match."""
    encoding = byte_pairs.encoding_of(open(MULTI, "rb").read())
    ranks = encoding._mergeable_ranks

    def merged(piece):
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while True:
            pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not pairs:
                return [ranks[p] for p in parts]
            i = min(pairs)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    import regex

    for text in ["Hello, world's  best\n\n tests 2024!", "Füße über Straßen", "naïve 日本 語", " \t x"]:
        want = [i for m in regex.findall(byte_pairs.PATTERN, text) for i in merged(m.encode())]
        assert byte_pairs.token_ids(encoding, text).tolist() == want


@pytest.mark.parametrize("chunk", [1, 7, 50])
def test_cuts_change_no_ids(texts, chunk, monkeypatch):
    monkeypatch.setattr(byte_pairs, "LONG_SPACE", 3)
    import regex

    monkeypatch.setattr(byte_pairs, "_SPACE", regex.compile(r"\s{3,}"))
    encoding = byte_pairs.encoding_of(open(MULTI, "rb").read())
    odd = ["a   b", "   a", "a   ", "  \n x", "x'll 's's''s 12a3.b c", "日本。語、x!y 12,3-4", "a\n\n\n\nb \n \n c", "don't'x"]
    for text in [t or "" for t in texts if t is None or len(t) < 5_000] + odd:
        assert "".join(p for p, _ in byte_pairs.pieces(text, chunk)) == text
        assert byte_pairs.token_ids(encoding, text, chunk).tolist() == encoding.encode_ordinary(text)


def test_space_runs_that_the_library_cannot_match():
    encoding = byte_pairs.encoding_of(open(MULTI, "rb").read())
    text = "x" + " " * 1_500_000 + "y"
    ids = byte_pairs.token_ids(encoding, text)
    assert encoding.decode_bytes(ids.tolist()).decode() == text
