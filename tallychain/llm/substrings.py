"""Removal of repeated substrings: difference-cover anchors, extended to whole windows."""

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from tallychain.llm.texts import settled, sized_broadcast

#: Words of a window; period and cover: for any two places there is a shift below 7 that brings both into the cover.
WINDOW, PERIOD, COVER = 13, 7, (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1


def _spans(text):
    """The words of a text joined by one space as bytes, and where each begins and ends in them."""
    joined = b" ".join((text or "").encode("utf-8", "surrogatepass").split())
    # No word holds a space, so every space ends one.
    spaces = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
    if not joined:
        return joined, spaces, spaces
    return joined, np.concatenate(([0], spaces + 1)), np.append(spaces, len(joined))


def _cover_starts(n):
    """Places of a text of n words at which an anchor begins, ascending."""
    places = (np.arange(0, n, PERIOD)[:, None] + COVER).ravel()
    return places[places <= n - ANCHOR] if n >= WINDOW else places[:0]


def _hashes(joined, begins, ends):
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(joined[a:b]) for a, b in zip(begins.tolist(), ends.tolist())), dtype=np.uint64, count=len(begins)).view(np.int64)


_KEY = ["order_id", "text_hash"]


def _batched(pdf, rows):
    for part in range(0, len(pdf), rows):
        yield pdf.iloc[part:part + rows]


def _frame(columns, parts):
    return pd.DataFrame({c: np.concatenate(p) for c, p in zip(columns, zip(*parts))})


def shared_anchors(source):
    """(anchor): hashes of ``ANCHOR`` words at cover places that two rows or more have; a row counts each once."""

    def emit(batches):
        for pdf in batches:
            for rows in _batched(pdf, 256):
                out = []
                for text in rows["text"]:
                    joined, begins, ends = _spans(text)
                    at = _cover_starts(len(ends))
                    out.append(np.unique(_hashes(joined, begins[at], ends[at + ANCHOR - 1])))
                yield pd.DataFrame({"anchor": np.concatenate(out)})

    return source.select("text").mapInPandas(emit, "anchor long").groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")


def anchors(source):
    """(key, place, anchor) of every cover place.

    Two documents that share ``WINDOW`` words at places i and j share the anchor at i + d and j + d
    for a shift d that brings both into the cover.
    """

    def emit(batches):
        for pdf in batches:
            for rows in _batched(pdf, 256):
                out = []
                for order_id, text_hash, text in zip(*(rows[c] for c in (*_KEY, "text"))):
                    joined, begins, ends = _spans(text)
                    at = _cover_starts(len(ends))
                    out.append((np.full(len(at), order_id, "i8"), np.full(len(at), text_hash, "i8"), at.astype("i4"),
                                _hashes(joined, begins[at], ends[at + ANCHOR - 1])))
                yield _frame((*_KEY, "place", "anchor"), out)

    return source.select(*_KEY, "text").mapInPandas(emit, "order_id long, text_hash long, place int, anchor long")


def windows(candidates):
    """(key, place, w1, w2) of every window over a shared anchor; w1 and w2 are 96 bits of a hash of its words."""

    def emit(batches):
        digest = xxhash.xxh3_128_intdigest
        for pdf in batches:
            for rows in _batched(pdf, 64):
                out = []
                for order_id, text_hash, text, places in zip(*(rows[c] for c in (*_KEY, "text", "places"))):
                    joined, begins, ends = _spans(text)
                    at = np.unique(np.asarray(places, dtype=np.int64)[:, None] - np.arange(PERIOD)[None, :])
                    at = at[(at >= 0) & (at + WINDOW <= len(ends))]
                    values = [digest(joined[a:b]) for a, b in zip(begins[at].tolist(), ends[at + WINDOW - 1].tolist())]
                    halves = [np.array([v >> 64 for v in values], dtype=np.uint64).view("i8"),
                              np.array([v & 0xFFFFFFFF for v in values], dtype=np.uint32).view("i4")]
                    out.append((np.full(len(at), order_id, "i8"), np.full(len(at), text_hash, "i8"), at.astype("i4"), *halves))
                yield _frame((*_KEY, "place", "w1", "w2"), out)

    schema = "order_id long, text_hash long, place int, w1 long, w2 int"
    return candidates.select(*_KEY, "text", "places").mapInPandas(emit, schema)


def covered(n, places):
    """Which of n words windows beginning at ``places`` cover."""
    places = np.asarray(places, dtype=np.int64)
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, places, 1)
    np.add.at(edge, places + WINDOW, -1)
    return np.cumsum(edge)[:n] > 0


def _cut(marked):
    def cut(batches):
        for pdf in batches:
            for rows in _batched(pdf, 256):
                out = []
                for order_id, text, copy, places in zip(*(rows[c] for c in ("order_id", "text", "copy", "places"))):
                    words = (text or "").encode("utf-8", "surrogatepass").split()
                    total = len(words)
                    if copy:
                        words = words if total < WINDOW else []
                    elif places is not None and len(places):
                        words = [w for w, lost in zip(words, covered(total, places)) if not lost]
                    out.append((order_id, total, total - len(words), b" ".join(words).decode("utf-8", "surrogatepass")))
                yield pd.DataFrame(out, columns=["order_id", "n_words", "n_removed", "kept"]).assign(no_id=rows["no_id"].to_numpy())

    left = marked.select("order_id", "no_id", "text", F.coalesce("copy", F.lit(False)).alias("copy"), "places").mapInPandas(
        cut, "order_id long, n_words long, n_removed long, kept string, no_id boolean"
    )
    return left.select(F.when(~F.col("no_id"), F.col("order_id")).alias("doc_id"), "n_words", "n_removed", "kept")


def _copies(source):
    """Keys of rows whose whole text a row with a smaller id has, by 128 bits of it."""
    marked = source.select(*_KEY, F.md5("text").alias("digest"))
    first = marked.groupBy("digest").agg(F.min("order_id").alias("first"), F.max("order_id").alias("last")).where("first < last")
    return marked.join(first.select("digest", "first"), "digest").where("first < order_id").select(*_KEY).distinct()


def dedup(docs):
    """(doc_id, n_words, n_removed, kept) of every row; ``kept`` are the words left, joined by one space.

    A word goes if a window of ``WINDOW`` words over it also begins in a row with a smaller doc_id.
    Copies of a whole text are settled first, as all their windows begin in the first of them.  Of
    the rest, anchors that two rows or more share are extended to the windows over them; windows
    with equal 96-bit hashes are equal.  Counts and smallest ids are hash aggregates, so that what
    many rows share shrinks before the shuffle; the joins back are left to Spark's splitting of
    skewed partitions.  Every step ends in a written table.

    Null texts have no words.  A null doc_id counts as larger than all others.  Rows that repeat a
    doc_id don't remove each other's words.  Tables without rows give none.
    """
    source = docs.select(
        F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("order_id"),
        F.xxhash64("doc_id", "text").alias("text_hash"), "text",
    )
    copies = sized_broadcast(settled(_copies(source), "substring-copies")[0], most=2_000_000)
    fresh = source.join(copies, _KEY, "left_anti")
    shared, folder = settled(shared_anchors(fresh), "substring-anchors")
    found = anchors(fresh).join(shared, "anchor").groupBy(*_KEY).agg(F.collect_set("place").alias("places"))
    found, folder = settled(found, "substring-places", folder)
    seen, folder = settled(windows(fresh.join(found, _KEY)), "substring-windows", folder)
    first = seen.groupBy("w1", "w2").agg(F.min("order_id").alias("first"), F.max("order_id").alias("last")).where("first < last")
    repeats = seen.join(first.select("w1", "w2", "first"), ["w1", "w2"]).where("first < order_id")
    repeats, _ = settled(repeats.groupBy(*_KEY).agg(F.collect_set("place").alias("places")), "substring-repeats", folder)
    return _cut(source.join(copies.withColumn("copy", F.lit(True)), _KEY, "left").join(repeats, _KEY, "left"))
