"""Token ids in packed rows: best-fit-decreasing with a segment tree over free space."""

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

# The split pattern that belongs to the byte-level vocabularies of 50,000 merges, and their free id for the end of a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50256

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LENGTH = 2048
#: Tokens a task gathers before it packs them; the more, the fuller the rows.
GATHERED = 4_000_000

_SCHEMA = "doc_ids array<bigint>, pieces array<int>, cu_seqlens array<int>, resets array<int>, n_tokens int, input_ids array<int>"


class FreeSpace:
    """Open rows by free space, in a segment tree that finds the least space of at least a given size."""

    def __init__(self, length):
        self.width = 1 << length.bit_length()
        self.count = [0] * (2 * self.width)
        self.rows = [[] for _ in range(length + 1)]

    def _add(self, space, n):
        node = space + self.width
        while node:
            self.count[node] += n
            node >>= 1

    def put(self, row, space):
        if space:
            self.rows[space].append(row)
            self._add(space, 1)

    def take(self, size):
        """A row with the least free space of ``size`` or more, and that space; None if there is none."""
        node = size + self.width
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):  # nothing to the right under this parent
                node >>= 1
            if node <= 1:
                return None
            node += 1
        while node < self.width:
            node *= 2
            if not self.count[node]:
                node += 1
        space = node - self.width
        self._add(space, -1)
        return self.rows[space].pop(), space


def best_fit_decreasing(sizes, length):
    """For each size (1..length) the row it goes to; the largest are placed first, each in the fullest row that holds it."""
    free, rows, made = FreeSpace(length), np.zeros(len(sizes), dtype=np.int64), 0
    for i in np.argsort(-np.asarray(sizes), kind="stable").tolist():
        size = int(sizes[i])
        found = free.take(size)
        if found is None:
            row, space, made = made, length, made + 1
        else:
            row, space = found
        rows[i] = row
        free.put(row, space - size)
    return rows


def _lists(parts, kind):
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(kind)))


def _packed(segments, length, pad):
    """One record batch: ``segments`` are (doc_id, piece, ids) with at most ``length`` ids each."""
    sizes = [len(s[2]) for s in segments]
    rows = best_fit_decreasing(sizes, length)
    order = np.argsort(rows, kind="stable")
    bounds = np.searchsorted(rows[order], np.arange(rows.max() + 2)) if len(rows) else [0]
    ids, docs, pieces, ends, resets, used = [], [], [], [], [], []
    for a, b in zip(bounds[:-1], bounds[1:]):
        mine = [segments[i] for i in order[a:b]]
        edge = np.concatenate(([0], np.cumsum([len(s[2]) for s in mine])))
        row = np.full(length, pad, dtype=np.int32)
        row[:edge[-1]] = np.concatenate([s[2] for s in mine])
        ids.append(row)
        docs.append([s[0] for s in mine])
        pieces.append(np.array([s[1] for s in mine], dtype=np.int32))
        ends.append(edge)
        resets.append(edge[:-1])
        used.append(int(edge[-1]))
    return pa.RecordBatch.from_arrays(
        [pa.array(docs, type=pa.list_(pa.int64())), _lists(pieces, np.int32), _lists(ends, np.int32), _lists(resets, np.int32),
         pa.array(used, type=pa.int32()), _lists(ids, np.int32)],
        names=["doc_ids", "pieces", "cu_seqlens", "resets", "n_tokens", "input_ids"],
    )


def _encoder(vocabulary):
    """Encodes a text to ids; the vocabulary comes as bytes, so that executors need no file."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pack(docs, vocabulary=VOCABULARY, length=LENGTH, end=END, gathered=GATHERED):
    """Rows of ``length`` token ids: (doc_ids, pieces, cu_seqlens, resets, n_tokens, input_ids).

    A document is its ids and ``end``.  It is cut into pieces of ``length`` ids, numbered from 0, of
    which the last may be shorter, so joining a document's pieces gives all its ids.  Each task
    packs its own documents as they come, about ``gathered`` ids at a time: nothing is shuffled, and
    a task's memory does not grow with its input.  ``cu_seqlens`` has the bounds of a row's pieces,
    from 0 to ``n_tokens``; ``resets`` the offsets at which positions begin at 0 again.  What is
    left of a row is filled with ``end``.

    Null and empty texts are one piece, the end alone.  Null doc_ids stay null.  Repeated rows are
    packed each.  An empty table gives no rows.  ``vocabulary`` is a file of ranks that the driver
    reads; its size is that of the vocabulary.
    """
    with open(vocabulary, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        encoding = _encoder(content.value)
        segments, held = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.array(encoding.encode_ordinary(text.as_py() or "") + [end], dtype=np.int32)
                for piece, at in enumerate(range(0, len(ids), length)):
                    segments.append((doc_id, piece, ids[at:at + length]))
                held += len(ids)
                if held >= gathered:
                    yield from _sliced(_packed(segments, length, end))
                    segments, held = [], 0
        if segments:
            yield from _sliced(_packed(segments, length, end))

    def _sliced(batch, rows=512):
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SCHEMA)


def positions(cu_seqlens, length):
    """Position of each id of a row: counts from 0 at each reset; 0 in what is left."""
    out = np.zeros(length, dtype=np.int32)
    for a, b in zip(cu_seqlens[:-1], cu_seqlens[1:]):
        out[a:b] = np.arange(b - a)
    return out


def write_packed(packed, folder):
    """The rows as Parquet: id matrices, cumulative lengths and resets side by side, one row group after another."""
    packed.write.mode("overwrite").parquet(folder)
