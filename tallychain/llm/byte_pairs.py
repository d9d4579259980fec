"""Byte-level BPE: texts to token ids with the tiktoken library and a local rank file, ids back to bytes."""

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import functions as F

from tallychain.llm.packing import PATTERN

#: Characters from which on a text is cut before it is matched, and the white space run that is one piece by itself.
CHUNK, LONG_SPACE = 100_000, 4_096
#: Rows that are encoded or decoded at a time.
ROWS = 256

_SPACE = regex.compile(rf"\s{{{LONG_SPACE},}}")
# A match never goes on from one of these characters to the next: white space only starts a match, and
# signs follow letters and digits in none.  Classes that differ between Unicode versions are left out.
_BOUNDARY = regex.compile(r"(?<=\S)(?=\s)|(?<=[A-Za-z0-9一-鿿])(?=[!-/:-@\[-`{-~。，、！？])")


def pieces(text, chunk=CHUNK):
    """(part, whole) of a text, cut where every match of the pattern ends: ``whole`` parts are one match.

    In a run of white space before another character all but the last one are a match of their own; at
    the end of the text all are.  Very long runs are handed out so, as the library's matcher keeps a
    state for each of their characters.  Other texts of over ``chunk`` characters are cut at the first
    boundary behind each ``chunk``; a text without one stays whole.
    """
    start = 0
    if len(text) >= LONG_SPACE:
        for run in _SPACE.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            yield from _cut(text, start, run.start(), chunk)
            yield text[run.start():end], True
            start = end
    yield from _cut(text, start, len(text), chunk)


def _cut(text, start, end, chunk):
    while end - start > chunk:
        found = _BOUNDARY.search(text, start + chunk, end)
        if found is None:
            break
        yield text[start:found.start()], False
        start = found.start()
    if start < end:
        yield text[start:end], False


def encoding_of(ranks, pattern=PATTERN):
    """The library's encoding for the content of a rank file; special tokens are ordinary text."""
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def token_ids(encoding, text, chunk=CHUNK):
    """All ids of a text, as if the library got it whole."""
    if len(text) < min(chunk, LONG_SPACE):
        return _ids(encoding, text)
    parts = [np.array(encoding._encode_single_piece(part), dtype=np.uint32) if whole else _ids(encoding, part) for part, whole in pieces(text, chunk)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)


def _ids(encoding, text):
    return encoding.encode_to_numpy(text, disallowed_special=())


def _ranks(spark, vocabulary):
    """The content of a rank file, read by the driver; as large as the vocabulary, whatever the input."""
    with open(vocabulary, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _slices(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def encode(docs, vocabulary, pattern=PATTERN):
    """(doc_id, ids array<int>) of every row of ``docs`` (doc_id, text).

    Null and empty texts have no ids, null doc_ids stay null, repeated rows are encoded each, an empty
    table gives no rows; other columns are not read.  Whole texts are encoded row by row inside their
    partitions, ``ROWS`` at a time: nothing is shuffled, and a lost executor's tasks run again by themselves.
    """
    content = _ranks(docs.sparkSession, vocabulary)

    def run(batches):
        encoding = encoding_of(content.value, pattern)
        for batch in _slices(batches):
            found = [token_ids(encoding, t.as_py() or "") for t in batch.column("text")]
            offsets = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded, vocabulary, pattern=PATTERN):
    """``encoded`` (doc_id, ids) with ``content``: the raw bytes of the ids, which need not be valid UTF-8; no ids have no bytes.

    The ids of ``ROWS`` rows are decoded in one piece and cut by the lengths of their tokens.
    """
    content = _ranks(encoded.sparkSession, vocabulary)

    def run(batches):
        encoding = encoding_of(content.value, pattern)
        lengths = np.zeros(encoding.n_vocab, dtype=np.int64)
        for token, rank in encoding._mergeable_ranks.items():
            lengths[rank] = len(token)
        for batch in _slices(batches):
            ids = batch.column("ids")
            flat = ids.flatten().to_numpy()
            counts = np.array([n or 0 for n in pc.list_value_length(ids).to_pylist()], dtype=np.int64)
            ends = np.concatenate(([0], np.cumsum(lengths[flat])))[np.concatenate(([0], np.cumsum(counts)))]
            data = encoding.decode_bytes(flat.tolist())
            texts = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, texts.cast(pa.binary())], names=["doc_id", "ids", "content"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, content binary")
