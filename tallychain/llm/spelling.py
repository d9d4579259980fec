"""Spelling variants: words one edit apart, found by integer pairs of trie nodes, and the form each word stands for."""

import re
import zlib
from collections import Counter
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallychain.llm.ranks import numbered
from tallychain.llm.texts import sized_broadcast
from tallychain.session import drop_folder, written

#: Shortest word, least occurrences, and how much more frequent a form is than the word it stands for.
LENGTH, OCCURRENCES, RATIO = 7, 2, 10
#: One run in so many, by its checksum, loses one letter.
DAMAGED = 31
#: Distinct words that a task counts before it hands its counts on.
COUNTED = 300_000
WHOLE, SKIPPED, FIRST_SKIPPED = 0, 1, 2


def run_words(doc_id, text, length=LENGTH, damaged=DAMAGED):
    """Counts of the words of one text: its runs of letters in lower case, some of them one letter short."""
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # of bytes: A-Z only
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found = Counter()
    # Shorter runs cannot become words; the pattern takes every other run as a whole.
    for run, n in Counter(re.findall(f"[a-zÀ-ÿ]{{{length},}}", lowered)).items():
        check = zlib.crc32(run.encode(), start)
        if check % damaged == 0:
            at = check % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= length:
            found[run] += n
    return found


def word_counts(docs, length=LENGTH, damaged=DAMAGED, occurrences=OCCURRENCES):
    """(word, n) over all rows: tasks count what they read, Spark adds the counts up."""

    def counts(total):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(total.keys()), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    def run(batches):
        total = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                total.update(run_words(doc_id, text.as_py() or "", length, damaged))
                if len(total) > COUNTED:
                    yield counts(total)
                    total = Counter()
        yield counts(total)

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


def trie_nodes(words, name, backwards=False):
    """``words`` as a written table with ``name``: the numbers of the trie nodes on the way to the word, the root first; and its folder.

    Sorted words share with the one before just the nodes of their common prefix, so one pass over
    a range of them numbers its nodes.  ``backwards`` reads words from their end.  A range starts with nodes of its
    own even where they exist already; ``same_nodes`` says which.
    """

    def run(batches):
        part, made, before, stack = TaskContext.get().partitionId(), 0, "", []
        for batch in batches:
            paths = []
            for word in batch.column("word").to_pylist():
                if backwards:
                    word = word[::-1]
                stack = stack[:len(commonprefix([before, word])) + 1]
                new = len(word) + 1 - len(stack)
                stack = stack + [(part << 40) + made + i for i in range(new)]
                made, before = made + new, word
                paths.append(stack)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(paths), pa.int32()), pa.array(paths, pa.list_(pa.int64()))],
                names=[*batch.schema.names, "part", name])

    rows = words.withColumn("key", F.reverse("word") if backwards else F.col("word"))
    rows = rows.repartitionByRange("key").sortWithinPartitions("key").drop("key")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return written(rows.mapInArrow(run, f"{columns}, part int, {name} array<long>"), f"spelling-{name}")


def same_nodes(table, name, backwards=False):
    """{number: the number to use} for nodes that lie in several ranges.

    Only the first and the last word of each range meet in the driver: a prefix that both have which
    meet at a border is one node.
    """
    key = F.reverse("word") if backwards else F.col("word")
    ends = table.groupBy("part").agg(F.min_by(F.struct(key.alias("word"), name), key).alias("first"), F.max_by(F.struct(key.alias("word"), name), key).alias("last"))
    same, before = {}, None
    for row in ends.orderBy("part").collect():
        if before is not None:
            for depth in range(len(commonprefix([before["word"], row["first"]["word"]])) + 1):
                older = before[name][depth]
                same[row["first"][name][depth]] = same.get(older, older)
        before = row["last"]
    return same


def _pairs(table, prefixes, suffixes):
    """(prefix, suffix, k, kind): every way to read a word as a prefix and a suffix, whole or with one position skipped."""
    spark = table.sparkSession
    maps = spark.sparkContext.broadcast([tuple(np.array(sorted(m.items()), dtype=np.int64).reshape(-1, 2).T) for m in (prefixes, suffixes)])

    def named(nodes, mapping):
        old, new = mapping
        if not len(old):
            return nodes
        at = np.minimum(np.searchsorted(old, nodes), len(old) - 1)
        return np.where(old[at] == nodes, new[at], nodes)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2_000):
                yield from emitted(batch.slice(start, 2_000))

    def emitted(batch):
        words, k = batch.column("word").to_pylist(), batch.column("k").to_numpy()
        if not words:
            return
        lengths = np.array([len(w) for w in words])
        letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        pre, suf = (named(batch.column(c).flatten().to_numpy(), m) for c, m in zip(("pre", "suf"), maps.value))
        nodes = first + np.arange(len(words))  # one node more than letters each
        repeats = lengths + 1
        word = np.repeat(np.arange(len(words)), repeats)
        i = np.arange(len(pre)) - nodes[word]
        whole = pre, suf[nodes[word] + lengths[word] - i], k[word], np.full(len(word), WHOLE)
        word = np.repeat(np.arange(len(words)), lengths)
        i = np.arange(len(letters)) - first[word]
        again = (i > 0) & (letters == np.roll(letters, 1))
        skipped = pre[nodes[word] + i], suf[nodes[word] + lengths[word] - 1 - i], k[word], np.where(again, SKIPPED, FIRST_SKIPPED)
        columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(whole[:3], skipped[:3])]
        kind = pa.array(np.concatenate((whole[3], skipped[3])).astype(np.int8))
        yield pa.RecordBatch.from_arrays([*columns, kind], names=["prefix", "suffix", "k", "kind"])

    return table.select("word", "k", "pre", "suf").mapInArrow(run, "prefix long, suffix long, k long, kind byte")


def near_words(pairs):
    """(k, n_near, best) of words with near words: how many, and the smallest ``k`` among them.

    Rows of one pair of nodes are at most one whole word and one word for each letter
    in the skipped position, so a group is as large as the alphabet at most.  Words that skip a position there
    differ in one letter; the whole word lacks the letter that they skip.  Of equal letters
    side by side only the first one counts as skipped then, so that every near word is met once.
    """
    group = Window.partitionBy("prefix", "suffix")
    k, kind = F.col("k"), F.col("kind")
    skips, firsts, whole = F.when(kind != WHOLE, k), F.when(kind == FIRST_SKIPPED, k), F.when(kind == WHOLE, k)
    ordered = group.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = pairs.select("k", "kind", F.count(skips).over(ordered).alias("skips"), F.count(firsts).over(ordered).alias("firsts"),
                        F.max(whole).over(ordered).alias("whole"), F.min(firsts).over(ordered).alias("first"),
                        F.nth_value(skips, 1, True).over(ordered).alias("one"), F.nth_value(skips, 2, True).over(ordered).alias("two"))
    other = F.when(F.col("one") == k, F.col("two")).otherwise(F.col("one"))
    lacking = F.when(kind == FIRST_SKIPPED, F.col("whole"))
    number = F.when(kind == WHOLE, F.col("firsts")).otherwise(F.col("skips") - 1 + lacking.isNotNull().cast("long"))
    best = F.when(kind == WHOLE, F.col("first")).otherwise(F.least(other, lacking))
    met = rows.select("k", number.alias("number"), best.alias("best")).where("number > 0")
    return met.groupBy("k").agg(F.sum("number").alias("n_near"), F.min("best").alias("best"))


def _roots(forms):
    """(k, root) from (k, form, n of it): forms are followed to the last by doubling the steps.

    Every form is ``RATIO`` times as frequent, so the largest count bounds the steps.
    """
    top = forms.agg(F.max("form_n")).first()[0] or 1
    steps, rounds = len(str(top)), 0
    links, folder = written(forms.select("k", F.col("form_k").alias("root")), "spelling-roots")
    while 1 << rounds < steps:
        onward = sized_broadcast(links.select(F.col("k").alias("root"), F.col("root").alias("next")))
        longer, newer = written(links.join(onward, "root", "left").select("k", F.coalesce("next", "root").alias("root")), "spelling-roots")
        drop_folder(forms.sparkSession, folder)
        links, folder, rounds = longer, newer, rounds + 1
    return links, folder


def variants(docs, length=LENGTH, occurrences=OCCURRENCES, ratio=RATIO, damaged=DAMAGED):
    """(word, form, root, n, n_near, form_n) of every word of ``docs`` (doc_id, text).

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, of ``length`` letters or more and met ``occurrences``
    times or more in all texts.  Near words are one inserted, deleted or replaced letter apart, all of them
    are found.  The form is the most frequent near word, of equal ones the first in code-point order, if it is ``ratio`` times as
    frequent as the word.

    Null and empty texts have no words; a null doc_id counts as empty in the checksum; repeated rows count
    each; other columns are not read; texts without words and an empty table give no rows.  Runs of any length are
    taken whole.
    """
    spark, folders = docs.sparkSession, []

    def kept(pair):
        folders.append(pair[1])
        return pair[0]

    counted = kept(written(word_counts(docs, length, damaged, occurrences), "spelling-counts"))
    words = kept(numbered(counted, [F.desc("n"), F.asc("word")], "k"))  # the best of several is the smallest number
    forward = kept(trie_nodes(words.select("word", "k"), "pre"))
    both = kept(trie_nodes(forward.select("word", "k", "pre"), "suf", backwards=True))
    pairs = _pairs(both, same_nodes(forward, "pre"), same_nodes(both, "suf", backwards=True))
    near = kept(written(near_words(pairs), "spelling-near"))
    best = words.select(F.col("k").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    known = words.join(near, "k", "left").join(best, "best", "left")
    fits = F.coalesce(F.col("form_n") >= F.col("n") * ratio, F.lit(False))
    known = kept(written(known.select(
        "k", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        *[F.when(fits, F.col(c)).alias(name) for c, name in (("best", "form_k"), ("form", "form"), ("form_n", "form_n"))]), "spelling-forms"))
    roots = kept(_roots(known.where("form_k IS NOT NULL").select("k", "form_k", "form_n")))
    rooted = roots.join(words.select(F.col("k").alias("root"), F.col("word").alias("root_word")), "root").select("k", "root_word")
    result, _ = written(known.join(rooted, "k", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"), "spelling")
    for folder in folders:
        drop_folder(spark, folder)
    return result
