"""Benchmark decontamination by winnowing, in DataFrame functions only."""

from pyspark.sql import functions as F

from tallychain.llm.texts import KEYS, keyed, lowered, sized_broadcast
from tallychain.session import written

#: What separates words here; the words are runs of ASCII letters, digits and all characters beyond ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, GRAM, SHORT = 10, 5, 3
#: Low bits of a kept hash that hold its place; Spark's strings are too short for more words than that.
PLACE = 30


def bench_words(text):
    """Lower-cased words of a text; an empty array for null."""
    return F.coalesce(F.filter(F.split(lowered(text), SEPARATORS), lambda w: w != ""), F.array().cast("array<string>"))


def _hash_at(words, start, gram):
    return F.xxhash64(*[F.element_at(words, (start + j).cast("int")) for j in range(gram)])


def _grams(words, gram):
    """Hashes of all runs of ``gram`` words, by start; an empty array if the text is shorter."""
    starts = F.sequence(F.lit(1), F.size(words) - gram + 1)
    each = F.transform(starts, lambda i: _hash_at(words, i, gram))
    return F.when(F.size(words) >= gram, each).otherwise(F.array().cast("array<bigint>"))


def _marks(grams):
    """The least gram of every run of ``WINDOW - GRAM + 1`` grams, each with its place in the low ``PLACE`` bits.

    The place breaks ties between equal hashes: the first of a run counts, on both sides alike.
    """
    runs = F.sequence(F.lit(1), F.size(grams) - WINDOW + GRAM)
    least = F.transform(runs, lambda j: F.least(*[F.element_at(grams, j + k) for k in range(WINDOW - GRAM + 1)]))
    return F.when(F.size(grams) > WINDOW - GRAM, F.array_distinct(least)).otherwise(F.array().cast("array<bigint>"))


def _placed_grams(words):
    """Gram hashes with their places in the low bits."""
    starts = F.sequence(F.lit(1), F.size(words) - GRAM + 1)
    each = F.transform(starts, lambda i: _high(_hash_at(words, i, GRAM)).bitwiseOR(i.cast("long")))
    return F.when(F.size(words) >= GRAM, each).otherwise(F.array().cast("array<bigint>"))


def _high(mark):
    return mark.bitwiseAND(F.lit(-(1 << PLACE)))


def _place(mark):
    return mark.bitwiseAND((1 << PLACE) - 1).cast("int")


def _item_marks(items):
    """(h, item_id, q, n, around): kept hashes of items of a window or more; ``around`` are the words that windows over them can hold.

    ``q`` is the place of the hash's first word in ``around``, ``n`` the length of the windows.
    """
    reach = WINDOW - GRAM
    marks = items.where(F.size("words") >= WINDOW).withColumn("grams", _placed_grams(F.col("words")))
    marks = marks.select("item_id", "words", F.explode(_marks(F.col("grams"))).alias("m")).withColumn("p", _place(F.col("m")))
    first = F.greatest(F.lit(1), F.col("p") - reach)
    return marks.select(
        _high(F.col("m")).alias("h"), "item_id", (F.col("p") - first + 1).alias("q"), F.lit(WINDOW).alias("n"),
        F.slice("words", first, F.col("p") + WINDOW - first).alias("around"),
    )


def _short_marks(items, gram):
    """The same for items shorter than a window, by the hash of their first ``gram`` words; the item is its only window."""
    size = F.size("words")
    mine = (size >= gram) & (size < WINDOW) & (size >= SHORT if gram == SHORT else size == gram)
    return items.where(mine).select(
        _hash_at(F.col("words"), F.lit(1), gram).alias("h"), "item_id", F.lit(1).alias("q"), size.alias("n"), F.col("words").alias("around")
    )


def occurrences(docs, benchmark):
    """(doc_id, n_words, n_hit, items) and a key of every row; ``items`` are the item_ids, as strings in order, with occurring windows.

    A window is ``WINDOW`` consecutive words of an item, or the whole of a shorter one.  Any window
    that a document shares holds the same run of gram hashes on both sides, so both keep the same
    least one of it: joining kept hashes misses none.  A joined hit is extended word by word: the
    windows over it whose words agree are occurrences, so equal hashes of other words do no harm.
    Shorter items join by the hash of their first ``SHORT`` words (or all) at every place.

    Null texts have no words; null item_ids count as hits but are left out of ``items``.  Repeated
    items and repeated rows are fine, empty tables give rows without hits or no rows.
    """
    items, _ = written(
        benchmark.select("item_id", bench_words(F.col("text")).alias("words")).where(F.size("words") > 0), "winnow-items"
    )
    lengths = [r[0] for r in items.where(F.size("words") < WINDOW).select(F.least(F.size("words"), F.lit(SHORT))).distinct().collect()]
    keys = KEYS
    slim = keyed(docs.select("doc_id", "text"))
    worded = slim.select("doc_id", *keys, bench_words(F.col("text")).alias("words"))
    hashed = worded.withColumn("grams", _placed_grams(F.col("words")))
    short = {f"short{g}": _grams(F.col("words"), g) for g in lengths}
    marked, _ = written(
        hashed.select("doc_id", *keys, F.size("words").alias("n_words"), _marks(F.col("grams")).alias("marks"),
                      *[c.alias(name) for name, c in short.items()]), "winnow-docs"
    )
    found = marked.select(*keys, F.explode("marks").alias("m")).select(*keys, _place(F.col("m")).alias("p"), _high(F.col("m")).alias("h"))
    found = found.join(sized_broadcast(written(_item_marks(items), "winnow-marks")[0], most=100_000), "h")
    for g in lengths:
        places = marked.select(*keys, F.posexplode(f"short{g}").alias("p", "h")).withColumn("p", F.col("p") + 1)
        found = found.union(places.join(sized_broadcast(written(_short_marks(items, g), "winnow-short")[0], most=100_000), "h").select(*found.columns))
    hit = F.struct("item_id", "p", "q", "n", "around")
    gathered = found.groupBy(*keys).agg(F.collect_set(hit).alias("hits"))

    def starts(h):
        """First words of the document's windows over a hit that agree with the item's."""
        tries = F.sequence(F.greatest(F.lit(1), h["p"] - h["q"] + 1), F.least(h["p"], h["p"] - h["q"] + F.size(h["around"]) - h["n"] + 1))
        agree = F.filter(tries, lambda s: F.slice(F.col("words"), s, h["n"]) == F.slice(h["around"], s - h["p"] + h["q"], h["n"]))
        return F.when(h["p"] - h["q"] + F.size(h["around"]) - h["n"] + 1 >= F.greatest(F.lit(1), h["p"] - h["q"] + 1), agree).otherwise(
            F.array().cast("array<int>")
        )

    checked = F.transform("hits", lambda h: F.struct(h["item_id"].cast("string").alias("item"), h["n"].alias("n"), starts(h).alias("starts")))
    covered = F.flatten(F.transform("real", lambda h: F.flatten(F.transform(h["starts"], lambda s: F.sequence(s, s + h["n"] - 1)))))
    extended = (
        slim.join(gathered, keys).dropDuplicates(keys)
        # explode() of one element keeps the words from being computed anew for each hit.
        .select(*keys, F.explode(F.array(bench_words(F.col("text")))).alias("words"), "hits")
        .select(*keys, F.filter(checked, lambda h: F.size(h["starts"]) > 0).alias("real"))
        .select(*keys, F.size(F.array_distinct(covered)).alias("n_hit"),
                F.array_sort(F.array_distinct(F.filter(F.transform("real", lambda h: h["item"]), lambda i: i.isNotNull()))).alias("items"))
    )
    extended, _ = written(extended.where("n_hit > 0"), "winnow-hits")
    return marked.select("doc_id", *keys, "n_words").join(extended, keys, "left").select(
        "doc_id", *keys, F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def drop_contaminated(docs, benchmark):
    """The rows of ``docs`` in which no window of an item occurs."""
    bad, _ = written(occurrences(docs, benchmark).where("n_hit > 0").select(*KEYS).distinct(), "winnow-bad")
    return keyed(docs).join(sized_broadcast(bad, most=2_000_000), KEYS, "left_anti").select(*docs.columns)
