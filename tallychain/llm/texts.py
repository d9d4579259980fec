"""Word rules shared by the operators."""

from pyspark.sql import functions as F

from tallychain.session import drop_folder, release_shuffles, written

#: White space of the word rule: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text):
    """A-Z in lower case; every other character stays as it is."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_count(text):
    """Number of words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words_of(text):
    """The words of a Python string as UTF-8 bytes; bytes.split() cuts at just the six white spaces above."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def sized_broadcast(table, most=500_000):
    """A written table, marked for broadcast if its counted rows are ``most`` or fewer; else Spark joins it as it sees fit."""
    return F.broadcast(table) if table.count() <= most else table


KEYS = ["__id", "__hash"]


def keyed(docs):
    """Rows by doc_id and text; equal rows share a key and get equal results."""
    return docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(-1).cast("long")), "__hash": F.xxhash64("doc_id", "text")})


def settled(df, name, *folders):
    """``df`` as a written table; what only it needed is given up: ``folders``, and the shuffle files of steps that have ended.

    Spark's cleaner removes shuffle files once the driver has collected the step's objects, so a
    chain of such steps needs the disk of its largest one rather than of all.
    """
    spark = df.sparkSession
    table, folder = written(df, name)
    del df
    for old in folders:
        drop_folder(spark, old)
    release_shuffles(spark)
    return table, folder
