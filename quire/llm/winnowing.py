"""Document fingerprints by winnowing (operator 9).

Words are runs of anything but ASCII white space. Every run of ``K`` words is hashed at its position, and of every
window of ``WINDOW`` neighbouring hashes the least one is chosen, the rightmost where several are least. The chosen
(hash, position) pairs are the fingerprint. Any passage of ``K + WINDOW - 1`` words that two texts share holds a whole
window, so both fingerprints contain its choice; the kept positions tell where.

A hash (32 bits) and its position share one long with the position counted downwards: the least long of a window is
the least hash, rightmost on ties. So choosing is ``array_min`` over a slice, and hashing one ``xxhash64`` per position;
all of it DataFrame expressions where the text is.

``edited_fingerprints`` also needs the beginning of the next document in descending order of ids. Only keys are put in
order: a row's key is a digest of its id and text, the table of keys is range-partitioned by (id, key), and a window
in each range looks one key ahead; the last key of a range takes the first one of the next range (one row per range).
Texts are shuffled once, by key, together with their fingerprints: every key sends what its predecessor needs, the
beginning of its text and its hashes, and is joined with what it is sent itself. Both joins are on unique keys, so
neither clustered, outlying, repeated nor missing ids gather texts in one task. Rows with equal ids and texts are one
key with a number of copies; all but the last of them have an equal row as the next one, and come back in chunks of
``CHUNK`` that are dealt over the tasks.

Cases: a null text is empty; a text of fewer than ``K`` words has one hash of all its words, an empty one none; two
empty fingerprints are alike (1), an empty and another one are not (0); ids are of any type that Spark sorts and casts
to text; null ids come last; equal ids are ordered by their keys; the only document of a table is its own next one;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import let
from quire.llm.common import SPACE, written

K = 5
WINDOW = 16
CHUNK = 1000
_LAST = 2**31 - 1


def words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(F.length(bare) > 0, F.split(bare, SPACE)).otherwise(F.array().cast("array<string>"))


def fingerprint(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """The chosen longs ``hash << 31 | (2^31 - 1 - position)`` of a text, in order of position."""

    def hashed(w: Column) -> Column:
        def at(i: Column) -> Column:
            low = F.xxhash64(*[F.get(w, i + j) for j in range(k)]).bitwiseAND(F.lit(0xFFFFFFFF))
            return F.shiftleft(low, 31) + (F.lit(_LAST) - i)

        return F.when(F.size(w) > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0))), at)).otherwise(
            F.array().cast("array<long>"))

    def chosen(h: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(h) - window + 1, F.lit(1)))
        return F.when(F.size(h) > 0, F.array_distinct(F.transform(starts, lambda i: F.array_min(F.slice(h, i, window))))).otherwise(h)

    return let(let(words(text), hashed), chosen)


def hashes(chosen: Column) -> Column:
    """The distinct hashes of a fingerprint."""
    return F.array_distinct(F.transform(chosen, lambda x: F.shiftright(x, 31)))


def said(chosen: Column) -> Column:
    """``hash:position`` of every choice, comma-joined; hashes in hex."""
    return F.concat_ws(",", F.transform(chosen, lambda x: F.concat(
        F.lower(F.hex(F.shiftright(x, 31))), F.lit(":"), (F.lit(_LAST) - x.bitwiseAND(F.lit(_LAST))).cast("string"))))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def keyed(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, key)`` of every row; rows of equal id and text, and no others, have equal keys."""
    text = F.coalesce("text", F.lit(""))
    said_id = F.coalesce(F.concat(F.lit("+"), F.col("doc_id").cast("string")), F.lit("-"))
    return docs.select("doc_id", text.alias("text"), F.md5(F.concat(said_id, F.lit("\0"), text).cast("binary")).alias("key"))


def succession(rows: DataFrame) -> DataFrame:
    """``(key, copies, before_key, before_chars)`` of every key: the key before it in descending order of ids (the last
    one, for the first), and the number of code points of that one's text."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc_nulls_last("doc_id"), F.asc("key")]
    keys = rows.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first(F.length("text")).alias("chars"), F.count(F.lit(1)).alias("copies"))
    placed = written(keys.repartitionByRange(n, *order).withColumn("range", F.spark_partition_id()), "winnow-keys")
    here = Window.partitionBy("range").orderBy(*order)
    ordered = placed.withColumn("before", F.lag(F.struct("key", "chars")).over(here)).withColumn("after", F.lead("key").over(here))
    # the last key of each range that has any, seen from the range after it: one row per range
    last, ranges = F.struct("key", "chars"), Window.orderBy("range")
    lasts = ordered.where("after is null").select("range", last.alias("last"))
    ends = lasts.select("range", F.coalesce(F.lag("last").over(ranges), F.last("last").over(ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("end"))
    linked = ordered.join(F.broadcast(ends), "range").withColumn("before", F.coalesce("before", "end"))
    return linked.select("key", "copies", F.col("before.key").alias("before_key"), F.col("before.chars").alias("before_chars"))


def with_next(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(key, row (doc_id, text, chosen), next_text, next_hashes, copies)``: each document beside the next one's beginning
    and hashes. The first table has the last copy of every key, the second one row for all its others, if it has any."""
    rows = keyed(docs)
    links = written(succession(rows), "winnow-links")
    # one column, so that all three readers share one shuffle
    one = rows.withColumn("chosen", fingerprint(F.col("text"))).groupBy("key").agg(F.first(F.struct("doc_id", "text", "chosen")).alias("row"))
    text, chosen = F.col("row.text"), F.col("row.chosen")

    def sent(chars: Column) -> list[Column]:
        return [F.substring(text, F.lit(1), F.floor(chars / 3).cast("int")).alias("next_text"), hashes(chosen).alias("next_hashes")]

    # merged at every size: links grow with the table
    givers = one.join(links.select("key", "before_key", "before_chars").hint("merge"), "key")
    given = givers.select(F.col("before_key").alias("key"), *sent(F.col("before_chars")))
    lasts = one.join(given.hint("merge"), "key").withColumn("copies", F.lit(1).cast("long"))
    others = one.join(links.where("copies > 1").select("key", (F.col("copies") - 1).alias("copies")).hint("merge"), "key")
    return lasts, others.select("key", "row", *sent(F.length(text)), "copies")


def judged(both: DataFrame) -> DataFrame:
    """The results of rows beside their next ones, with ``key`` and ``copies``."""
    both = both.select("row.doc_id", "row.text", "row.chosen", "next_text", "next_hashes", "key", "copies")
    n = F.length("text")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - F.floor(n / 3).cast("int")), F.col("next_text"))
    both = both.withColumn("hashes", hashes(F.col("chosen"))).withColumn("edited", edited)
    both = both.withColumn("edited_chosen", fingerprint(F.col("edited"))).withColumn("edited_hashes", hashes(F.col("edited_chosen")))
    return both.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        said(F.col("chosen")).alias("fingerprint"), said(F.col("edited_chosen")).alias("edited_fingerprint"),
        likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"), "key", "copies")


def edited_fingerprints(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` of every row.

    The edited text has the last third of a text's code points replaced by the first as many of the next text.
    """
    lasts, others = with_next(docs)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = judged(others).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / chunk))))
    copies = F.least(F.lit(chunk).cast("long"), F.col("copies") - F.col("chunk") * chunk)
    spread = chunks.repartition(n, "key", "chunk").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    return judged(lasts).drop("key", "copies").unionByName(spread.drop("key", "copies", "chunk", "copy"))
