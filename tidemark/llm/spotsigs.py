"""SpotSigs fingerprints: chains of content words after common-word anchors.

A signature is a common word with the next two content words, common words in
between skipped. Junk without common words hardly makes signatures, prose makes
many. A document's fingerprint is the sorted set of its signatures' 32-bit
hashes. All of it is Spark SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.keys import with_position
from .common import NULL_ID, let

# Common words of four languages.
ANCHORS = (
    "the of and to in a is that it for on was as with be by are this at from an or "
    "der die das und den von zu des ein eine nicht ist mit für auf dem sich "
    "le la les de et un une que qui du dans en pour au par pas sur est des "
    "el los las y del se por con para al su lo como"
).split()
CHAIN = 2  # content words of a signature
SPAN = 8  # words after an anchor among which they are looked for
NEIGHBOURS = 256  # doc_ids of one group in which next documents are looked up


def _common(word: Column) -> Column:
    return word.isin(*ANCHORS)


def _short(text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(text), 32)


def signatures(text: Column) -> Column:
    """Sorted distinct hashes. A text without a chain has those of its words, one without words that of itself."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def chains(words: Column) -> Column:
        places = F.filter(
            F.transform(words, lambda w, i: F.when(_common(w), i + 1)), lambda i: i.isNotNull()
        )
        following = F.transform(
            places,
            lambda i: F.concat(
                F.array(F.element_at(words, i)),
                F.slice(F.filter(F.slice(words, i + 1, SPAN), lambda w: ~_common(w)), 1, CHAIN),
            ),
        )
        return F.transform(
            F.filter(following, lambda c: F.size(c) == CHAIN + 1), lambda c: _short(F.array_join(c, " "))
        )

    def plain(words: Column) -> Column:
        return F.when(F.size(words) > 0, F.transform(words, lambda w: _short(F.concat(F.lit("w "), w)))).otherwise(
            F.array(_short(F.concat(F.lit("t "), text)))
        )

    def marks(words: Column) -> Column:
        return let(chains(words), lambda found: F.when(F.size(found) > 0, found).otherwise(plain(words)))

    return F.sort_array(F.array_distinct(let(words, marks)))


def written(marks: Column) -> Column:
    """A fingerprint as text: eight hexadecimal digits for each signature."""
    return F.array_join(F.transform(marks, lambda m: F.lower(F.lpad(F.hex(m), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of signatures."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, next``: each text with that of the next row by doc_id (nulls last, then text); the last has the first's.

    Rows are grouped by ranges of ids; each group also gets the first row of the
    following group, so one shuffle by group is enough.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("_id", F.coalesce("doc_id", F.lit(NULL_ID)))
    rows = rows.withColumn("_group", F.floor(F.col("_id") / NEIGHBOURS))
    firsts = rows.groupBy("_group").agg(F.min("_id").alias("_first"))
    placed = with_position(firsts, "_n", [F.col("_group")], total="_total")
    after = placed.select(
        F.col("_first").alias("_id"),
        F.when(F.col("_n") == 1, F.col("_total")).otherwise(F.col("_n") - 1).alias("_n"),
    )
    borrowed = rows.drop("_group").join(after.join(placed.select("_n", "_group"), "_n").drop("_n"), "_id")
    all_rows = rows.withColumn("_lent", F.lit(0)).unionByName(borrowed.withColumn("_lent", F.lit(1)))
    return all_rows.withColumn("next", F.lead("text").over(_order())).drop("_id")


def _order() -> W:
    return W.partitionBy("_group").orderBy("_lent", F.coalesce("doc_id", F.lit(NULL_ID)), "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` for every row.

    The edited text has its last half replaced by as many characters of the next
    document. Null texts are empty; a single document is its own next one.
    """
    marked = with_next(docs).withColumn("_marks", signatures(F.col("text")))
    # the same groups and order as before: no further shuffle
    paired = marked.withColumn("_next_marks", F.lead("_marks").over(_order())).where("_lent = 0")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), F.length("text") - half), F.col("next").substr(F.lit(1), half))
    with_edit = paired.withColumn("_edited", edited).withColumn("_edited_marks", signatures(F.col("_edited")))
    return with_edit.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
        written(F.col("_marks")).alias("fingerprint"),
        written(F.col("_edited_marks")).alias("edited_fingerprint"),
        likeness(F.col("_marks"), F.col("_edited_marks")).alias("near_edited"),
        likeness(F.col("_marks"), F.col("_next_marks")).alias("near_next"),
    )


def near_pairs(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Membership ``doc_id, class_id`` and pairs ``a, b, similarity`` of classes at or above ``threshold``.

    A class holds the documents of one set of signatures, named by its smallest
    id; copies are not expanded into pairs. Sets are partitioned by length so
    that similar ones are in the same or neighbouring partitions. A set is indexed
    under its rarest signatures only, as many as any similar set must share one of.
    """
    marks = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        signatures(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("marks"),
    ).withColumn("_set", F.sha2(written(F.col("marks")), 256))
    classes = marks.groupBy("_set").agg(F.min("doc_id").alias("class_id"), F.first("marks").alias("marks"))
    members = marks.select("doc_id", "_set").join(classes.select("_set", "class_id"), "_set").select("doc_id", "class_id")
    sets = classes.where("class_id IS NOT NULL").select(F.col("class_id").alias("id"), "marks", F.size("marks").alias("n"))
    parts = sets.select("id", "n", F.explode("marks").alias("mark"))
    rarity = parts.groupBy("mark").agg(F.count(F.lit(1)).alias("_in")).where("_in > 1")
    by_rarity = W.partitionBy("id").orderBy("_in", "mark")
    alone = F.col("n") - F.count(F.lit(1)).over(W.partitionBy("id"))  # signatures no other set has come first
    prefix = (
        parts.join(rarity, "mark")
        .withColumn("_nth", F.row_number().over(by_rarity) + alone)
        .where(F.col("_nth") <= F.col("n") - F.ceil(F.col("n") * threshold) + 1)
        .withColumn("part", F.floor(F.log("n") / F.log(F.lit(1 / threshold)) + 1e-9))
    )
    left = prefix.select(F.col("id").alias("a"), F.col("n").alias("na"), "mark", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    right = prefix.select(F.col("id").alias("b"), F.col("n").alias("nb"), "mark", "part")
    candidates = (
        left.join(right, ["mark", "part"])
        .where("a <> b AND (na < nb OR na = nb AND a < b)")
        .where(F.col("na") >= F.col("nb") * threshold - 1e-9)
        .select("a", "b")
        .distinct()
    )
    pairs = (
        candidates.join(sets.select(F.col("id").alias("a"), F.col("marks").alias("_x")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("marks").alias("_y")), "b")
        .select("a", "b", likeness(F.col("_x"), F.col("_y")).alias("similarity"))
        .where(F.col("similarity") >= threshold)
    )
    return members, pairs
