"""SpotSigs fingerprints: chains of content words that follow common words.

Words are runs of letters, marks and digits, in lower case. An anchor is a common word: one of the function
words below, or any word of at most three characters, which common words of most languages are. The
start of a text is an anchor too, and so is a word before which GAP words in a row are not common (as in tables, or in
languages without short words), so that every text with a word has a signature. A signature hashes an
anchor and the next CHAIN words that are no anchors (fewer at the end of the text). A fingerprint is the
multiset of signatures of a text, its likeness with another the Jaccard index of the multisets: a repeated
signature counts by its number, so that these are sets.

All of it is DataFrame functions. Anchors among the words are numbered, and an anchor's chain begins in the list of
other words at the anchor's place less its number, so that a text is read once and nothing is exploded.

Defined results: a null text is empty. Texts without words have the empty fingerprint, which is like itself
(1) and like no other (0). The next document is by ascending id, null ids last; rows of equal id are ordered
by digest of text, and rows of equal id and text are one document there, each with the same result. After the
last comes the first; a table of one document has itself as next. Other columns are not read, and an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapelens.llm.common import durable, schema_of, shuffle_partitions, slim

CHAIN = 2
SHORT = 3
#: A word with so many words before it that are not common is an anchor too.
GAP = 4
THRESHOLD = 0.8

# Function words of more than three letters of widely used European languages.
ANCHORS = """
about after also been before because could from have into more only other over some such than that their them then there
these they this were what when where which will with would your
aber auch auf dass dem den der des die eine einem einen einer eines haben hatte ihre kein mehr nach nicht noch oder sein seine
sich sind über unter wird wenn werden wurde
avec cette comme dans dont elle était leur leurs mais même nous pour plus sans sont sous tout très vous
como cuando desde donde ella entre esta este están hasta para pero porque sobre también tiene todo
alla anche come dalla della delle nella però quando questo sono
aan deze door haar maar niet naar voor werd worden zijn
""".split()


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often it is used, in lambdas too."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def signatures(text: Column) -> Column:
    """The signatures of a text as integers, none twice: from its second time on, a signature is hashed with its number."""

    def common(w: Column) -> Column:
        return (F.length(w) <= SHORT) | w.isin(*ANCHORS)

    def chain(anchor: Column, follow: Column, at: Column) -> Column:
        return F.hash(anchor, *[F.get(follow, at + i) for i in range(CHAIN)])

    def places(every: Column, which: Callable[[Column], Column]) -> Column:
        return F.filter(F.transform(every, lambda w, i: F.when(which(w), i)), lambda i: i.isNotNull())

    def chains(every: Column, content: Column, at: Column) -> Column:
        start = F.array(chain(F.lit(""), content, F.lit(0)))
        after_common = F.transform(places(every, common), lambda i, number: chain(F.get(every, i), content, i - number))
        far = F.transform(at, lambda i, q: F.when(i - F.get(at, q - GAP) == GAP, chain(F.get(content, q), content, q + 1)))
        return F.when(F.size(every) > 0, F.concat(start, after_common, F.filter(far, lambda x: x.isNotNull()))).otherwise(F.array().cast("array<int>"))

    def numbered(found: Column) -> Column:
        starts = F.filter(F.transform(found, lambda s, i: F.when((i == 0) | (s != F.get(found, i - 1)), i)), lambda i: i.isNotNull())

        def runs(at: Column) -> Column:
            def run(start: Column, number: Column) -> Column:
                times = F.coalesce(F.get(at, number + 1), F.size(found)) - start
                return F.transform(F.sequence(F.lit(0), times - 1), lambda k: F.when(k == 0, F.get(found, start)).otherwise(F.hash(F.get(found, start), k)))

            return F.flatten(F.transform(at, run))

        return F.when(F.size(F.array_distinct(found)) == F.size(found), found).otherwise(F.array_distinct(_let(starts, runs)))

    def of_words(every: Column) -> Column:
        return _let(places(every, lambda w: ~common(w)), lambda at: _let(F.transform(at, lambda i: F.get(every, i)), lambda content: chains(every, content, at)))

    made = _let(words(text), of_words)
    return _let(F.sort_array(made), numbered)


def fingerprint(found: Column) -> Column:
    """Signatures as text: signed integers, parted by spaces."""
    return F.array_join(found.cast("array<string>"), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two sets; two empty ones are alike."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, 1.0).otherwise(both / either)


def following(docs: DataFrame) -> DataFrame:
    """(key, next_key): every document's next one, the first after the last. docs: (key, id, n_chars), one row a document.

    Documents are ranged over tasks by id, and each looks ahead in its own range; a range's last one looks at the next
    range's first, in a table of one row a range.
    """
    place = [F.col("id").isNull(), F.col("id"), F.col("key")]
    ranged = docs.repartitionByRange(shuffle_partitions(docs), *place).withColumn("part", F.spark_partition_id())
    ranged = durable(ranged)
    heads = ranged.groupBy("part").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("head"))
    ahead = heads.select("part", F.coalesce(F.lead("head").over(Window.orderBy("part")), F.min("head").over(Window.partitionBy()))["key"].alias("head_key"))
    looked = ranged.withColumn("next_key", F.lead("key").over(Window.partitionBy("part").orderBy(*place)))
    # One row a range: as many as shuffle partitions, which is a setting.
    return looked.join(F.broadcast(ahead), "part").select("key", "n_chars", F.coalesce("next_key", "head_key").alias("next_key"))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, id, text, n_chars) of every row; key: a digest of id and text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    source = slim(docs, id_col, text_col).toDF("id", "text").select("id", text.alias("text"))
    key = F.md5(F.concat(F.coalesce(F.concat(F.lit("="), F.col("id").cast("string")), F.lit("")), F.lit("\n"), F.col("text")).cast("binary"))
    return source.select(F.unhex(key).alias("key"), "id", "text", F.length("text").cast("long").alias("n_chars"))


def compare_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The edited text has the next document's beginning for its last quarter. A document sends only that much of its
    text, and its signatures, to the one before it; whole texts move once, without signatures, which are made again
    where they arrive: that takes less than moving them.
    """
    rows = keyed(docs, id_col, text_col)
    order = following(rows.select("key", "id", "n_chars").distinct())
    before = order.select(F.col("next_key").alias("key"), F.col("key").alias("to"), F.floor(F.col("n_chars") / 4).cast("int").alias("room"))
    sent = rows.join(before, "key").select("to", F.substring("text", F.lit(1), F.least("room", F.col("n_chars").cast("int"))).alias("head"), signatures(F.col("text")).alias("next_found"), F.col("id").alias("next_id"))
    sent = sent.groupBy(F.col("to").alias("key")).agg(F.first(F.struct("head", "next_found", "next_id")).alias("next"))
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int"))
    edited = rows.join(sent, "key").select("id", "n_chars", signatures(F.col("text")).alias("found"), "next.next_found", F.concat(kept, "next.head").alias("edited"))
    edited = edited.select("id", "n_chars", "found", "next_found", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), signatures(F.col("edited")).alias("edited_found"))
    return edited.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("found")).alias("fingerprint"),
        fingerprint(F.col("edited_found")).alias("edited_fingerprint"),
        likeness(F.col("found"), F.col("edited_found")).alias("near_edited"),
        likeness(F.col("found"), F.col("next_found")).alias("near_next"),
    )
