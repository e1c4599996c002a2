"""Document fingerprints by Order MinHash (DataFrame functions only).

A text is cut at its blanks into tokens; a token of more than ``TOKEN`` characters (scripts
without blanks, long strings) is cut into single characters.  ``K`` tokens in a row are a k-mer.
The i-th time that a k-mer occurs in a text it gets the number i, so repeats count.  The hash of
(k-mer, number) deals the numbered k-mers into ``SKETCHES`` parts (one-permutation hashing: each
is hashed once, not once a sketch).  A part keeps the two numbered k-mers with the smallest
hashes from its lower end on: a part with one or none borrows from the next parts, after the
last from the first (densification by rotation), so every tuple has two k-mers if the text has.
They are put back into text order and hashed as a tuple.  Moving text around changes the tuples,
so two signatures agree in a part with a probability that falls with the edit distance, not just
with the bag of k-mers.

Hash and position share a long (``POSITION_BITS`` for the position), so both sorts of a text run
over plain longs and a text of n tokens costs n log n, whatever its length (up to 2 ** 28 tokens,
as many as fit into a string of 512 MB).

Defined cases: null text is the empty text, whose fingerprint is empty; two empty texts are
alike with 1.0, an empty and a non-empty one with 0.0; texts shorter than a k-mer are one
k-mer, which has no order; equal texts have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.common import cut

TOKEN = 32
K = 2
SKETCHES = 64
POSITION_BITS = 28
HEX = 8


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _pack(h: Column, position: Column) -> Column:
    """A long that sorts by the hash's upper bits, then holds the position."""
    return F.shiftleft(F.shiftright(h, POSITION_BITS), POSITION_BITS).bitwiseOR(
        position.cast("long"))


def _hash(packed: Column) -> Column:
    return F.shiftright(packed, POSITION_BITS)


def _position(packed: Column) -> Column:
    return packed.bitwiseAND((1 << POSITION_BITS) - 1)


def _starts(sorted_longs: Column, group) -> Column:
    """Indexes (from 0) at which ``group(value)`` differs from its predecessor's."""
    i = F.sequence(F.lit(0), F.size(sorted_longs) - 1)
    return F.filter(i, lambda j: (j == 0) | (
        group(F.get(sorted_longs, j)) != group(F.get(sorted_longs, j - 1))))


def _tokens(text: Column) -> Column:
    words = F.split(text, " ", -1)
    long = lambda w: F.length(w) > TOKEN
    return _let(words, lambda ws: F.when(F.exists(ws, long), F.flatten(F.transform(
        ws, lambda w: F.when(long(w), F.split(w, "")).otherwise(F.array(w))))).otherwise(ws))


def _kmers(text: Column) -> Column:
    """(hash, position) of every k-mer, as sorted longs; null for the empty text."""
    def kmers(t: Column) -> Column:
        last = F.greatest(F.size(t) - K, F.lit(0))
        return F.sort_array(F.transform(F.sequence(F.lit(0), last), lambda i: _pack(
            F.xxhash64(*[F.get(t, i + d) for d in range(K)]), i)))

    return F.when(F.length(text) > 0, _let(_tokens(text), kmers))


def _numbered(kmers: Column) -> Column:
    """Sorted (k-mer, position) longs -> sorted (hash of k-mer and its number, position).
    Number 0 keeps the k-mer's own hash, so only repeats are hashed and sorted in again."""
    def again(r: Column) -> Column:
        def number(starts: Column) -> Column:
            def run(start: Column, nth: Column) -> Column:
                end = F.coalesce(F.get(starts, nth + 1), F.size(r))
                return F.transform(F.sequence(F.lit(0), end - start - 1), lambda o: _pack(
                    F.xxhash64(_hash(F.get(r, start)), o + 1), _position(F.get(r, start + o))))
            return F.flatten(F.transform(starts, run))
        return _let(_starts(r, _hash), number)

    def merge(s: Column) -> Column:
        same = lambda x, i: (i > 0) & (_hash(x) == _hash(F.get(s, i - 1)))
        first = F.filter(s, lambda x, i: ~same(x, i))
        return _let(F.filter(s, same), lambda r: F.when(F.size(r) == 0, s).otherwise(
            F.sort_array(F.concat(first, again(r)))))
    return _let(kmers, merge)


def _part(packed: Column) -> Column:
    return F.shiftright(packed, 64 - (SKETCHES.bit_length() - 1))


def _parts(numbered: Column) -> Column:
    """For every part, the part and the hash of the two k-mers from its lower end on, around the
    circle of hashes, in text order, as ``HEX`` hex digits: two for the part (from 40), six for
    the hash."""
    low, high = -SKETCHES // 2, SKETCHES // 2 - 1

    def of(s: Column) -> Column:
        def entries(starts: Column) -> Column:
            # Filled part j serves itself and the empty parts before it; after the last: part 0.
            def entry(start: Column, j: Column) -> Column:
                a, b = F.get(s, start), F.get(s, (start + 1) % F.size(s))
                h = F.when(F.size(s) == 1, F.xxhash64(_hash(a))) \
                    .when(_position(a) < _position(b), F.xxhash64(_hash(a), _hash(b))) \
                    .otherwise(F.xxhash64(_hash(b), _hash(a)))
                first = F.when(j == 0, F.lit(low)).otherwise(
                    _part(F.get(s, F.get(starts, j - 1))) + 1)
                last = F.when(j == F.size(starts), F.lit(high)).otherwise(_part(a))
                return _let(F.shiftrightunsigned(h, 40), lambda digest: F.when(
                    first <= last, F.transform(F.sequence(first, last), lambda p: F.hex(
                        digest + F.shiftleft(p + (SKETCHES // 2 + 64), 24))))
                    .otherwise(F.array().cast("array<string>")))
            return F.flatten(F.transform(F.concat(starts, F.array(F.lit(0))), entry))
        return _let(_starts(s, _part), entries)
    return _let(numbered, of)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the fingerprint of the column ``text`` (no nulls) as column ``out``: a
    string of ``HEX`` hex digits for each part, by rising part; empty for the empty text."""
    parts = _parts(_numbered(_kmers(F.col(text))))
    return df.withColumn(out, F.lower(F.coalesce(F.array_join(parts, ""), F.lit(""))))


def _entries(fingerprint: Column) -> Column:
    return F.filter(F.split(fingerprint, rf"(?<=\G.{{{HEX}}})"), lambda e: F.length(e) > 0)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries among the parts that either fingerprint has; 1.0 if neither."""
    part = lambda e: F.substring(e, 1, HEX - 6)
    ea, eb = _entries(a), _entries(b)
    either = F.size(F.array_union(F.transform(ea, part), F.transform(eb, part)))
    return F.when((a == "") & (b == ""), F.lit(1.0)).otherwise(
        F.size(F.array_intersect(ea, eb)) / either)


def successors(ids: DataFrame, partitions: int) -> DataFrame:
    """(doc_id) -> (doc_id, next_id): the next greater id, the smallest after the greatest.
    Ids are dealt into ranges; each range needs only the first id of the ranges after it."""
    ranged = cut(ids.select("doc_id").distinct().repartitionByRange(
        partitions, F.col("doc_id").asc_nulls_first())
        .withColumn("part", F.spark_partition_id()), "omh-ids")
    heads = ranged.groupBy("part").agg(F.min(F.struct(
        F.col("doc_id").isNotNull().alias("set"), F.col("doc_id"))).alias("head"))
    order = Window.orderBy("part")  # a row per range
    first = F.first("head").over(order)
    heads = heads.select(F.col("part").alias("h_part"),
                         F.coalesce(F.lead("head").over(order), first)["doc_id"].alias("after"))
    inside = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first())
    rows = ranged.withColumn("next_id", F.lead("doc_id").over(inside)) \
        .withColumn("last", F.lead(F.lit(1)).over(inside).isNull())
    return rows.join(F.broadcast(heads), rows["part"] == F.col("h_part")).select(
        "doc_id", F.when(F.col("last"), F.col("after")).otherwise(F.col("next_id")).alias("next_id"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The edited text is the text with its last floor(n/2) characters replaced by the first as
    many (or all) of the next document's, by rising doc_id (after the last: the first).  Rows
    that share a doc_id have the same next document; of several next rows with one id it is the
    one whose text has the smallest XXH64.
    """
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = F.xxhash64("text")
    half = F.floor(F.length("text") / 2).cast("int")
    ids = cut(d.groupBy("doc_id").agg(F.max(half).alias("need"), F.min(order).alias("order")),
              "omh-needs")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    follows = successors(ids, partitions)
    nexts = ids.select(F.col("doc_id").alias("n_id"), F.col("order").alias("next_order"))
    follows = follows.join(nexts, F.col("next_id").eqNullSafe(F.col("n_id"))).drop("n_id")
    follows = follows.join(ids.select(F.col("doc_id").alias("m_id"), "need"),
                           F.col("doc_id").eqNullSafe(F.col("m_id")))
    # A null id is a key like any other: every id is a pair of a number and "it is null".
    pair = lambda c, name: [F.coalesce(c, F.lit(0)).alias(name),
                            c.isNull().alias(f"{name}_null")]
    follows = cut(follows.select(*pair(F.col("doc_id"), "to"), *pair(F.col("next_id"), "next"),
                                 "next_order", "need"), "omh-next")
    # Both joins deal the texts out by the same key, with the same columns, so that the texts
    # and their fingerprints are made and shuffled once.
    d = with_fingerprint(d, "text", "signature") \
        .select(*pair(F.col("doc_id"), "id"), "text", F.unhex("signature").alias("signature"))
    lent = d.join(follows.hint("merge"), (F.col("id") == F.col("next"))
                  & (F.col("id_null") == F.col("next_null"))
                  & (order.bitwiseXOR(F.col("next_order")) == 0))
    # What each document lends to the one before it: its start, no more than that one needs.
    lent = lent.select("to", "to_null", F.substr("text", F.lit(1), F.col("need")).alias("start"),
                       F.col("signature").alias("next_signature")) \
        .groupBy("to", "to_null").agg(F.first("start").alias("start"),
                                      F.first("next_signature").alias("next_signature"))
    e = d.join(lent.hint("merge"), (F.col("id") == F.col("to"))
               & (F.col("id_null") == F.col("to_null")))
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - half),
                      F.substr("start", F.lit(1), half))
    e = e.select(F.when(~F.col("id_null"), F.col("id")).alias("doc_id"),
                 F.length("text").cast("long").alias("n_chars"),
                 F.lower(F.hex("signature")).alias("fingerprint"),
                 F.lower(F.hex("next_signature")).alias("next_fingerprint"), edited.alias("edited"))
    e = with_fingerprint(e, "edited", "edited_fingerprint")
    return e.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                    "fingerprint", "edited_fingerprint",
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
