"""I-Match fingerprints: hashes of the terms within a band of document frequency, over randomised lexicons.

The lexicon holds the terms whose inverse document frequency lies in a band: those in at least one of ``rarest``
documents and at most one of ``commonest``.  Randomised subsets of it keep a half down to a 256th of its terms; a
document has one hash for each subset, that of its distinct terms in the subset, sorted.  Two texts agree in a subset
if the terms in which they differ lie outside of it; large subsets compare short texts, small ones long texts.
Likeness is the share of equal hashes among the subsets in which either text has a term.

Every document is also compared with an edited text (its last half replaced by the beginning of the next document, by
descending doc_id) and with the next document.  The order is cut into buckets at exact bounds, and the first document
of each bucket also ends the one before, so that one shuffle of the texts brings neighbours together; the terms'
look-up, the grouping by document and the comparison with the neighbour all happen in that partitioning.

Everything is DataFrame functions.  The lexicon has at most ``rarest`` times the mean number of distinct terms of a
document; it is broadcast up to ``most_sent`` terms and joined by shuffle beyond.

Defined cases: terms are maximal runs of ASCII digits and letters and of non-ASCII characters, in lower case; null
texts are empty; a text without a term of the lexicon has its own MD5 for a fingerprint, so that it is like equal texts
only; null doc_ids come last in the order, equal ones go by the MD5 of the text; repeated rows are documents of their
own; a single document is its own next; an empty table gives an empty result; other columns are ignored, whatever
their names.  doc_id is an integer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._store import pin

NO_TERM = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: How many subsets keep one of 2, 4, 8 … of the lexicon's terms.
SUBSETS = (2, 2, 4, 6, 8, 12, 12, 10)
RAREST, COMMONEST = 1000, 10


def distinct_terms(text: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(F.lower(text), NO_TERM)), "")


def lexicon(docs: DataFrame, rarest: int = RAREST, commonest: int = COMMONEST, subsets: tuple = SUBSETS) -> DataFrame:
    """term, mask: the terms of the band that lie in a subset; bit s of the mask stands for subset s."""
    every = docs.count()
    counts = docs.select(F.explode(distinct_terms(F.col("text"))).alias("term")).groupBy("term").count()
    band = counts.filter((F.col("count") * rarest >= every) & (F.col("count") * commonest <= every)).select("term")
    share = [256 >> k for k, n in enumerate(subsets, 1) for _ in range(n)]
    digits = F.concat(*[F.md5(F.concat(F.lit(f"{i}:"), "term")) for i in range(-(-len(share) // 16))])
    band = pin(band.select("term", digits.alias("digits")), "imatch-band")  # else the digests are made again for each subset
    draws = F.array(*[F.struct(F.lit(2 * s + 1).alias("at"), F.lit(f"{x:02x}").alias("below"), F.lit(1 << s).cast("long").alias("bit")) for s, x in enumerate(share)])
    mask = F.aggregate(draws, F.lit(0).cast("long"), lambda mask, x: mask + F.when(F.substring("digits", x["at"], F.lit(2)) < x["below"], x["bit"]).otherwise(F.lit(0)))
    return band.select("term", mask.alias("mask")).filter("mask <> 0")


def hashes(terms: Column, md5: Column, subsets: tuple = SUBSETS) -> Column:
    """An array of (term, mask) -> one hash for each subset, empty where no term is in it; without terms the text's MD5."""
    def some_of(terms: Column, bits: list[int]) -> Column:
        """The terms in any of these subsets, and of these the ones in each, joined."""
        each = F.array(*[F.lit(b).cast("long") for b in bits])
        among = F.array(F.filter(terms, lambda t: t["mask"].bitwiseAND(F.lit(sum(bits))) != 0))
        return F.transform(among, lambda own: F.transform(each, lambda bit: F.array_join(F.filter(own, lambda t: t["mask"].bitwiseAND(bit) != 0)["term"], " ")))

    terms, parts, s = F.sort_array(terms), [], 0
    for some in (subsets[:4], subsets[4:6], subsets[6:]):  # few terms are in the small subsets, which are many
        parts.append(some_of(terms, [1 << b for b in range(s, s + sum(some))]))
        s += sum(some)
    names = F.flatten(F.concat(*parts))
    own = F.transform(names, lambda x: F.when(x == "", "").otherwise(F.substring(F.md5(x), 1, 8)))
    return F.when(F.size(terms) > 0, own).otherwise(F.array(F.concat(F.lit("="), md5)))


def likeness(f: Column, g: Column) -> Column:
    """Share of equal hashes among those of which one is not empty."""
    same = F.zip_with(f, g, lambda x, y: F.when((x == "") & (y == ""), F.lit(None)).otherwise(F.coalesce((x == y).cast("int"), F.lit(0))))
    return F.size(F.filter(same, lambda v: v == 1)) / F.size(F.filter(same, lambda v: v.isNotNull()))


def _placed(docs: DataFrame, buckets: int) -> DataFrame:
    """doc_id, text -> bucket, follower (a copy of the next bucket's first document), place (order in the bucket), doc_id, text."""
    of = F.struct(F.col("doc_id").isNull().alias("a"), F.coalesce(F.bitwise_not(F.col("doc_id").cast("long")), F.lit(0)).alias("b"), F.md5("text").alias("c"))
    keyed = docs.select(of.alias("place"), "doc_id", "text")
    narrow = keyed.select("place").repartitionByRange(buckets, "place")
    bounds = sorted(tuple(r[1]) for r in narrow.groupBy(F.spark_partition_id()).agg(F.min("place")).collect()) or [(False, 0, "")]
    known = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).cast("long").alias("b"), F.lit(c).alias("c")) for a, b, c in bounds])
    upto = F.size(F.filter(known, lambda b: b <= F.col("place"))) - 1
    here = F.struct(F.col("_b").alias("bucket"), F.lit(False).alias("follower"))
    before = F.struct(F.pmod(F.col("_b") - 1, F.lit(len(bounds))).alias("bucket"), F.lit(True).alias("follower"))
    first = F.element_at(known, F.col("_b") + 1) == F.col("place")
    return keyed.withColumn("_b", upto).select(F.explode(F.when(first, F.array(here, before)).otherwise(F.array(here))).alias("at"), "place", "doc_id", "text").select("at.*", "place", "doc_id", "text")


def fingerprints(docs: DataFrame, rarest: int = RAREST, commonest: int = COMMONEST, most_sent: int = 2_000_000, buckets: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    known = pin(lexicon(docs, rarest, commonest), "imatch-lexicon")
    sent = known.count() <= most_sent
    known = known.unionByName(known.sparkSession.range(1).select(F.lit("").alias("term"), F.lit(0).cast("long").alias("mask")))

    order = Window.partitionBy("bucket").orderBy("follower", "place")
    buckets = buckets or min(2000, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("next", F.lit("")), F.lit(1), half))
    rows = (
        _placed(docs, buckets)
        .select("bucket", "follower", "doc_id", "text", F.lead("text").over(order).alias("next"), F.row_number().over(order).alias("nth"))
        .select("bucket", "nth", "follower", "doc_id", "text", n.cast("long").alias("n_chars"), edited.alias("edited"))
        .select("bucket", "nth", distinct_terms(F.col("text")).alias("a"), distinct_terms(F.col("edited")).alias("b"),
                F.struct("doc_id", "follower", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.md5("text").alias("md5"), F.md5("edited").alias("edited_md5")).alias("doc"))
    )
    # Each document also has the empty term, which keeps documents without terms and carries the columns.
    each = rows.select("bucket", "nth", F.size("a").alias("n_a"), "doc", F.posexplode(F.concat("a", "b", F.array(F.lit("")))).alias("pos", "term"))
    each = each.select("bucket", "nth", "term", (F.col("pos") < F.col("n_a")).alias("own"), F.when(F.col("term") == "", F.col("doc")).alias("doc"))
    met = each.join(F.broadcast(known) if sent else known, "term")
    term = F.struct("term", "mask")
    grouped = met.groupBy("bucket", "nth").agg(
        F.first("doc", ignorenulls=True).alias("doc"), F.collect_list(F.when(F.col("own"), term)).alias("a"),
        F.collect_list(F.when(~F.col("own") & (F.col("term") != ""), term)).alias("b"))
    signed = grouped.select("bucket", "nth", "doc.*", hashes(F.col("a"), F.col("doc.md5")).alias("f"), hashes(F.col("b"), F.col("doc.edited_md5")).alias("g"))
    after = F.lead("f").over(Window.partitionBy("bucket").orderBy("nth"))
    return signed.withColumn("after", after).filter(~F.col("follower")).select(
        "doc_id", "n_chars", "edited_sha256", F.array_join("f", ".").alias("fingerprint"), F.array_join("g", ".").alias("edited_fingerprint"),
        likeness(F.col("f"), F.col("g")).alias("near_edited"), likeness(F.col("f"), F.col("after")).alias("near_next"))


def op12_imatch(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents``, their edited texts and their neighbours."""
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
