"""Quality rules by distribution divergence.

Each document's character-class histogram and common-word histogram are compared, by Jensen-Shannon
distance, with references of its language that are computed from all documents.  A document fails if a
distance exceeds its threshold; histograms of few symbols are noisy, so each comparison has a minimum
length below which it passes.  Everything is DataFrame and SQL functions.

Every value of ``lang`` has its own reference, a row of a table that is joined by language.  As with short
documents, a comparison passes where the language's other documents have too few words or characters to be a
reference.  The word threshold is calibrated per reference: where the common words weigh little, a text with none
of them is near the reference, so the threshold is at most ``none_share`` of that text's distance.

Defined cases: a null text has no words and fails the base rules; a null ``lang`` is a value like any
other; repeated rows are judged separately; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._store import pin
from .source_schedule import WORD_GAP

#: Character classes as regular expressions; what is left of the words is the class "other".
CLASSES = {
    "lower": "\\p{Ll}", "upper": "\\p{Lu}", "digit": "\\p{Nd}", "punctuation": "[.,;:!?'\"()-]", "symbol": "[#*$%&|<>]",
}
#: One letter for each rank of a common word, so that a document's common words are a short string.
MARKS = "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    return F.coalesce(F.array_remove(F.split(text, WORD_GAP), ""), F.array().cast("array<string>"))


def count_chars(text: Column, pattern: str) -> Column:
    """Characters of ``text`` that match a one-character pattern."""
    return F.coalesce(F.length(F.regexp_replace(text, pattern.replace("[", "[^", 1) + "+" if pattern[0] == "[" else f"[^{pattern}]+", "")), F.lit(0)).cast("long")


def repeat_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more: the windows are sorted by hash, repeated ones
    keep their positions, and the union of [p, p + 3) over sorted positions is summed."""
    at = F.sequence(F.lit(0), F.size(words) - 3)
    keyed = F.sort_array(F.transform(at, lambda i: F.struct(
        F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("k"), i.alias("p"))))
    again = lambda a: F.filter(a, lambda x, i: (F.get(a, i - 1)["k"].eqNullSafe(x["k"])) | (F.get(a, i + 1)["k"].eqNullSafe(x["k"])))
    places = lambda a: F.sort_array(F.transform(a, lambda x: x["p"]))
    covered = lambda p: F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))), F.lit(0).cast("long"), lambda s, x: s + x)
    let = lambda value, f: F.get(F.transform(F.array(value), f), 0)  # noqa: E731  evaluated once, used often
    return F.when(F.size(words) < 3, F.lit(0).cast("long")).otherwise(let(keyed, lambda a: let(places(again(a)), covered)))


def js_distance(p: list[Column], q: list[Column]) -> Column:
    """Square root of the base-2 Jensen-Shannon divergence of two histograms of counts."""
    total = lambda xs: sum(xs[1:], xs[0]).cast("double")
    a, b = F.greatest(total(p), F.lit(1.0)), F.greatest(total(q), F.lit(1.0))
    term = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    parts = []
    for x, y in zip(p, q, strict=True):
        x, y = x / a, y / b
        m = (x + y) / 2
        parts.append(term(x, m) + term(y, m))
    return F.sqrt(F.greatest(sum(parts[1:], parts[0]) / 2, F.lit(0.0)))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add words and the counts that the rules need."""
    body = F.col(text)
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return (
        docs.withColumn("words", words_of(body))
        .withColumn("n_words", F.size("words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
        .withColumn("n_dup_lines", F.coalesce(F.size(lines) - F.size(F.array_distinct(lines)), F.lit(0)).cast("long"))
        .withColumn("n_repeat_words", repeat_words(F.col("words")))
        .withColumns({f"c_{name}": count_chars(body, pattern) for name, pattern in CLASSES.items()})
        .withColumn("c_other", F.col("word_chars") - sum((F.col(f"c_{n}") for n in CLASSES), F.lit(0)))
    )


def language_key(lang: Column) -> Column:
    """Distinguishes null from every value."""
    return F.when(lang.isNull(), "null").otherwise(F.concat(F.lit("="), lang))


def common_words(docs: DataFrame, k: int) -> DataFrame:
    """key -> its k most frequent lower-case words with counts, and the number of all words."""
    counts = pin(
        docs.select("key", F.explode(F.transform(words_of(F.col("text")), lambda w: F.lower(w))).alias("word"))
        .groupBy("key", "word").agg(F.count("*").alias("n")), "quality-words")
    # A language's words are ranked in 64 cells first, so that no task holds all words of a common language.
    rank = lambda *by: F.row_number().over(Window.partitionBy("key", *by).orderBy(F.col("n").desc(), "word"))
    cells = counts.withColumn("cell", F.pmod(F.xxhash64("word"), F.lit(64))).withColumn("r", rank("cell")).filter(F.col("r") <= k)
    top = cells.withColumn("r", rank()).filter(F.col("r") <= k)
    listed = top.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("r", "word", "n"))).alias("_t"))
    totals = counts.groupBy("key").agg(F.sum("n").alias("all_words"))
    return listed.join(totals, "key").select("key", F.col("_t.word").alias("common"), F.col("_t.n").alias("common_n"), "all_words")


def judge(
    docs: DataFrame, max_class_distance: float = 0.3, max_word_distance: float = 0.3, min_chars: int = 200,
    min_words: int = 100, k: int = 12, min_reference_words: int = 1000, min_reference_chars: int = 2000, none_share: float = 0.9,
) -> DataFrame:
    """One row per document: the counts, both distances, base_failed and kept.

    The joins by language have no broadcast hint: Spark sends small tables and sorts large ones, dividing a hot language."""
    source = docs.select("doc_id", "text", language_key(F.col("lang")).alias("key"))
    common = pin(common_words(source, k), "quality-common")
    letters = F.array(*[F.lit(x) for x in MARKS[:k]])
    marks = F.array_join(F.transform(
        F.filter(F.transform("words", lambda w: F.array_position("_common", F.lower(w)).cast("int")), lambda i: i > 0),
        lambda i: F.get(letters, i - 1)), "")
    of_word = {f"w_{x}": (F.length("_marks") - F.length(F.replace("_marks", F.lit(x), F.lit("")))).cast("long") for x in MARKS[:k]}
    measured = (
        measure(source.join(common.select("key", F.col("common").alias("_own")), "key", "left"))
        .withColumn("_common", F.coalesce("_own", F.array().cast("array<string>")))
        .withColumn("_marks", marks)
        .withColumns(of_word)
        .withColumn("w_other", F.col("n_words") - F.length("_marks"))
        .drop("text", "words", "_own", "_common", "_marks")
    )
    measured = pin(measured, "quality-measured")
    classes = [*[f"c_{n}" for n in CLASSES], "c_other"]
    in_common = [F.coalesce(F.get("common_n", F.lit(i)), F.lit(0)) for i in range(k)]
    rest = F.col("all_words") - sum(in_common[1:], in_common[0])
    none = js_distance([F.lit(0)] * k + [F.lit(1)], [*in_common, rest])
    ref = (
        measured.groupBy("key").agg(*[F.sum(c).alias(f"r{c}") for c in classes], F.sum("word_chars").alias("all_chars"))
        .join(common, "key", "left").withColumn("all_words", F.coalesce("all_words", F.lit(0)))
        .withColumn("word_limit", F.least(F.lit(max_word_distance), none_share * none))
    )
    ref = pin(ref, "quality-references")
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    few_chars = (F.col("word_chars") < min_chars) | (F.col("all_chars") - F.col("word_chars") < min_reference_chars)
    few_words = (F.col("n_words") < min_words) | (F.col("all_words") - F.col("n_words") < min_reference_words)
    return (
        measured.join(ref.drop("common"), "key", "left")
        .withColumn("class_distance", js_distance([F.col(c) for c in classes], [F.col(f"r{c}") for c in classes]))
        .withColumn("word_distance", js_distance([*[F.col(f"w_{x}") for x in MARKS[:k]], F.col("w_other")], [*in_common, rest]))
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed")
                    & (few_chars | (F.col("class_distance") <= max_class_distance))
                    & (few_words | (F.col("word_distance") <= F.col("word_limit"))))
        .select("doc_id", "n_words", "word_chars", F.col("c_symbol").alias("n_symbols"), "n_dup_lines", "n_repeat_words",
                "base_failed", "kept", F.round("class_distance", 6).alias("class_distance"), F.round("word_distance", 6).alias("word_distance"))
    )


def op8_quality_divergence(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` with their base counts and the divergence verdict."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
