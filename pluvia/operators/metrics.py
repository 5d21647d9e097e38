"""Forecast scores: pooled, per cell and per year."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import arrays as A
from .fits import beside
from .scan import prefix_sums


def levels(scores: DataFrame, keys: list[str]) -> DataFrame:
    """keys, score -> positives and negatives at each distinct score; ``scores`` has score and label (0 or 1)."""
    return scores.groupBy(*keys, "score").agg(F.sum("label").cast("double").alias("pos"), F.sum(1 - F.col("label")).cast("double").alias("neg"))


def rank_scores(counted: DataFrame, keys: list[str]) -> DataFrame:
    """keys -> auc, the rank-sum AUC with ties by average rank, and pietra, the largest distance of the two classes'
    distribution functions; NULL where a class is missing.  ``counted`` is from :func:`levels`; the running counts are a
    distributed scan, so that a key's distinct scores may be any number."""
    one = counted if keys else counted.withColumn("_one", F.lit(0))
    own = keys or ["_one"]
    run = prefix_sums(one, own, ["score"], ["pos", "neg"])
    wins = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2))
    share = lambda c: (F.col(f"{c}_below") + F.col(c)) / F.nullif(F.col(f"{c}_all"), F.lit(0.0))
    return run.groupBy(*own).agg((wins / F.nullif(F.first("pos_all") * F.first("neg_all"), F.lit(0.0))).alias("auc"), F.max(F.abs(share("pos") - share("neg"))).alias("pietra")).drop("_one")


def auc(scores: DataFrame, keys: list[str]) -> DataFrame:
    return rank_scores(levels(scores, keys), keys).drop("pietra")


def pietra(scores: DataFrame, keys: list[str]) -> DataFrame:
    return rank_scores(levels(scores, keys), keys).drop("auc")


def flat_scores(df: DataFrame, keys: list[str], p: str = "p", y: str = "y") -> DataFrame:
    """One row per row and bin: bin, score, label."""
    return df.select(*keys, F.posexplode(p).alias("bin", "score"), F.col(y).alias("_y")).select(
        *keys, (F.col("bin") + 1).alias("bin"), "score", (F.col("_y") == F.col("bin") + 1).cast("int").alias("label"))


def complete(df: DataFrame, p: str = "p", y: str = "y") -> DataFrame:
    """Rows with an outcome and all probabilities."""
    return df.filter(F.col(y).isNotNull() & ~F.exists(p, lambda x: x.isNull()))


def _row_scores(df: DataFrame, bins: int, p: str, y: str) -> DataFrame:
    """Complete rows with _b, _r and _f: Brier, ranked and fair Brier score of each."""
    hot = A.one_hot(F.col(y), bins)
    return complete(df, p, y).withColumn("_b", A.brier(F.col(p), hot)).withColumn("_r", A.rps(F.col(p), hot)).withColumn("_f", F.col("_b") - A.fair_correction(F.col(p)))


def scores(df: DataFrame, keys: list[str], bins: int, p: str = "p", y: str = "y") -> DataFrame:
    """keys -> n, brier, fair_brier, rps, auc."""
    rows = _row_scores(df, bins, p, y)
    base = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("_b").alias("brier"), F.avg("_f").alias("fair_brier"), F.avg("_r").alias("rps"))
    return base.join(auc(flat_scores(rows, keys, p, y), keys), keys, "left")


def cell_and_pooled(df: DataFrame, bins: int, p: str = "p", y: str = "y") -> DataFrame:
    """Scores per id and for 'ALL', the pooled row with its Pietra statistic and ``brier_bin<k>`` and ``auc_bin<k>``.

    Rows are scored once and summed by unit, and the units' sums make the pooled row.  Scores are counted once by (unit,
    bin, value); these counts are regrouped by unit, by bin and over all, and ranked in one scan."""
    cell = F.col("id").cast("string")
    sums = ["n", "_b", "_f", "_r"]
    each = _row_scores(df, bins, p, y).groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in sums[1:]])
    every = each.unionByName(each.agg(*[F.sum(c).alias(c) for c in sums]).filter("n > 0").withColumn("cell", F.lit("ALL")))
    mean = {"brier": "_b", "fair_brier": "_f", "rps": "_r"}
    table = every.select("cell", "n", *[(F.col(c) / F.col("n")).alias(out) for out, c in mean.items()])

    counted = levels(flat_scores(complete(df, p, y), ["id"], p, y), ["id", "bin"])
    group = lambda of, name: F.struct(F.lit(of).alias("of"), name.alias("name"))
    groups = F.array(group("cell", cell), group("bin", F.col("bin").cast("string")), group("all", F.lit("ALL")))
    grouped = counted.select(F.explode(groups).alias("g"), "score", "pos", "neg").select("g.*", "score", "pos", "neg").groupBy("of", "name", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    ranked = rank_scores(grouped, ["of", "name"])
    loss = F.col("pos") * F.pow(1 - F.col("score"), F.lit(2.0)) + F.col("neg") * F.pow(F.col("score"), F.lit(2.0))
    briers = counted.groupBy(F.col("bin").cast("string").alias("name")).agg((F.sum(loss) / F.sum(F.col("pos") + F.col("neg"))).alias("brier"))
    by_bin = briers.join(ranked.filter("of = 'bin'"), "name", "left").agg(
        *[F.max(F.when(F.col("name") == str(k), F.col(c))).alias(f"{c}_bin{k}") for c in ("brier", "auc") for k in range(1, bins + 1)])
    own = ranked.filter("of <> 'bin'").select(F.col("name").alias("cell"), "auc", F.when(F.col("of") == "all", F.col("pietra")).alias("pietra"))
    return beside(table, own, ["cell"], "left").join(F.broadcast(by_bin.withColumn("_all", F.lit("ALL"))), F.col("cell") == F.col("_all"), "left").drop("_all")  # one row


def per_bin(df: DataFrame, bins: int, p: str = "p", y: str = "y") -> DataFrame:
    """bin -> brier and auc of that bin alone."""
    flat = flat_scores(complete(df, p, y), [], p, y)
    return flat.groupBy("bin").agg(F.avg(F.pow(F.col("score") - F.col("label"), 2)).alias("brier")).join(auc(flat, ["bin"]), "bin")


def skill(table: DataFrame, baseline: str, model: str = "model") -> DataFrame:
    """Brier and RPS skill against the baseline's row, and the AUC difference in points."""
    base = lambda c: F.max(F.when(F.col(model) == baseline, F.col(c))).over(Window.partitionBy())
    return table.select(model, (1 - F.col("brier") / base("brier")).alias("brier_skill"), (1 - F.col("rps") / base("rps")).alias("rps_skill"), ((F.col("auc") - base("auc")) * 100).alias("auc_points"))
