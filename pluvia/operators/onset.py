"""Season-onset detection on daily rain, as windows over rows or as higher-order functions over arrays.

A day starts the season if its trigger window is wet by the rule, its sum exceeds the threshold strictly, and no
dry spell follows within the follow-up period.  Days are numbered from 1; the calendar must be dense.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import by_position, let, total


@dataclass(frozen=True)
class OnsetRule:
    window: int = 5
    wet_day_min_mm: float = 1.0
    trigger_rule: str = "all_days_wet"
    wet_day_comparison: str = "gte"
    follow_days: int = 21
    followup_anchor: str = "after_trigger"
    mode: str = "consecutive_dry"
    min_dry_days: int = 7
    dry_day_min_mm: float | None = None
    sum_window: int = 10
    sum_min_mm: float = 5.0
    reject_if_short_followup: bool = False

    def __post_init__(self):
        for name, allowed in (("trigger_rule", ("all_days_wet", "first_day_wet")), ("wet_day_comparison", ("gte", "gt")),
                              ("followup_anchor", ("after_trigger", "onset_day")), ("mode", ("consecutive_dry", "window_sum"))):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}, not {getattr(self, name)!r}")
        if self.window < 1 or self.follow_days < 0 or self.min_dry_days < 1 or self.sum_window < 1:
            raise ValueError("window, min_dry_days and sum_window must be at least 1, follow_days at least 0")

    @property
    def dry_below(self) -> float:
        return self.wet_day_min_mm if self.dry_day_min_mm is None else self.dry_day_min_mm

    @property
    def reach(self) -> tuple[int, int, int]:
        """(first follow-up day, last one, last start of a spell or window), relative to the candidate day."""
        after = self.followup_anchor == "after_trigger"
        low, high = (self.window, self.window - 1 + self.follow_days) if after else (0, self.follow_days)
        return low, high, high - (0 if self.mode == "consecutive_dry" else self.sum_window - 1)

    def wet(self, x: Column) -> Column:
        hit = x >= self.wet_day_min_mm if self.wet_day_comparison == "gte" else x > self.wet_day_min_mm
        return F.coalesce(hit, F.lit(False))


def over(keys: list[str], low: int, high: int, day: str = "d"):
    return Window.partitionBy(*keys).orderBy(day).rowsBetween(low, high)


def rolling_sum(x: Column, keys: list[str], k: int, propagate: bool = False) -> Column:
    """Sum of k days from each day on; NULL days count as zero or make it NULL.  Windows cut by the series' end
    are NULL."""
    w = over(keys, 0, k - 1)
    full = F.count(F.lit(1)).over(w) == k
    if propagate:
        return F.when(full & (F.count(x).over(w) == k), F.sum(x).over(w))
    return F.when(full, F.sum(F.coalesce(x, F.lit(0.0))).over(w))


def dry_run_start(x: Column, keys: list[str], k: int, below: float) -> Column:
    """Days on which a maximal dry run of at least k days starts; NULL is not dry."""
    dry = F.coalesce((x < below).cast("int"), F.lit(0))
    run = F.sum(dry).over(over(keys, 0, k - 1)) == k
    return run & (F.coalesce(F.lag(dry).over(Window.partitionBy(*keys).orderBy("d")), F.lit(0)) == 0)


def bad_window(x: Column, keys: list[str], k: int, below: float) -> Column:
    """Days on which a complete window of k days has a sum under the limit."""
    w = over(keys, 0, k - 1)
    return (F.count(x).over(w) == k) & (F.sum(x).over(w) < below)


def candidates(days: DataFrame, rule: OnsetRule, keys: list[str], rain: str = "x", threshold: str = "threshold") -> DataFrame:
    """days (keys, d, rain, threshold) -> adds ``ok``: the day is an onset if the search starts at or before it."""
    x = F.col(rain)
    flag = dry_run_start(x, keys, rule.min_dry_days, rule.dry_below) if rule.mode == "consecutive_dry" else bad_window(x, keys, rule.sum_window, rule.sum_min_mm)
    low, high, last = rule.reach
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    veto = F.coalesce(F.max(F.col("_flag").cast("int")).over(over(keys, low, last)), F.lit(0)) if last >= low else F.lit(0)
    trigger = over(keys, 0, rule.window - 1)
    wet = rule.wet(x)
    wet_rule = (F.sum(wet.cast("int")).over(trigger) == rule.window) if rule.trigger_rule == "all_days_wet" else wet
    ok = (
        (F.col("d") <= n - rule.window + 1) & x.isNotNull() & wet_rule
        & (F.sum(F.coalesce(x, F.lit(0.0))).over(trigger) > F.col(threshold)) & (veto == 0)
    )
    if rule.reject_if_short_followup:
        ok = ok & (F.col("d") + high <= n)
    return days.withColumn("_flag", flag).withColumn("ok", F.coalesce(ok, F.lit(False))).drop("_flag")


def first_onset(days: DataFrame, rule: OnsetRule, keys: list[str], start: Column | None = None, rain: str = "x", threshold: str = "threshold") -> DataFrame:
    """keys, onset_idx: the first day from ``start`` on that starts the season, NULL if none."""
    start = F.lit(1) if start is None else F.ceil(start)
    hit = F.col("ok") & (F.col("d") >= F.greatest(F.lit(1), start))
    return candidates(days, rule, keys, rain, threshold).groupBy(*keys).agg(F.min(F.when(hit, F.col("d"))).cast("int").alias("onset_idx"))


def onset_of_array(a: Column, threshold: Column, rule: OnsetRule, start: Column | None = None) -> Column:
    """The same search within one row: ``a`` is the series; needs no shuffle."""
    begin = F.greatest(F.lit(1), F.ceil(start).cast("int")) if start is not None else F.lit(1)
    return F.get(onset_days(a, threshold, rule, begin), 0).cast("int")


def first_from(days: Column, start: Column) -> Column:
    """The first of the sorted ``days`` (from :func:`onset_days`) from ``start`` on: several searches of one series."""
    return F.get(F.filter(days, lambda d: d >= F.ceil(start)), 0).cast("int")


def _marks(days: Column, holds) -> Column:
    """A string with a 1 for each element that ``holds`` (element, position from 0) and a 0 for the others."""
    return F.array_join(F.transform(days, lambda x, i: F.when(F.coalesce(holds(x, i), F.lit(False)), "1").otherwise("0")), "")


def _bad_days(a: Column, rule: OnsetRule) -> Column:
    """Marks of the days on which a dry spell begins that vetoes an onset."""
    if rule.mode == "consecutive_dry":
        k = rule.min_dry_days
        run = lambda dry: F.transform(F.sequence(F.lit(1), F.size(a)), lambda i: (F.substring(dry, i, F.lit(k)) == "1" * k) & ((i == 1) | (F.substring(dry, i - 1, F.lit(1)) == "0")))
        return let(_marks(a, lambda x, _: x < rule.dry_below), lambda dry: _marks(run(dry), lambda b, _: b))
    k = rule.sum_window
    low_sum = lambda part: (F.size(part) == k) & (F.aggregate(part, F.lit(0.0), lambda s, x: s + x) < rule.sum_min_mm)  # noqa: E731  NULL days make it NULL
    return _marks(a, lambda _, i: let(F.slice(a, i + 1, k), low_sum))


def onset_days(a: Column, threshold: Column, rule: OnsetRule, begin: Column | None = None) -> Column:
    """All days from ``begin`` on that start the season if the search does not start later.

    Wet days and the days on which dry spells begin are marked in one pass over the series each; a candidate day looks its
    trigger window and its follow-up period up in the marks, so the cost is linear in the days."""
    n, begin = F.size(a), F.lit(1) if begin is None else begin
    low, high, last = rule.reach
    span = rule.window if rule.trigger_rule == "all_days_wet" else 1
    bad = _bad_days(a, rule) if last >= low else F.lit("")

    def search(s: Column) -> Column:
        def fits(d: Column) -> Column:
            ok = (F.substring(s["wet"], d, F.lit(span)) == "1" * span) & F.get(a, d - 1).isNotNull()
            if last >= low:
                ok = ok & (F.instr(F.substring(s["bad"], d + low, F.lit(last - low + 1)), "1") == 0)
            if rule.reject_if_short_followup:
                ok = ok & (d + high <= n)
            return F.coalesce(ok & (F.aggregate(F.slice(a, d, rule.window), F.lit(0.0), lambda t, x: t + F.coalesce(x, F.lit(0.0))) > threshold), F.lit(False))

        return F.filter(F.sequence(begin, n - rule.window + 1), fits)

    found = let(F.struct(_marks(a, lambda x, _: rule.wet(x)).alias("wet"), bad.alias("bad")), search)
    return F.when((begin <= n - rule.window + 1) & threshold.isNotNull(), found)


def threshold_quantile(days: DataFrame, k: int, q: float, id_col: str = "id", keys: list[str] | None = None, rain: str = "x") -> DataFrame:
    """id -> threshold: the exact q-quantile (linear interpolation) of the k-day sums of complete windows."""
    sums = days.select(id_col, rolling_sum(F.col(rain), keys or [id_col], k, propagate=True).alias("r"))
    return sums.groupBy(id_col).agg(F.percentile("r", q).alias("threshold"))


def scale_threshold(x: Column, factor: float = 1.0, offset: float = 0.0, low: float | None = None, high: float | None = None) -> Column:
    out = x * factor + offset
    out = out if low is None else F.when(out.isNotNull(), F.greatest(out, F.lit(low)))
    return out if high is None else F.when(out.isNotNull(), F.least(out, F.lit(high)))


def lead_start(issue: Column, reference: Column, default: int | None = 1) -> Column:
    """First lead whose date (issue + lead) is on or after ``reference``; ``default`` where that is missing."""
    return F.coalesce(F.greatest(F.lit(1), F.datediff(reference, issue)), F.lit(default))


def lead_position(leads: Column, offset: Column, default: Column | int = 1, none: int = 9999) -> Column:
    """1-based position of the first of the sorted ``leads`` that is at least ``offset``, ``none`` if all are smaller;
    ``default`` where the offset is missing.  The leads may have gaps."""
    position = F.size(F.filter(leads, lambda x: x < offset)) + 1
    known = F.when(position > F.size(leads), F.lit(none)).otherwise(position)
    return F.when(offset.isNull(), F.lit(default) if isinstance(default, int) else default).otherwise(known)


def start_positions(rows: DataFrame, leads: DataFrame, keys: list[str], offset: str = "offset", lead: str = "lead", none: int = 9999) -> DataFrame:
    """:func:`lead_position` where the leads are a table (keys, lead): rows -> adds ``position``, 1 without an offset.

    Offsets and leads meet in one ordered window of their union, each offset taking the number of leads before it: an
    as-of join without a comparison of every offset with every lead."""
    known = leads.select(*keys, lead).distinct()
    sides = rows.select(*keys, F.col(offset).alias("_at")).filter("_at IS NOT NULL").distinct().withColumn("_lead", F.lit(0)).unionByName(
        known.select(*keys, F.col(lead).alias("_at"), F.lit(1).alias("_lead")))
    before = Window.partitionBy(*keys).orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
    counted = sides.withColumn("_n", F.coalesce(F.sum("_lead").over(before), F.lit(0))).withColumn("_all", F.sum("_lead").over(Window.partitionBy(*keys))).filter("_lead = 0")
    place = F.when(F.col("_n") < F.col("_all"), F.col("_n") + 1).otherwise(none)
    found = counted.select(*keys, F.col("_at").alias(offset), place.cast("int").alias("position"))
    return rows.join(found, [*keys, offset], "left").withColumn("position", F.when(F.col(offset).isNull(), 1).otherwise(F.col("position")))


def onset_probabilities(members: DataFrame, keys: list[str], onsets: list[str], horizon: int, rain: str | None = None) -> DataFrame:
    """Members' onset leads -> per key and variant the share of all members with onset on lead 1..horizon.

    With ``rain``, the members' arrays, the shares are NULL where no member has any value."""
    share = lambda c, k: F.count_if(F.col(c) == k) / F.count(F.lit(1))
    known = F.lit(True) if rain is None else F.coalesce(F.bool_or(F.exists(rain, lambda x: x.isNotNull())), F.lit(False))
    return members.groupBy(*keys).agg(*[F.when(known, F.array(*[share(c, k) for k in range(1, horizon + 1)])).alias(f"p_{c}") for c in onsets])


def ensemble_stats(members: DataFrame, keys: list[str], x: str = "x", rain_above: float = 1.0, lead: str = "lead") -> DataFrame:
    """Mean and sample deviation of the members that have a value, and the share of all members with rain.

    The share is NULL where no lead of the series (the keys without ``lead``) has any value."""
    out = members.groupBy(*keys).agg(
        F.avg(x).alias("rain_mean"), F.stddev_samp(x).alias("rain_sd"),
        F.avg(F.coalesce((F.col(x) > rain_above).cast("int"), F.lit(0))).alias("frac_raining"))
    known = F.count("rain_mean").over(Window.partitionBy(*[k for k in keys if k != lead])) > 0
    return out.withColumn("frac_raining", F.when(known, F.col("frac_raining")))


def member_stats(members: Column, rain_above: float = 1.0) -> Column:
    """:func:`ensemble_stats` within one row: the members' arrays -> rain_mean, rain_sd and frac_raining by lead.

    Leads are not grouped, so a task needs no more memory for more series.  A member counts on the leads of its array only;
    without any lead the result is NULL."""
    def of(v: Column, k: Column, mean: Column, known: Column) -> Column:
        squares = F.aggregate(k, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean))
        return F.struct(
            mean.alias("rain_mean"), F.when(F.size(k) > 1, F.sqrt(squares / (F.size(k) - 1))).alias("rain_sd"),
            F.when(known, F.size(F.filter(v, lambda x: x > rain_above)) / F.size(v)).alias("frac_raining"))

    def one(v: Column, known: Column) -> Column:
        return let(F.filter(v, lambda x: x.isNotNull()), lambda k: let(total(k) / F.nullif(F.size(k), F.lit(0)), lambda mean: of(v, k, mean, known)))

    any_value = lambda m: F.coalesce(F.exists(m, lambda a: F.exists(a, lambda x: x.isNotNull())), F.lit(False))
    return let(members, lambda m: let(any_value(m), lambda known: F.transform(by_position(m), lambda v: one(v, known))))
