"""Quarterly feature table in long form.

The reference builds one ~4.5k-column wide frame; here every feature is a
row ``(entity, feature, features_type, availability, date, value)`` and a
model cell pivots only its own <= a few hundred columns with explicit values.
"""

from __future__ import annotations

import dataclasses
import functools
import datetime as dt
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.functions.columns import month_in_quarter, to_date
from panelcast.operators.calendar import add_months, densify
from panelcast.operators.series import (SERIES_KEYS, TARGET_KEYS, add_lags, log_diff, positivity_profile,
                                        rolling_means, yoy_diff)
from panelcast.params import Params
from panelcast.sources import adapters

FEATURE_KEYS = ("entity", "feature")


def _memo(fn):
    """Build a piece once per PanelBuild and hand out the same DataFrame afterwards.

    Re-deriving a plan costs analysis time on the driver, and handing out
    one object lets Spark reuse identical exchanges.  Materialised pieces
    (``freeze``) take precedence.
    """
    name = fn.__name__

    @functools.wraps(fn)
    def wrapper(self):
        if name in self.frozen:
            return self.frozen[name]
        cache = self.__dict__.setdefault("_memo", {})
        if name not in cache:
            cache[name] = fn(self)
        return cache[name]

    return wrapper


def quarter_of(d: dt.date) -> dt.date:
    return dt.date(d.year, 3 * ((d.month - 1) // 3) + 1, 1)


def first_full_quarter(month_lo: dt.date) -> dt.date:
    """First quarter whose month 1 lies inside the monthly data."""
    q = quarter_of(month_lo)
    if q == month_lo:
        return q
    m = q.month + 3
    return dt.date(q.year + (m > 12), (m - 1) % 12 + 1, 1)


def last_full_quarter(last_day: dt.date) -> dt.date:
    """Start of the last quarter whose last day is not after ``last_day``."""
    return add_months(quarter_of(last_day + dt.timedelta(days=1)), -3)


def monthly_features(dense_m: DataFrame, profile: DataFrame, windows: Sequence[int]) -> DataFrame:
    """d12 and rolling-mean features, long: (entity, indicator, feature, features_type, width, date, value)."""
    rolled = rolling_means(yoy_diff(dense_m, profile), "d12", windows)
    items = [F.struct(F.lit("d12").alias("features_type"), F.lit(0).alias("width"),
                      F.col("feature").alias("feature"), F.col("d12").alias("value"))]
    items += [F.struct(F.lit("rolling").alias("features_type"), F.lit(k).alias("width"),
                       F.concat(F.col("feature"), F.lit(f"_roll_mean_{k}")).alias("feature"),
                       F.col(f"roll_{k}").alias("value")) for k in windows]
    return rolled.select("entity", "indicator", "date", F.explode(F.array(*items)).alias("f")).select(
        "entity", "indicator", "f.feature", "f.features_type", "f.width", "date", "f.value")


def to_quarterly(monthly_feats: DataFrame, first_quarter: dt.date) -> DataFrame:
    """Month-a value of quarter q becomes feature ``<feature>_m<a>`` at date q.

    Quarters whose first month is not in the monthly data are dropped (the
    reference keeps a quarter only when its month-1 row exists).
    """
    miq = month_in_quarter("date")
    return monthly_feats.select(
        "entity", "indicator", F.col("feature").alias("base_feature"),
        F.concat(F.col("feature"), F.lit("_m"), miq.cast("string")).alias("feature"),
        "features_type", "width", miq.alias("availability"),
        F.trunc("date", "quarter").alias("date"), "value",
    ).filter(F.col("date") >= to_date(first_quarter))


def quarter_pivot(monthly_feats: DataFrame, first_quarter: dt.date, last_quarter: dt.date) -> DataFrame:
    """J3 as a wide-by-month pivot: (entity, feature, features_type, date, m1, m2, m3).

    Explicit pivot values: no extra job to discover them, fixed plan width.
    """
    q = monthly_feats.select("entity", "feature", "features_type", month_in_quarter("date").alias("miq"),
                             F.trunc("date", "quarter").alias("date"), "value")
    return (q.filter(F.col("date").between(to_date(first_quarter), to_date(last_quarter)))
            .groupBy("entity", "feature", "features_type", "date")
            .pivot("miq", [1, 2, 3]).agg(F.max("value"))
            .withColumnsRenamed({"1": "m1", "2": "m2", "3": "m3"}))


def feature_lags(feat_q: DataFrame, lags: Sequence[int]) -> DataFrame:
    """Positional lags of every quarterly feature, long by lag (lag 0 = unlagged)."""
    lagged = add_lags(feat_q, "value", [k for k in lags if k > 0], FEATURE_KEYS, prefix="l")
    items = [F.struct(F.lit(k).alias("lag"), (F.col("value") if k == 0 else F.col(f"l{k}")).alias("value"))
             for k in lags]
    return lagged.select("entity", "feature", "features_type", "availability", "date",
                         F.explode(F.array(*items)).alias("x")).select(
        "entity", "feature", "features_type", "availability", "date", "x.lag", "x.value")


def target_lags(targets: DataFrame, lags: Sequence[int]) -> DataFrame:
    """Y lagged 1..H per (entity, target)."""
    return add_lags(targets, "y", lags, TARGET_KEYS, prefix="y_lag")


def cell_design(feat_q: DataFrame, targets: DataFrame, features_type: str, availability: int, target: str,
                horizon: int, strategy: str = "avail_only", start: dt.date | None = None) -> DataFrame:
    """Long design rows of one model cell.

    Features of quarter t-(h-1) (month ``availability`` only, or months
    1..availability for strategy ``all``), the target lagged h, and the label.
    Output: (entity, date, column, value); ``column == 'y'`` is the label.
    ``targets`` must already be restricted to the quarters that have features;
    the ``start`` filter is applied after the lags, as in the reference.
    """
    if horizon < 1:
        raise ValueError(f"horizon must be >= 1, got {horizon}")
    if strategy not in ("avail_only", "all"):
        raise ValueError("strategy must be 'avail_only' or 'all'")
    month_ok = (F.col("availability") == availability) if (strategy == "avail_only" or features_type == "rolling") \
        else (F.col("availability") <= availability)
    sel = feat_q.filter((F.col("features_type") == features_type) & month_ok)
    k = horizon - 1
    w = Window.partitionBy(*FEATURE_KEYS).orderBy("date")
    feats = sel.select("entity", "date", (F.concat(F.col("feature"), F.lit(f"_lag{k}")) if k else F.col("feature")).alias("column"),
                       (F.lag("value", k).over(w) if k else F.col("value")).alias("value"))
    t = targets.filter(F.col("target") == target)
    tw = Window.partitionBy(*TARGET_KEYS).orderBy("date")
    tl = t.select("entity", "date", F.lit(f"{target}_lag{horizon}").alias("column"), F.lag("y", horizon).over(tw).alias("value"))
    label = t.select("entity", "date", F.lit("y").alias("column"), F.col("y").alias("value"))
    rows = tl.unionByName(label)
    # keep only quarters present on both sides (J5 inner join)
    dates = feats.select("entity", "date").distinct()
    out = feats.join(t.select("entity", "date"), ["entity", "date"], "left_semi").unionByName(
        rows.join(dates, ["entity", "date"], "left_semi"))
    return out if start is None else out.filter(F.col("date") >= to_date(start))


@dataclasses.dataclass
class PanelBuild:
    """The feature build for one data set, each piece built once and reused.

    Bounds are three scalars per source, from its monthly aggregate; everything
    else stays a lazy DataFrame.
    """

    spark: SparkSession
    sf_dir: str
    params: Params
    frozen: dict = dataclasses.field(default_factory=dict, repr=False)

    def freeze(self) -> "PanelBuild":
        """Materialise the feature table and the aligned targets once (reliable checkpoint).

        A model grid reads them once per cell; without this every cell
        would re-run the whole feature build from the source tables.
        """
        from panelcast.session import cut_lineage

        if not self.frozen:
            self.frozen["feat_q"] = cut_lineage(self.feat_q())
            self.frozen["aligned_targets"] = cut_lineage(self.aligned_targets())
        return self

    @cached_property
    def order_months(self) -> DataFrame:
        """Orders aggregated to (entity, month), computed once per build (reliable checkpoint).

        Every panel, spine and bound below reads this small aggregate, so the
        fact table is scanned and shuffled once, not once per use in a plan.
        """
        from panelcast.session import cut_lineage

        return cut_lineage(adapters.order_months(self.spark, self.sf_dir))

    @cached_property
    def line_months(self) -> DataFrame:
        """Line items aggregated to (entity, month), computed once per build; quarters roll up from it."""
        from panelcast.session import cut_lineage

        return cut_lineage(adapters.line_months(self.spark, self.sf_dir))

    @cached_property
    def _month_facts(self) -> tuple[dt.date, dt.date, dt.date]:
        return adapters.bounds_of(self.order_months)

    @cached_property
    def _line_facts(self) -> tuple[dt.date, dt.date, dt.date]:
        return adapters.bounds_of(self.line_months)

    @property
    def month_bounds(self) -> tuple[dt.date, dt.date]:
        """First and last month of the order panel (from the aggregate: no scan of the facts)."""
        return self._month_facts[:2]

    @property
    def quarter_bounds(self) -> tuple[dt.date, dt.date]:
        """First and last quarter of the targets, the last one whether or not it is complete."""
        lo, hi, _ = self._line_facts
        return quarter_of(lo), quarter_of(hi)

    @property
    def first_quarter(self) -> dt.date:
        return max(first_full_quarter(self.month_bounds[0]), self.quarter_bounds[0])

    @property
    def anchor(self) -> dt.date:
        """The last quarter that both sources cover to its last day."""
        return min(last_full_quarter(self._month_facts[2]), last_full_quarter(self._line_facts[2]))

    @_memo
    def panel_m(self) -> DataFrame:
        return adapters.panel_m(self.order_months)

    @_memo
    def market_m(self) -> DataFrame:
        return adapters.market_m(self.line_months)

    @_memo
    def spine_m(self) -> DataFrame:
        """The order panel on its dense monthly spine."""
        lo, hi = self.month_bounds
        return densify(self.panel_m(), SERIES_KEYS, ["value"], lo, hi, 1)

    @_memo
    def dense_m(self) -> DataFrame:
        """Both monthly sources on the order spine (dates outside it are dropped)."""
        lo, hi = self.month_bounds
        return densify(self.panel_m().unionByName(self.market_m()), SERIES_KEYS, ["value"], lo, hi, 1)

    @_memo
    def profile(self) -> DataFrame:
        return positivity_profile(self.dense_m(), self.params.profile_until)

    @_memo
    def monthly_features(self) -> DataFrame:
        return monthly_features(self.dense_m(), self.profile(), self.params.windows)

    @_memo
    def feat_q(self) -> DataFrame:
        return to_quarterly(self.monthly_features(), self.first_quarter).filter(
            F.col("date") <= to_date(self.anchor))

    @_memo
    def panel_q(self) -> DataFrame:
        return adapters.panel_q(self.line_months)

    @_memo
    def targets(self) -> DataFrame:
        """(entity, target, date, level, y) with y = 4-quarter log difference, dense."""
        lo, hi = self.quarter_bounds
        dense = densify(self.panel_q(), TARGET_KEYS, ["level"], lo, hi, 3)
        return log_diff(dense, "level", 4).select(
            "entity", F.concat(F.col("target"), F.lit("_log_d4")).alias("target"), "date", "level", "y")

    @_memo
    def aligned_targets(self) -> DataFrame:
        """Targets on the quarters that also have monthly features (lags are taken after this)."""
        return self.targets().filter(F.col("date").between(to_date(self.first_quarter), to_date(self.anchor)))

    @_memo
    def actuals(self) -> DataFrame:
        """Aligned targets from the start year on (the rows a back-test scores)."""
        return self.aligned_targets().filter(F.col("date") >= to_date(self.params.start_date))

    def cell(self, features_type: str, availability: int, target: str, horizon: int,
             strategy: str = "avail_only") -> DataFrame:
        return cell_design(self.feat_q(), self.aligned_targets(), features_type, availability, target, horizon,
                           strategy, start=self.params.start_date)

    def split_bounds(self):
        from panelcast.operators.split import SplitBounds

        return SplitBounds.of(self.anchor, self.params)

    def test_bounds(self) -> tuple[dt.date, dt.date]:
        """B3 anchor window: last ``test_len`` quarters ending at the anchor."""
        hi = self.anchor
        return add_months(hi, -3 * (self.params.test_len - 1)), hi
