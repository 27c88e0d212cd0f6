"""Chart-ready frames: what each report page computes before drawing.

Every function returns a DataFrame; only these final, bounded results are
meant to be collected by a caller (a KPI row, ten bars, one line per
state).  ``ALL`` (None) as a state or selection means "no filter".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardstat.functions.measures import linear_fit, safe_corr
from wardstat.functions.names import col_of
from wardstat.operators import select as sel
from wardstat.plans import gold, jobs

ALL = None


def total_hours(hours: DataFrame, column: str = gold.TOTAL_RN_HOURS, name: str | None = None, digits: int | None = 2) -> DataFrame:
    """Grand total of a gold hours table; 0.0 when the column is absent.  Of a
    rollup table only the hours summary counts."""
    name = name or column
    if jobs.SUMMARY in hours.columns:
        hours = hours.filter(F.col(jobs.SUMMARY) == F.lit("onduty_hours_summary"))
    if column.lower() not in {c.lower() for c in hours.columns}:
        return hours.sparkSession.range(1).select(F.lit(0.0).alias(name))
    total = F.sum(col_of(column))
    if digits is not None:
        total = F.round(total, digits)
    return hours.agg(total.alias(name))


def hours_series(hours: DataFrame, day: str = "WorkDate", state: str = "STATE") -> DataFrame:
    """Duty-hours series per state, ordered by day (presentation order)."""
    return hours.orderBy(col_of(day), col_of(state))


def facility_kpis(
    detail: DataFrame,
    state: str | None = ALL,
    state_col: str = "State",
    hours: str = gold.STAFF_HOURS,
    count_name: str = "facilities",
    avg_name: str = "avg_hours",
    digits: int | None = None,
) -> DataFrame:
    """Facility count and mean staffing hours, one row, for a state or all."""
    rows = sel.equals(detail, state_col, state)
    avg = F.avg(col_of(hours))
    if digits is not None:
        avg = F.round(avg, digits)
    return rows.agg(F.count(F.lit(1)).alias(count_name), avg.alias(avg_name))


def trend_line(
    detail: DataFrame,
    y: str,
    x: str,
    by: Sequence[str] = (),
    state: str | None = ALL,
    state_col: str = "State",
) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` (n, slope, intercept, r2),
    for the whole filtered frame or one row per group in ``by``."""
    rows = sel.equals(detail, state_col, state)
    fit = linear_fit(y, x)
    aggs = [c.alias(k) for k, c in fit.items()]
    if by:
        return rows.groupBy(*[col_of(b) for b in by]).agg(*aggs)
    return rows.agg(*aggs)


def states(df: DataFrame, state_col: str = "State", alias: str | None = None) -> DataFrame:
    """Distinct non-NULL states (the selector's options)."""
    return sel.sorted_distinct(df, state_col, alias=alias)


def hospitals_in_state(df: DataFrame, state: str | None, name_col: str = "Provider_Name", state_col: str = "State") -> DataFrame:
    """Distinct hospital names of one state (all states for ``ALL``)."""
    return sel.sorted_distinct(sel.equals(df, state_col, state), name_col)


def selected_hospitals(
    df: DataFrame,
    names: Sequence[str] | DataFrame | None,
    name_col: str = "Provider_Name",
    state: str | None = ALL,
    state_col: str = "State",
) -> DataFrame:
    """Rows of the chosen hospitals; nothing chosen keeps every row.

    With ``state`` given, the state filter applies as well, so a namesake in
    another state is not pulled in.
    """
    return sel.one_of(sel.equals(df, state_col, state), name_col, names)


def default_selection(df: DataFrame, name_col: str = "Provider_Name", n: int = 5) -> DataFrame:
    """Rows of the first ``n`` names in sorted order (the page default)."""
    return sel.one_of(df, name_col, sel.first_names(df, name_col, n))


def hospital_bars(
    df: DataFrame, names: Sequence[str] | None, name_col: str, state: str | None = ALL, state_col: str = "State", n: int = 5
) -> DataFrame:
    """Bars of the chosen hospitals of a state; of its first ``n`` names in
    order while none is chosen."""
    rows = sel.equals(df, state_col, state)
    return selected_hospitals(rows, names, name_col) if names else default_selection(rows, name_col, n)


def scatter_points(df: DataFrame, x: str, y: str, state: str | None = ALL, state_col: str = "State") -> DataFrame:
    """The points of the scatter chart: rows of a state with both values."""
    rows = sel.equals(df, state_col, state)
    return rows.filter(col_of(x).isNotNull() & col_of(y).isNotNull())


def top_throughput(
    df: DataFrame,
    n: int = 10,
    by: str = gold.THROUGHPUT,
    key: str = gold.CCN,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The ``n`` facilities with the highest throughput; ties by key."""
    top = sel.top_n(df, n, by, tie_break=key)
    return top.select(*[col_of(c) for c in columns]) if columns else top


def kpi_cards(
    detail: DataFrame,
    state: str | None = ALL,
    state_col: str = "State",
    hours: str = gold.STAFF_HOURS,
    rate: str = gold.READMISSION,
    digits: int | None = None,
    stored: float | None = None,
    use_stored: bool = False,
) -> DataFrame:
    """The report's three cards in one row: facilities in the chosen state,
    their mean staffing hours, and the correlation over *all* states (the
    page shows the global r beside state-filtered counts).

    One aggregation pass over the detail table: the state choice is a
    condition inside the aggregates, so no second scan and no join of
    one-row frames is needed.  With ``use_stored`` the correlation is the
    value ``stored`` in the summary table (NULL while there is none).
    """
    match = F.lit(True) if state is None else (col_of(state_col) == F.lit(state))
    avg = F.avg(F.when(match, col_of(hours)))
    corr = F.max(F.lit(stored).cast("double")) if use_stored else safe_corr(hours, rate, missing="drop")
    if digits is not None:
        avg, corr = F.round(avg, digits), F.round(corr, digits)
    return detail.agg(
        F.count_if(match).alias("facilities"),
        avg.alias("avg_hours"),
        corr.alias("correlation"),
    )


def scalar(df: DataFrame, column: str):
    """Read one value from a one-row result (e.g. the stored correlation)."""
    row = df.select(col_of(column)).first()
    return None if row is None else row[0]


def collect_bounded(df: DataFrame, max_rows: int = 100_000):
    """Load a final result into local memory (pandas, over Arrow) only when
    it has at most ``max_rows`` rows; a larger result raises instead of
    pulling an unbounded table through the driver."""
    head = df.limit(max_rows + 1).toPandas()
    if len(head) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; aggregate or filter it first")
    return head


def scatter_binned(
    detail: DataFrame,
    x: str,
    y: str,
    x_range: tuple[float, float],
    y_range: tuple[float, float],
    bins: int = 50,
    state: str | None = ALL,
    state_col: str = "State",
) -> DataFrame:
    """A scatter plot of any number of points: at most ``bins`` x ``bins``
    cells with the points in them, their means, and the least-squares line of
    all points (the same in every row).

    One aggregate makes the cells with their counts, sums and sums of squares;
    the line is computed from the cells, not from the points.  Points outside
    the ranges are counted in the cells at the edges.  Pairs with a missing
    value are no points.  Sums are taken about the middle of the ranges, so
    that large values do not cost digits.
    """
    rows = sel.equals(detail, state_col, state).select(col_of(x).cast("double").alias("x"), col_of(y).cast("double").alias("y"))
    rows = rows.filter(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y"))
    (x0, x1), (y0, y1) = x_range, y_range
    if not (x0 < x1 and y0 < y1 and bins > 0):
        raise ValueError("ranges must rise and there must be a bin")

    def cell(c: str, low: float, high: float) -> F.Column:
        return F.least(F.greatest(F.floor((F.col(c) - low) / (high - low) * bins), F.lit(0)), F.lit(bins - 1)).cast("int")

    dx, dy = F.col("x") - (x0 + x1) / 2, F.col("y") - (y0 + y1) / 2
    cells = rows.groupBy(cell("x", x0, x1).alias("x_bin"), cell("y", y0, y1).alias("y_bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(dx).alias("sx"), F.sum(dy).alias("sy"),
        F.sum(dx * dx).alias("sxx"), F.sum(dx * dy).alias("sxy"), F.sum(dy * dy).alias("syy"),
    )
    whole = Window.partitionBy()  # over the cells: bins x bins rows at most
    n, sx, sy, sxx, sxy, syy = (F.sum(c).over(whole) for c in ("n", "sx", "sy", "sxx", "sxy", "syy"))
    told = cells.select(
        "x_bin", "y_bin", F.col("n").alias("points"), (F.col("sx") / F.col("n") + (x0 + x1) / 2).alias("mean_x"),
        (F.col("sy") / F.col("n") + (y0 + y1) / 2).alias("mean_y"), n.alias("n_all"), (sx / n).alias("mx"), (sy / n).alias("my"),
        (sxx - sx * sx / n).alias("cxx"), (sxy - sx * sy / n).alias("cxy"), (syy - sy * sy / n).alias("cyy"),
    )
    slope = F.try_divide(F.col("cxy"), F.col("cxx"))
    intercept = F.col("my") + (y0 + y1) / 2 - slope * (F.col("mx") + (x0 + x1) / 2)
    r2 = F.try_divide(F.col("cxy") * F.col("cxy"), F.col("cxx") * F.col("cyy"))
    return told.select("x_bin", "y_bin", "points", "mean_x", "mean_y", slope.alias("slope"), intercept.alias("intercept"), r2.alias("r2"))
