"""Column-expression helpers (all JVM-side built-ins, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

# Fixed values that must equal the reference's labels and thresholds.
# Weekday names in Monday-first order, as used for ordered reports.
WEEKDAYS_MONDAY_FIRST = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
# Trading sessions by UTC hour: [0,8) Asia, [8,16) Europe, [16,24) America.
SESSION_ASIA = "Asie (00-08 UTC)"
SESSION_EUROPE = "Europe (08-16 UTC)"
SESSION_AMERICA = "Amerique (16-00 UTC)"
SESSIONS = [SESSION_ASIA, SESSION_EUROPE, SESSION_AMERICA]
# Volatility regime labels (low / medium / high), cut at the 0.33 / 0.66 quantiles.
REGIMES = ["Faible", "Moyenne", "Elevee"]
REGIME_Q_LOW, REGIME_Q_HIGH = 0.33, 0.66
# RSI zones.
RSI_OVERSOLD, RSI_OVERBOUGHT = 30.0, 70.0
# Symbols analysed by the notebooks.
CORE_SYMBOLS = ["BTCUSDT", "ETHUSDT", "SOLUSDT"]


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def series_window(part: list[str], order: str = "timestamp") -> WindowSpec:
    return Window.partitionBy(*part).orderBy(order)


def rows(w: WindowSpec, back: int, fwd: int = 0) -> WindowSpec:
    return w.rowsBetween(-back, fwd)


def full_window(agg: Column, value, w: WindowSpec, n: int) -> Column:
    """pandas ``rolling(n)`` semantics: NULL until the frame holds n non-null values."""
    return F.when(F.count(col(value)).over(rows(w, n - 1)) == n, agg.over(rows(w, n - 1)))


def pct_change(value, w: WindowSpec, periods: int = 1) -> Column:
    """``x / lag(x) - 1`` with NULL on missing or zero previous value."""
    return F.try_divide(col(value), F.lag(col(value), periods).over(w)) - F.lit(1.0)


def safe_corr_pop(x: Column, y: Column) -> Column:
    """Pearson correlation that is NULL (not an error / NaN) on zero variance."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def time_parts(ts) -> list[Column]:
    t = col(ts)
    return [F.to_date(t).alias("date"), F.hour(t).cast("bigint").alias("hour"),
            F.date_format(t, "EEEE").alias("day_of_week")]


def trading_session(hour) -> Column:
    h = col(hour)
    return (F.when((h >= 0) & (h < 8), F.lit(SESSION_ASIA))
            .when((h >= 8) & (h < 16), F.lit(SESSION_EUROPE))
            .otherwise(F.lit(SESSION_AMERICA)))


def base_asset(symbol) -> Column:
    return F.replace(col(symbol), F.lit("USDT"), F.lit(""))


def weekday_ordinal(day_name) -> Column:
    """0 = Monday ... 6 = Sunday, for ordering weekday reports."""
    return F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS_MONDAY_FIRST]), col(day_name)) - 1


def sample_skewness(x: Column) -> Column:
    """Bias-corrected skewness (pandas ``skew``): G1 = g1 * sqrt(n(n-1)) / (n-2)."""
    n = F.count(x).cast("double")
    return F.when(n >= 3, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(x: Column) -> Column:
    """Bias-corrected excess kurtosis (pandas ``kurt``)."""
    n = F.count(x).cast("double")
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(x) + 6))


def equal_width_bin(v, lo, hi, nbins: int) -> Column:
    """numpy-style histogram bin 1..n over [lo, hi], last bin closed; NULL if lo == hi."""
    v, lo, hi = col(v), col(lo), col(hi)
    raw = F.floor((v - lo) / (hi - lo) * nbins).cast("bigint") + 1
    return F.when(hi > lo, F.least(raw, F.lit(nbins)))


def r8(c) -> Column:
    """Round a double to 8 dp for oracle comparison."""
    return F.round(col(c), 8)


def tcast(c, to: str) -> Column:
    """``TRY_CAST``: NULL instead of an error when the value does not convert."""
    return col(c).try_cast(to)


def _dec(v: int) -> Column:
    return F.lit(str(v)).cast("decimal(38,0)")


def packed_order(major, minor, minor_bits: int = 64) -> Column:
    """One exact DECIMAL(38,0) sort key for the pair (major, minor).

    ``major * 2^bits + (minor + 2^(bits-1))`` keeps the lexicographic order of
    (major, minor) for a signed ``minor`` of ``bits`` bits and |major| < 2^63 / 2^(bits-11)
    (e.g. epoch microseconds within +-285 years with a 64-bit id).  Unlike a
    struct key it is a fixed-width aggregation buffer, so ``min_by``/``max_by``
    stay in hash aggregation instead of falling back to a sort-based one.
    """
    return (col(major).cast("decimal(38,0)") * _dec(2 ** minor_bits)
            + (col(minor).cast("decimal(38,0)") + _dec(2 ** (minor_bits - 1))))
