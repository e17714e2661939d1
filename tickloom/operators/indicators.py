"""Technical indicators for every bar of a table at once.

Each value looks back over the bars of the ``lookback_days`` before its date, that date included.
"The newest n bars of that range" needs two frames: with n or more bars in range the newest n
rows are all inside it, so a rows frame is right; with fewer, all bars in range count, so a range
frame is right.

Price moves are stored on the *older* bar of each pair. A frame that ends one row before the
current bar then holds exactly the moves between bars inside the range, and "no loss at all" is
an exact zero.

``order`` keeps two readings of RSI and OBV apart: ``newest_first`` walks the history backwards,
so a falling price counts as a gain and OBV has nothing to add up; ``oldest_first`` is the usual
definition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.history import join_prev_state
from tickloom.operators.recurrence import MARKS, Smoothing, mark_segments, smooth
from tickloom.schemas import DAILY_BARS, DAILY_INDICATORS

# Window lengths in bars, signal length, reach of the history and of the state.
WINDOWS = (60, 26, 12)
SIGNAL_WINDOW = 9
LOOKBACK_DAYS = 90
MAX_GAP_DAYS = 5

ORDERS = ("newest_first", "oldest_first")

def _weight(window: int) -> float:
    return 2 / (window + 1)


class _Lookback:
    """Windowed values of one pass over the bars, and the indicators made from them, as SQL.

    Every frame is computed once, in ``frames``, however many indicators use it.
    """

    def __init__(self, windows: Sequence[int], lookback_days: int, order: str = "newest_first"):
        if order not in ORDERS:
            raise ValueError(f"order must be one of {ORDERS}, not {order!r}")
        self.windows, self.days, self.order = windows, lookback_days, order
        self.frames: dict[str, str] = {}
        self.out: dict[str, str] = {}

    def _frame(self, name: str, aggregate: str, rows: str) -> str:
        self.frames[name] = f"{aggregate} OVER (PARTITION BY symbol ORDER BY _day {rows})"
        return name

    def _in_range(self, name: str, aggregate: str, until: str = "CURRENT ROW") -> str:
        """Aggregate over the bars of the last days."""
        return self._frame(name, aggregate, f"RANGE BETWEEN {self.days} PRECEDING AND {until}")

    def _newest(self, n: int, name: str, aggregate: str, until: str = "CURRENT ROW") -> str:
        """Aggregate over the newest n bars."""
        return self._frame(f"{name}_{n}", aggregate, f"ROWS BETWEEN {n - 1} PRECEDING AND {until}")

    def sma(self) -> _Lookback:
        fewer = self._in_range("_mean", "avg(avg_price)")
        for n in self.windows:
            newest = self._newest(n, "_mean", "avg(avg_price)")
            self.out[f"ma_{n}"] = f"CASE WHEN _bars >= {n} THEN {newest} ELSE {fewer} END"
        return self

    def rsi(self) -> _Lookback:
        rise, fall = "sum(greatest(_move, 0D))", "sum(greatest(-_move, 0D))"
        up, down = (fall, rise) if self.order == "newest_first" else (rise, fall)
        for n in self.windows:
            gain, loss = self._moves(n, "_gain", up), self._moves(n, "_loss", down)
            # The averages divide both sums by n, which leaves their ratio as it is.
            strength = f"100 - 100 / (1 + {gain} / {loss})"
            self.out[f"rsi_{n}"] = f"CASE WHEN {loss} = 0 THEN 100D ELSE {strength} END"
        return self

    def _moves(self, n: int, name: str, total: str) -> str:
        """Sum over the moves between the newest n bars in range."""
        if n < 2:
            return "0D"
        fewer = self._in_range(name, total, "1 PRECEDING")
        newest = self._newest(n, name, total, "1 PRECEDING")
        return f"coalesce(CASE WHEN _bars >= {n} THEN {newest} ELSE {fewer} END, 0D)"

    def bollinger(self) -> _Lookback:
        for n in self.windows:
            mean = self._newest(n, "_mean", "avg(avg_price)")
            spread = f"2 * {self._newest(n, '_dev', 'stddev_samp(avg_price)')}"
            bands = {
                "upper": f"{mean} + {spread}",
                "lower": f"{mean} - {spread}",
                "width": f"({mean} + {spread}) - ({mean} - {spread})",
            }
            self.out |= {f"bb_{b}_{n}": f"CASE WHEN _bars >= {n} THEN {v} END" for b, v in bands.items()}
        return self

    def obv(self) -> _Lookback:
        if self.order == "newest_first":
            # The running sum starts at the newest bar, which has no newer bar to differ from.
            self.out["obv"] = "0D"
        else:
            self.out["obv"] = f"coalesce({self._in_range('_flows', 'sum(_flow)', '1 PRECEDING')}, 0D)"
        return self

    def apply(self, bars: DataFrame) -> DataFrame:
        """Bars with the indicators and the day number ``_day``."""
        by_day = "OVER (PARTITION BY symbol ORDER BY _day"
        move = f"lead(avg_price) {by_day}) - avg_price"
        prepared = bars.selectExpr("*", "unix_date(date) AS _day").selectExpr(
            "*",
            f"coalesce({move}, 0D) AS _move",
            f"coalesce(sign({move}) * lead(volume) {by_day}), 0D) AS _flow",
            f"count(*) {by_day} RANGE BETWEEN {self.days} PRECEDING AND CURRENT ROW) AS _bars",
        )
        framed = prepared.selectExpr("*", *[f"{value} AS {name}" for name, value in self.frames.items()])
        indicators = [f"{value} AS {name}" for name, value in self.out.items()]
        return framed.selectExpr(*bars.columns, "_day", *indicators)


def _smoothed(
    prepared: DataFrame, windows: Sequence[int], max_gap_days: int, with_state: bool, with_macd: bool
) -> DataFrame:
    def previous(column: str) -> str | None:
        return f"prev_{column}" if with_state else None

    averages = [
        Smoothing(f"ema_{n}", "avg_price", f"ma_{n}", _weight(n), previous(f"ema_{n}")) for n in windows
    ]
    done = smooth(mark_segments(prepared, max_gap_days), averages)
    if with_macd:
        done = done.selectExpr("*", "ema_12 - ema_26 AS macd")
        signal = Smoothing("signal", "macd", "macd", _weight(SIGNAL_WINDOW), previous("signal"))
        done = smooth(done, [signal]).selectExpr("*", "macd - signal AS macd_hist")
    return done.drop(*MARKS)


def sma(bars: DataFrame, windows: Sequence[int] = WINDOWS, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Mean of the newest n prices in range, or of all of them if there are fewer."""
    return _Lookback(windows, lookback_days).sma().apply(bars).drop("_day")


def rsi(
    bars: DataFrame,
    windows: Sequence[int] = WINDOWS,
    order: str = "newest_first",
    lookback_days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """Relative strength from plain sums of gains and losses; 100 where there is no loss."""
    return _Lookback(windows, lookback_days, order).rsi().apply(bars).drop("_day")


def bollinger(
    bars: DataFrame, windows: Sequence[int] = WINDOWS, lookback_days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Mean plus and minus two sample deviations; NULL with fewer than n prices in range."""
    return _Lookback(windows, lookback_days).bollinger().apply(bars).drop("_day")


def obv(bars: DataFrame, order: str = "newest_first", lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Signed volume summed over the range."""
    return _Lookback((), lookback_days, order).obv().apply(bars).drop("_day")


def ema(
    bars: DataFrame,
    windows: Sequence[int] = WINDOWS,
    max_gap_days: int = MAX_GAP_DAYS,
    lookback_days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """Exponential mean, started from the simple mean after more than ``max_gap_days`` of silence."""
    averaged = _Lookback(windows, lookback_days).sma().apply(bars)
    return _smoothed(averaged, windows, max_gap_days, with_state=False, with_macd=False).drop("_day")


def macd(bars: DataFrame, max_gap_days: int = MAX_GAP_DAYS, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Difference of the 12 and 26 bar exponential means, its signal line and their distance."""
    averaged = _Lookback((26, 12), lookback_days).sma().apply(bars)
    return _smoothed(averaged, (26, 12), max_gap_days, with_state=False, with_macd=True).drop("_day")


def _all_indicators(
    bars: DataFrame, windows: Sequence[int], order: str, lookback_days: int
) -> DataFrame:
    if not {12, 26} <= set(windows):
        raise ValueError("MACD needs the windows 12 and 26")
    return _Lookback(windows, lookback_days, order).sma().rsi().bollinger().obv().apply(bars)


def output_columns(windows: Sequence[int]) -> list[str]:
    """Columns of the indicator table; with the usual windows those of its declared schema."""
    if set(windows) == set(WINDOWS):
        return DAILY_INDICATORS.names
    rising = sorted(windows)
    grouped = [f"{kind}_{n}" for kind in ("ma", "ema", "rsi") for n in rising]
    bands = [f"bb_{edge}_{n}" for n in rising for edge in ("upper", "lower", "width")]
    return [*DAILY_BARS.names, *grouped, *bands, "macd", "signal", "macd_hist", "obv"]


def daily_indicators(
    bars: DataFrame,
    windows: Sequence[int] = WINDOWS,
    order: str = "newest_first",
    max_gap_days: int = MAX_GAP_DAYS,
    lookback_days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """Every indicator for every bar: one shuffle on symbol, then windows only."""
    looked_back = _all_indicators(bars, windows, order, lookback_days)
    done = _smoothed(looked_back, windows, max_gap_days, with_state=False, with_macd=True)
    return done.select(*output_columns(windows))


def indicators_from(
    bars: DataFrame,
    state: DataFrame,
    windows: Sequence[int] = WINDOWS,
    order: str = "newest_first",
    max_gap_days: int = MAX_GAP_DAYS,
    lookback_days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """Indicators from each symbol's ``_from`` date on, continued from stored state.

    ``bars`` carries ``_from`` and reaches ``lookback_days`` behind it; ``state`` has one row per
    symbol with ``prev_`` columns, or none for a symbol that starts here.
    """
    looked_back = _all_indicators(bars, windows, order, lookback_days).filter(F.col("date") >= F.col("_from"))
    carried = [f"prev_ema_{n}" for n in windows] + ["prev_signal"]
    joined = join_prev_state(looked_back, state.select("symbol", *carried))
    # The state belongs to the first row alone; later starts follow a gap and know none.
    first = F.col("date") == F.col("_from")
    with_state = joined.withColumns({c: F.when(first, F.col(c)) for c in carried})
    return _smoothed(with_state, windows, max_gap_days, with_state=True, with_macd=True).select(
        *output_columns(windows)
    )
