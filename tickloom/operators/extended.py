"""ATR, directional movement, stochastic, CCI, volume average and money flow.

Simple averages throughout, like the core indicators.
"""

from tickloom.operators.rolling import Family, Series

# Window sizes in rows, and the customary CCI scale.
TREND_SIZE = 14
STOCHASTIC_SIZE, STOCHASTIC_SMOOTH = 14, 3
CCI_SIZE, CCI_SCALE = 20, "0.015D"
VOLUME_SIZE = 20
MONEY_FLOW_SIZE = 14

# Deviations up to here are rounding noise of equal prices.
NO_DEVIATION = "1e-12D"

TYPICAL = "((high + low + close) / 3)"


def trend(series: Series) -> Family:
    """``atr``, ``plus_di``, ``minus_di`` and ``adx``."""
    near = series.last(TREND_SIZE)
    return [
        {"_last_close": series.lag("close"),
         "_rise": f"high - {series.lag('high')}",
         "_fall": f"{series.lag('low')} - low"},
        # The first row has no last close; greatest() then leaves high - low.
        {"_range": "greatest(high - low, abs(high - _last_close), abs(low - _last_close))",
         "_plus": "CASE WHEN _rise > _fall AND _rise > 0 THEN _rise ELSE 0D END",
         "_minus": "CASE WHEN _fall > _rise AND _fall > 0 THEN _fall ELSE 0D END"},
        {"atr": f"avg(_range) {near}",
         "_ranges": f"sum(_range) {near}",
         "_pluses": f"sum(_plus) {near}",
         "_minuses": f"sum(_minus) {near}"},
        {"plus_di": "CASE WHEN _ranges <> 0 THEN 100 * _pluses / _ranges END",
         "minus_di": "CASE WHEN _ranges <> 0 THEN 100 * _minuses / _ranges END",
         # Both indicators share their denominator, which cancels out.
         "_dx": """CASE WHEN _ranges <> 0 AND _pluses + _minuses <> 0
                   THEN 100 * abs(_pluses - _minuses) / (_pluses + _minuses) END"""},
        {"adx": f"avg(_dx) {near}"},
    ]


def stochastic(series: Series) -> Family:
    near = series.last(STOCHASTIC_SIZE)
    return [
        {"_lowest": f"min(low) {near}", "_highest": f"max(high) {near}"},
        {"stoch_k": "CASE WHEN _highest <> _lowest THEN 100 * (close - _lowest) / (_highest - _lowest) END"},
        {"stoch_d": f"avg(stoch_k) {series.last(STOCHASTIC_SMOOTH)}"},
    ]


def channel(series: Series) -> Family:
    """``cci``: distance from the mean typical price in mean deviations."""
    near = series.last(CCI_SIZE)
    # The deviation is taken around each row's own mean, so it needs the values.
    deviations = "transform(_typicals, price -> abs(price - _mean_typical))"
    return [
        {"_typicals": f"collect_list({TYPICAL}) {near}", "_mean_typical": f"avg({TYPICAL}) {near}"},
        # No values only where every price is NULL.
        {"_deviation": f"""CASE WHEN size(_typicals) > 0 THEN
             aggregate({deviations}, 0D, (total, x) -> total + x) / size(_typicals) END"""},
        {},
        {"cci": f"""CASE WHEN _deviation > {NO_DEVIATION}
             THEN ({TYPICAL} - _mean_typical) / ({CCI_SCALE} * _deviation) END"""},
    ]


def money_flow(series: Series) -> Family:
    """``volume_ma20`` and ``mfi``."""
    near = series.last(MONEY_FLOW_SIZE)
    return [
        {"volume_ma20": f"avg(volume) {series.last(VOLUME_SIZE)}",
         "_typical_before": series.lag(TYPICAL)},
        {"_in": f"CASE WHEN {TYPICAL} > _typical_before THEN {TYPICAL} * volume ELSE 0D END",
         "_out": f"CASE WHEN {TYPICAL} < _typical_before THEN {TYPICAL} * volume ELSE 0D END"},
        {"_inflow": f"sum(_in) {near}", "_outflow": f"sum(_out) {near}"},
        {"mfi": "CASE WHEN _outflow = 0 THEN 100D ELSE 100 - 100 / (1 + _inflow / _outflow) END"},
    ]


def extended_families(series: Series) -> list[Family]:
    return [trend(series), stochastic(series), channel(series), money_flow(series)]
