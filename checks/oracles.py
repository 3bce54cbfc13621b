"""The same queries as DuckDB SQL, written from the definitions and not from the Spark code."""

from checks.queries import (
    ASOF, COMPRESSION, DEFINITION_ROWS, JUMP_SPANS, MEMBER_ROWS, MOMENTUM, NORMALISED, REGIME, RUN_TS, SHOWN_TABLES, SPEC, TREND, VOLUME,
)
from tickloom.schemas import BAR_COLUMNS, INDICATOR_FIELDS, SIGNAL_METRICS

P = "PARTITION BY Symbol ORDER BY PriceTimestamp"
AT = f"TIMESTAMP '{ASOF:%Y-%m-%d %H:%M:%S}'"
RUN_AT = f"TIMESTAMP '{RUN_TS:%Y-%m-%d %H:%M:%S}'"
KEYS = "Symbol, PriceTimestamp"


def roll(fn: str, x: str, n: int, p: str = P) -> str:
    over = f"OVER ({p} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"(CASE WHEN count({x}) {over} = {n} THEN {fn}({x}) {over} END)"


def lag(x: str, n: int = 1) -> str:
    return f"lag({x}, {n}) OVER ({P})"


def nz(x: str) -> str:
    return f"nullif({x}, 0)"


def r6(columns: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def bars(unit: str = "hour") -> str:
    return f"""bars AS (
  SELECT event_type AS Symbol, CAST(date_trunc('{unit}', ts) AS TIMESTAMP) AS PriceTimestamp,
         arg_min(value, (ts, event_id)) AS OpenPrice, max(value) AS HighPrice, min(value) AS LowPrice,
         arg_max(value, (ts, event_id)) AS ClosePrice,
         CAST(sum(CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)) AS BIGINT) AS Volume
  FROM events GROUP BY 1, 2)"""


DAILY = """bars AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS Symbol, l_shipdate AS PriceTimestamp,
         arg_min(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_partkey)) AS OpenPrice,
         max(l_extendedprice / l_quantity) AS HighPrice, min(l_extendedprice / l_quantity) AS LowPrice,
         arg_max(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_partkey)) AS ClosePrice,
         CAST(sum(l_quantity) AS BIGINT) AS Volume
  FROM lineitem WHERE l_quantity > 0 GROUP BY 1, 2)"""

# Bars with row number, previous values and pointwise terms.
STEP = f"""step AS (
  SELECT *, row_number() OVER ({P}) AS rn, {lag('ClosePrice')} AS pc, {lag('HighPrice')} AS ph, {lag('LowPrice')} AS pl
  FROM bars),
term AS (
  SELECT *, greatest(HighPrice - LowPrice, abs(HighPrice - pc), abs(LowPrice - pc)) AS tr,
         (HighPrice + LowPrice + ClosePrice) / 3 AS tp,
         CASE WHEN pc IS NOT NULL THEN greatest(ClosePrice - pc, 0) END AS gain,
         CASE WHEN pc IS NOT NULL THEN greatest(pc - ClosePrice, 0) END AS loss,
         CASE WHEN HighPrice - ph > pl - LowPrice AND HighPrice - ph > 0 THEN HighPrice - ph ELSE 0 END AS pdm
  FROM step),
dm AS (
  SELECT *, CASE WHEN pl - LowPrice > pdm AND pl - LowPrice > 0 THEN pl - LowPrice ELSE 0 END AS mdm FROM term)"""

SPANS = {"e2": 2, "e9": 9, "e12": 12, "e20": 20, "e26": 26, "e50": 50, "e200": 200}
RANGES = {"a10": 10, "a14": 14}


def _ewm() -> str:
    first = ", ".join([f"ClosePrice AS {k}" for k in SPANS] + [f"tr AS {k}" for k in RANGES])
    after = ", ".join(
        [f"w.{k} + (2.0::DOUBLE / ({n} + 1)) * (d.ClosePrice - w.{k})" for k, n in SPANS.items()]
        + [f"w.{k} + (1.0::DOUBLE / {n}) * (d.tr - w.{k})" for k, n in RANGES.items()]
    )
    return f"""ewm AS (
  SELECT Symbol, rn, {first} FROM dm WHERE rn = 1
  UNION ALL
  SELECT d.Symbol, d.rn, {after} FROM ewm w JOIN dm d ON d.Symbol = w.Symbol AND d.rn = w.rn + 1)"""


EWM = _ewm()

TREND_FOLD = """base AS (
  SELECT d.Symbol, d.rn, d.ClosePrice AS c, d.pc, (d.HighPrice + d.LowPrice) / 2 + 3 * w.a10 AS bu,
         (d.HighPrice + d.LowPrice) / 2 - 3 * w.a10 AS bl
  FROM dm d JOIN ewm w USING (Symbol, rn)),
fold AS (
  SELECT Symbol, rn, bu AS fu, bl AS fl, 1 AS trend FROM base WHERE rn = 1
  UNION ALL
  SELECT Symbol, rn, fu, fl, CASE WHEN c > fu THEN 1 WHEN c < fl THEN -1 ELSE trend END
  FROM (SELECT b.Symbol, b.rn, b.c, f.trend,
               CASE WHEN b.bu < f.fu OR b.pc > f.fu THEN b.bu ELSE f.fu END AS fu,
               CASE WHEN b.bl > f.fl OR b.pc < f.fl THEN b.bl ELSE f.fl END AS fl
        FROM fold f JOIN base b ON b.Symbol = f.Symbol AND b.rn = f.rn + 1)),
st AS (SELECT Symbol, rn, CASE WHEN trend = 1 THEN fl ELSE fu END AS SUPERTREND_10 FROM fold)"""

ROLLED = f"""rolled AS (
  SELECT *, {roll('avg', 'ClosePrice', 20)} AS mid, {roll('stddev_samp', 'ClosePrice', 20)} AS sd,
         {roll('avg', 'ClosePrice', 200)} AS s200,
         {roll('avg', 'gain', 14)} AS g, {roll('avg', 'loss', 14)} AS l,
         {roll('sum', 'tr', 14)} AS tr14, {roll('sum', 'pdm', 14)} AS p14, {roll('sum', 'mdm', 14)} AS m14,
         {roll('avg', 'tp', 20)} AS tp20, {roll('max', 'HighPrice', 14)} AS hh, {roll('min', 'LowPrice', 14)} AS ll
  FROM dm),
derived AS (
  SELECT *, 100 * (ClosePrice - ll) / {nz('hh - ll')} AS k, abs(tp - tp20) AS off,
         100 * abs(100 * (p14 / {nz('tr14')}) - 100 * (m14 / {nz('tr14')}))
             / {nz(f"100 * (p14 / {nz('tr14')}) + 100 * (m14 / {nz('tr14')})")} AS dx
  FROM rolled),
ind AS (
  SELECT Symbol, PriceTimestamp, OpenPrice, HighPrice, LowPrice, ClosePrice, Volume, rn,
         mid AS SMA_20, s200 AS SMA_200, 100 - 100 / (1 + g / {nz('l')}) AS RSI_14,
         {roll('avg', 'dx', 14)} AS ADX_14, (tp - tp20) / (0.015 * {nz(roll('avg', 'off', 20))}) AS CCI_20,
         mid + 2 * sd AS BBANDS_UPPER_20, mid AS BBANDS_MIDDLE_20, mid - 2 * sd AS BBANDS_LOWER_20,
         k AS STOCH_K_14, {roll('avg', 'k', 3)} AS STOCH_D_14,
         ((mid + 2 * sd) - (mid - 2 * sd)) / {nz('mid')} AS BOLL_WIDTH_20,
         (ClosePrice - (mid - 2 * sd)) / {nz('(mid + 2 * sd) - (mid - 2 * sd)')} AS BOLL_PCTB_20,
         -100 * (hh - ClosePrice) / {nz('hh - ll')} AS WILLIAMS_R_14,
         100 * (ClosePrice / {nz(lag('ClosePrice', 12))} - 1) AS ROC_12,
         100 * (ClosePrice / {nz(lag('ClosePrice', 1))} - 1) AS ROC_1,
         CAST(sum(coalesce(sign(ClosePrice - pc), 0) * Volume) OVER ({P} ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS OBV_0,
         sum(tp * Volume) OVER ({P} ROWS UNBOUNDED PRECEDING)
             / {nz(f'sum(Volume) OVER ({P} ROWS UNBOUNDED PRECEDING)')} AS VWAP_0
  FROM derived)"""


def framed(columns: list[str], unit: str = "hour", source: str | None = None) -> str:
    return f"WITH {source or bars(unit)}, {STEP}, {ROLLED} SELECT {KEYS}, {r6(columns)} FROM ind"


def weighted(select: str, unit: str = "minute") -> str:
    return f"WITH RECURSIVE {bars(unit)}, {STEP}, {EWM} SELECT d.Symbol, d.PriceTimestamp, {select} FROM dm d JOIN ewm w USING (Symbol, rn)"


def replaced(close: str) -> str:
    """Minute bars with another close."""
    return bars("minute").replace("bars AS (", "given AS (", 1) + f", bars AS (SELECT * REPLACE ({close} AS ClosePrice) FROM given)"


def gapped(means: dict[str, tuple[str, float]], select: str, close: str) -> str:
    """Means row by row: a missing value repeats the mean, the next one weighs more for every missing row."""
    first = ", ".join(f"{x} AS {k}, 0 AS {k}_gap" for k, (x, _) in means.items())
    after = ", ".join(
        f"CASE WHEN d.{x} IS NULL THEN w.{k} WHEN w.{k} IS NULL THEN d.{x} "
        f"ELSE (pow({1 - a!r}::DOUBLE, w.{k}_gap + 1) * w.{k} + {a!r}::DOUBLE * d.{x}) / (pow({1 - a!r}::DOUBLE, w.{k}_gap + 1) + {a!r}::DOUBLE) END, "
        f"CASE WHEN d.{x} IS NULL THEN w.{k}_gap + 1 ELSE 0 END"
        for k, (x, a) in means.items()
    )
    return f"""WITH RECURSIVE {replaced(close)}, {STEP}, ewm AS (
  SELECT Symbol, rn, {first} FROM dm WHERE rn = 1
  UNION ALL
  SELECT d.Symbol, d.rn, {after} FROM ewm w JOIN dm d ON d.Symbol = w.Symbol AND d.rn = w.rn + 1)
SELECT d.Symbol, d.PriceTimestamp, {select} FROM dm d JOIN ewm w USING (Symbol, rn)"""


GAP_MEANS = {f"e{n}": ("ClosePrice", 2 / (n + 1)) for n in (2, 9, 12, 26, 200)} | {"a14": ("tr", 1 / 14)}
JUMP_MEANS = {f"e{n}": ("ClosePrice", 2 / (n + 1)) for n in JUMP_SPANS}

# Every active indicator beside its bar.
WIDE = f"""{bars()}, {STEP}, {EWM}, {TREND_FOLD}, {ROLLED},
wide AS (
  SELECT i.*, w.e9 AS EMA_9, w.e20 AS EMA_20, w.e50 AS EMA_50, w.e200 AS EMA_200, w.a14 AS ATR_14, s.SUPERTREND_10
  FROM ind i JOIN ewm w USING (Symbol, rn) JOIN st s USING (Symbol, rn))"""


def _definitions(active_only: bool = True) -> str:
    rows = [r for r in DEFINITION_ROWS if r[3] or not active_only]
    return "(VALUES " + ", ".join(f"({i}, '{n}', '{p}', '{n}_{p}')" for i, n, p, _ in rows) + ") AS t(id, name, param, field)"


LONG = f"""long AS (
  SELECT u.Symbol, u.PriceTimestamp, t.id, t.name, t.param, t.field, u.v
  FROM (UNPIVOT (SELECT {KEYS}, {', '.join(INDICATOR_FIELDS)} FROM wide) ON {', '.join(INDICATOR_FIELDS)} INTO NAME field VALUE v) u
  JOIN {_definitions()} ON t.field = u.field)"""

SESSION = "extract(hour FROM PriceTimestamp) BETWEEN 9 AND 16"


def _present(columns: list[str], test: str) -> str:
    return "CAST(" + " + ".join(f"CASE WHEN {c} IS {test} THEN 1 ELSE 0 END" for c in columns) + " AS INTEGER)"


CALENDAR = f"CAST(isodow(PriceTimestamp) AS INTEGER) AS DayOfWeek, {SESSION} AS IsRegularSession, NOT ({SESSION}) AS IsAfterHours"
COUNTS = (
    f"{_present(INDICATOR_FIELDS, 'NOT NULL')} AS SourceIndicatorCount, "
    f"{_present(INDICATOR_FIELDS, 'NULL')} AS MissingIndicatorCount"
)
BAR_LIST = "OpenPrice, HighPrice, LowPrice, ClosePrice, Volume"
MERGED = (
    f"SELECT {KEYS}, {BAR_LIST}, {', '.join(INDICATOR_FIELDS)}, {CALENDAR}, {RUN_AT} AS RunTimestamp, "
    f"'MERGE_20240131_000000' AS MergeRunId, {COUNTS} FROM wide"
)

NORM = f"""norm AS (
  SELECT *, (ClosePrice - {lag('ClosePrice')}) / {nz('ATR_14')} AS Return_t_norm,
         (ClosePrice - OpenPrice) / {nz('ATR_14')} AS CandleBody_norm, (HighPrice - LowPrice) / {nz('ATR_14')} AS Range_norm,
         (HighPrice - greatest(OpenPrice, ClosePrice)) / {nz('ATR_14')} AS UpperWick_norm,
         (least(OpenPrice, ClosePrice) - LowPrice) / {nz('ATR_14')} AS LowerWick_norm,
         coalesce(ClosePrice / {nz(lag('ClosePrice'))} - 1, 0) AS ret,
         row_number() OVER ({P}) AS pos
  FROM wide)"""
# The rank is a correlated count over the row range, independent of how Spark collects the frame.
RANKED = """ranks AS (
  SELECT a.Symbol, a.pos, (count(*) FILTER (b.Volume < a.Volume) + (count(*) FILTER (b.Volume = a.Volume) + 1) / 2.0::DOUBLE) / 100 AS Volume_percentile
  FROM norm a JOIN norm b ON b.Symbol = a.Symbol AND b.pos BETWEEN a.pos - 99 AND a.pos
  WHERE a.pos >= 100 GROUP BY a.Symbol, a.pos)"""
HOUR = "CAST(extract(hour FROM PriceTimestamp) AS INTEGER)"
ENGINEERED = f"""engineered AS (
  SELECT n.*, EMA_20 - EMA_200 AS EMA20_minus_EMA200, EMA_9 - EMA_20 AS EMA9_minus_EMA20, SMA_20 - SMA_200 AS SMA20_minus_SMA200,
         ClosePrice - EMA_20 AS Close_minus_EMA20, ClosePrice - EMA_200 AS Close_minus_EMA200,
         ATR_14 / {nz(roll('avg', 'ATR_14', 100))} AS Volatility_regime,
         CASE WHEN EMA_20 > EMA_200 THEN 1 ELSE 0 END AS Trend_regime,
         {HOUR} AS HourOfDay, CAST(extract(minute FROM PriceTimestamp) AS INTEGER) AS MinuteOfHour,
         CASE WHEN {HOUR} < 9 OR {HOUR} >= 16 THEN 0 WHEN {HOUR} = 9 THEN 1 WHEN {HOUR} <= 14 THEN 2 ELSE 3 END AS SessionType,
         BBANDS_UPPER_20 - BBANDS_LOWER_20 AS BBWidth, (BBANDS_UPPER_20 - BBANDS_LOWER_20) / {nz('ATR_14')} AS BBWidth_norm,
         Range_norm AS Range_vs_ATR, Range_norm / {nz(roll('avg', 'Range_norm', 50))} AS RollingRangeCompression,
         (ret - {roll('avg', 'ret', 50)}) / ({roll('stddev_samp', 'ret', 50)} + 1e-9) AS Return_zscore,
         {roll('avg', 'WILLIAMS_R_14', 5)} AS WilliamsR_smoothed,
         Volume / {nz(roll('avg', 'Volume', 20))} AS Volume_rel,
         CASE WHEN Volume / {nz(roll('avg', 'Volume', 20))} > 2 THEN 1 ELSE 0 END AS Volume_spike,
         k.Volume_percentile
  FROM norm n LEFT JOIN ranks k USING (Symbol, pos))"""
INTEGERS = {"Trend_regime", "HourOfDay", "MinuteOfHour", "SessionType", "Volume_spike"}


def rounded(columns: list[str]) -> str:
    return ", ".join(c if c in INTEGERS else f"round({c}, 6) AS {c}" for c in columns)


def features(columns: list[str]) -> str:
    return f"WITH RECURSIVE {WIDE}, {NORM}, {RANKED}, {ENGINEERED} SELECT {KEYS}, {rounded(columns)} FROM engineered"


def change(n: int) -> str:
    return f"ClosePrice / {nz(lag('ClosePrice', n))} - 1"


def metrics(source: str) -> str:
    return f"""ret AS (SELECT *, {change(1)} AS Return_1 FROM {source}),
metric AS (
  SELECT *, {change(5)} AS Return_5, {change(20)} AS Return_20, {roll('stddev_samp', 'Return_1', 20)} AS Volatility_20,
         {change(10)} AS Momentum_10, (HighPrice - LowPrice) / {nz('ClosePrice')} AS Range_Pct,
         (ClosePrice - OpenPrice) / {nz('ClosePrice')} AS Body_Pct,
         lead(ClosePrice) OVER ({P}) / {nz('ClosePrice')} - 1 AS Target
  FROM ret)"""


COUNTED = ["OpenPrice", "HighPrice", "LowPrice", "ClosePrice", "Volume", *INDICATOR_FIELDS, *SIGNAL_METRICS, "Target"]

LABELLED = f"""labelled AS (
  SELECT b.Symbol, b.PriceTimestamp, b.OpenPrice, b.HighPrice, b.LowPrice, b.ClosePrice AS Close_t, b.Volume,
         f.ClosePrice AS FutureClose_tN,
         CASE WHEN b.ClosePrice <> 0 THEN f.ClosePrice / b.ClosePrice - 1 END AS Return_t_to_tN
  FROM bars b LEFT JOIN bars f ON f.Symbol = b.Symbol AND f.PriceTimestamp = b.PriceTimestamp + INTERVAL {SPEC.horizon} MINUTE)"""
LABEL = "CASE WHEN Return_t_to_tN > 0 THEN 1 WHEN Return_t_to_tN < 0 THEN -1 ELSE 0 END"
TRAINABLE = "CASE WHEN Return_t_to_tN IS NOT NULL THEN 1 ELSE 0 END"
SCORED = f"""{LABELLED}, {metrics('bars')},
scored AS (
  SELECT l.Symbol, l.PriceTimestamp, {LABEL} AS Label,
         CASE WHEN m.Return_1 > 0 THEN 1 WHEN m.Return_1 < 0 THEN -1 ELSE 0 END AS Prediction
  FROM labelled l JOIN metric m USING (Symbol, PriceTimestamp))"""

STAGING = """staging AS (
  SELECT event_type AS Symbol, ts AS PriceTimestamp, value AS OpenPrice, value AS HighPrice, value AS LowPrice,
         value AS ClosePrice, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS Volume,
         'B' || CAST(event_id % 7 AS VARCHAR) AS BatchID, ts AS LoadTimestamp,
         CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END AS Exported, event_id AS RowId
  FROM events)"""
MINUTE = "CAST(date_trunc('minute', PriceTimestamp) AS TIMESTAMP)"
RAW_LIST = "OpenPrice, HighPrice, LowPrice, ClosePrice, Volume, BatchID, LoadTimestamp"
NEWEST = "LoadTimestamp DESC, BatchID DESC, PriceTimestamp DESC, OpenPrice DESC, HighPrice DESC, LowPrice DESC, ClosePrice DESC, Volume DESC"


def newest(name: str, source: str, where: str = "true") -> str:
    return f"""{name} AS (
  SELECT Symbol, m AS PriceTimestamp, {RAW_LIST}
  FROM (SELECT *, {MINUTE} AS m, row_number() OVER (PARTITION BY Symbol, {MINUTE} ORDER BY {NEWEST}) AS k
        FROM {source} WHERE {where}) WHERE k = 1)"""


RAW = newest("raw", "staging", "Exported = 1")
PENDING = "Exported = 0"
OPEN_HOURS = "extract(hour FROM PriceTimestamp) BETWEEN 9 AND 16"
MARKET = f"{STAGING}, market AS (SELECT * FROM staging WHERE {OPEN_HOURS}), {RAW}, {newest('fresh', 'market', PENDING)}, inserted AS (SELECT f.* FROM fresh f ANTI JOIN raw r USING (Symbol, PriceTimestamp))"

VENDOR = """vendor AS (
  SELECT Symbol, PriceTimestamp, OpenPrice, OpenPrice AS HighPrice, OpenPrice AS LowPrice, OpenPrice AS ClosePrice, Volume
  FROM (SELECT event_type AS Symbol, CAST(date_trunc('minute', ts - INTERVAL 5 HOUR) AS TIMESTAMP) AS PriceTimestamp, value AS OpenPrice,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS Volume,
               row_number() OVER (PARTITION BY event_type, date_trunc('minute', ts) ORDER BY ts DESC, value DESC,
                                  CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) DESC) AS k
        FROM events) WHERE k = 1)"""


def cutoffs(where: str = "true") -> str:
    return f"cutoff AS (SELECT Symbol, max(PriceTimestamp) AS LastTs FROM staging WHERE Exported = 1 AND PriceTimestamp < {AT} AND {where} GROUP BY Symbol)"


DAY = "CAST(PriceTimestamp AS DATE)"
NUMBER = "regexp_extract(props, '([0-9]+)', 1)"
LINES = f"""texts AS (
  SELECT event_type AS run, event_id AS line_no, ts, event_id % 13 AS kind, printf('%.2f', value) AS v, {NUMBER} AS n,
         'U' || CAST(user_id % 7 AS VARCHAR) AS u, ['SMA', 'EMA', 'RSI', 'ADX', 'OBV'][user_id % 5 + 1] AS ind
  FROM events),
lines AS (
  SELECT run, line_no, kind, strftime(ts, '%Y-%m-%d %H:%M:%S') || ' [INFO] ' || CASE kind
    WHEN 0 THEN '=== Processing ' || u || ' (Backfill=7 days) ===' WHEN 1 THEN u || ': Ingestion completed in ' || v || ' seconds.'
    WHEN 2 THEN 'Completed indicator ' || ind || ' with ' || n || ' rows in ' || v || ' seconds.'
    WHEN 3 THEN 'Total rows inserted:     ' || n WHEN 4 THEN 'Inserted ' || n || ' new rows into tblRawPrices.'
    WHEN 5 THEN '=== MERGE COMPLETED in ' || v || ' seconds ===' WHEN 6 THEN 'Merged dataset: 1,' || lpad(n, 3, '0') || ' rows, 56 columns.'
    WHEN 7 THEN '=== MASTER ORCHESTRATOR STARTED ===' WHEN 8 THEN 'Completed: merge_feature.py'
    WHEN 9 THEN 'Loaded 31,' || lpad(n, 3, '0') || ' price rows.' WHEN 10 THEN 'Total rows in RawPrices after merge: ' || n
    WHEN 11 THEN 'Total computed indicator rows: ' || n ELSE 'Insert step completed in ' || v || ' seconds.' END AS value
  FROM texts)"""
FLOAT = r"CAST(list_last(regexp_extract_all(value, '\d+\.\d+')) AS DOUBLE)"
WHOLE = r"CAST(list_last(regexp_extract_all(value, '\d+')) AS BIGINT)"


def at(expr: str, phrase: str, default: str | None = None) -> str:
    found = f"arg_max({expr}, line_no) FILTER (contains(value, '{phrase}'))"
    return f"coalesce({found}, {default})" if default else found


def count_by(select: str, group: str, having: str = "") -> str:
    return f"SELECT {select}, count(*) AS SignalRowCount FROM bars GROUP BY {group} {having}"


def table_row(name: str, source: str, ts: str = "PriceTimestamp") -> str:
    before = f"count(*) FILTER ({ts} < {AT})"
    return f"SELECT '{name}' AS TableName, count(*) AS TotalRows, {before} AS RowsBeforeToday, count(*) - {before} AS Increment FROM {source}"




def check(name: str, ok: str, details: str, source: str) -> str:
    return f"SELECT '{name}' AS \"check\", {ok} AS ok, {details} AS details FROM {source}"


BAD = "count(*) FILTER (OpenPrice <= 0) + count(*) FILTER (HighPrice <= 0) + count(*) FILTER (LowPrice <= 0) + count(*) FILTER (ClosePrice <= 0) + count(*) FILTER (Volume < 0)"
NULLS = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in BAR_COLUMNS)
DUPES = f"(SELECT {KEYS} FROM bars GROUP BY {KEYS} HAVING count(*) > 1)"

REPORT = f"""{SCORED},
per AS (
  SELECT c AS label, count(*) FILTER (Label = c AND Prediction = c) AS hit, count(*) FILTER (Label = c) AS support,
         count(*) FILTER (Prediction = c) AS guess
  FROM scored, (VALUES (-1), (0), (1)) AS t(c) GROUP BY c),
score AS (
  SELECT label, hit, coalesce(hit / nullif(guess, 0), 0) AS precision, coalesce(hit / nullif(support, 0), 0) AS recall, support,
         coalesce(2 * hit / nullif(guess + support, 0), 0) AS f1
  FROM per WHERE support > 0 OR guess > 0)"""

TS_ORDER = "ORDER BY PriceTimestamp, Symbol"


def split(order: str) -> str:
    return f"""WITH {bars()}, {LABELLED}, placed AS (
  SELECT Symbol, PriceTimestamp, {LABEL} AS Label, CAST(row_number() OVER (ORDER BY {order}) - 1 AS BIGINT) AS position,
         count(*) OVER () AS n FROM labelled)
SELECT {KEYS}, Label, position, position < CAST(floor(n * 0.8::DOUBLE) AS BIGINT) AS is_train FROM placed"""


ORACLES = {
    "bars_hourly": f"WITH {bars()} SELECT * FROM bars",
    "bars_minute": f"WITH {bars('minute')} SELECT * FROM bars",
    "bars_daily": f"WITH {DAILY} SELECT * FROM bars",
    "flagship": f"WITH {bars()}, {STEP}, {ROLLED} SELECT {KEYS}, ClosePrice, {r6(['SMA_20', 'BBANDS_UPPER_20', 'BBANDS_LOWER_20', 'RSI_14', 'ROC_1'])} FROM ind",
    "ind_sma": framed(["SMA_20", "SMA_200"]),
    "ind_ema": weighted(", ".join(f"round(w.e{n}, 6) AS EMA_{n}" for n in (2, 9, 20, 50, 200))),
    "ind_rsi": framed(["RSI_14"]),
    "ind_atr": weighted("round(w.a14, 6) AS ATR_14"),
    "ind_adx": framed(["ADX_14"]),
    "ind_macd": weighted("round(w.e12 - w.e26, 6) AS MACD_0"),
    "ind_obv": framed(["OBV_0"], "minute"),
    "ind_roc": framed(["ROC_12"]),
    "ind_vwap": framed(["VWAP_0"], "minute"),
    "ind_cci": framed(["CCI_20"]),
    "ind_bbands": framed(["BBANDS_UPPER_20", "BBANDS_MIDDLE_20", "BBANDS_LOWER_20"]),
    "ind_stoch": framed(["STOCH_K_14", "STOCH_D_14"]),
    "ind_boll_width_pctb": framed(["BOLL_WIDTH_20", "BOLL_PCTB_20"]),
    "ind_williams": framed(["WILLIAMS_R_14"]),
    "ind_supertrend": f"WITH RECURSIVE {bars('minute')}, {STEP}, {EWM}, {TREND_FOLD} SELECT d.Symbol, d.PriceTimestamp, round(s.SUPERTREND_10, 6) AS SUPERTREND_10 FROM dm d JOIN st s USING (Symbol, rn)",
    "ind_ema_gaps": gapped(
        GAP_MEANS, "round(e2, 6) AS EMA_2, round(e9, 6) AS EMA_9, round(e200, 6) AS EMA_200, round(e12 - e26, 6) AS MACD_0, round(a14, 6) AS ATR_14",
        "CASE WHEN Volume % 7 <> 3 THEN ClosePrice END",
    ),
    "ind_ema_jump": gapped(JUMP_MEANS, ", ".join(f"round(ln(e{n}), 6) AS LN_EMA_{n}" for n in JUMP_SPANS), "CASE WHEN Volume % 23 = 5 THEN 1e30 ELSE ClosePrice END"),
    "ind_daily": f"WITH RECURSIVE {DAILY}, {STEP}, {EWM}, {ROLLED} SELECT i.Symbol, i.PriceTimestamp, {r6(['SMA_20', 'SMA_200', 'RSI_14', 'WILLIAMS_R_14'])}, round(w.e20, 6) AS EMA_20, round(w.a14, 6) AS ATR_14 FROM ind i JOIN ewm w USING (Symbol, rn)",
    "ind_resumed": f"WITH RECURSIVE {WIDE} SELECT {KEYS}, {r6(INDICATOR_FIELDS)} FROM wide",
    "ind_long_registry": f"WITH RECURSIVE {WIDE}, {LONG} SELECT {KEYS}, '1m' AS Timeframe, id AS IndicatorId, name AS IndicatorName, param AS IndicatorParams, round(v, 6) AS IndicatorValue, field AS FieldName FROM long",
    "ind_pivot_merge": f"WITH RECURSIVE {WIDE}, merged AS ({MERGED}) SELECT * REPLACE ({r6(INDICATOR_FIELDS)}) FROM merged",
    "feat_normalised": features(NORMALISED),
    "feat_trend": features(TREND),
    "feat_regime": features(REGIME),
    "feat_compression": features(COMPRESSION),
    "feat_momentum": features(MOMENTUM),
    "feat_volume": features(VOLUME),
    "feat_all": f"WITH RECURSIVE {WIDE}, {NORM}, {RANKED}, {ENGINEERED} SELECT {KEYS}, {BAR_LIST}, {r6(INDICATOR_FIELDS)}, {CALENDAR}, {RUN_AT} AS RunTimestamp, 'MERGE_20240131_000000' AS MergeRunId, {COUNTS}, {rounded(NORMALISED + TREND + REGIME + COMPRESSION + MOMENTUM + VOLUME)} FROM engineered",
    "sig_features": f"""WITH RECURSIVE {WIDE}, {metrics('wide')} SELECT Symbol, PriceTimestamp AS FeatureTimestamp, {BAR_LIST}, {r6(INDICATOR_FIELDS)},
  CAST(isodow(PriceTimestamp) AS INTEGER) AS DayOfWeek, CASE WHEN {SESSION} THEN 1 ELSE 0 END AS IsRegularSession, CASE WHEN {SESSION} THEN 0 ELSE 1 END AS IsAfterHours,
  {r6(SIGNAL_METRICS)}, round(Target, 6) AS Target, 1 AS SignalVersion, 'SIGNAL_20240131_000000' AS FeatureRunId, {RUN_AT} AS RunDateTime,
  {_present(COUNTED, 'NULL')} AS MissingFeatureCount, {_present(INDICATOR_FIELDS, 'NOT NULL')} AS SourceIndicatorCount FROM metric""",
    "sig_incremental": f"""WITH RECURSIVE {WIDE}, {metrics('wide')}, cutoff AS (SELECT Symbol, max(PriceTimestamp) AS LastTs FROM bars WHERE PriceTimestamp < {AT} GROUP BY Symbol)
SELECT Symbol, PriceTimestamp AS FeatureTimestamp, {r6(SIGNAL_METRICS)}, round(Target, 6) AS Target, {_present(COUNTED, 'NULL')} AS MissingFeatureCount
FROM metric LEFT JOIN cutoff USING (Symbol) WHERE LastTs IS NULL OR PriceTimestamp > LastTs""",
    "sig_incremental_global": f"WITH {bars()} SELECT * FROM bars WHERE PriceTimestamp > (SELECT coalesce(max(PriceTimestamp), TIMESTAMP '1900-01-01') FROM bars WHERE PriceTimestamp < {AT})",
    "sig_reopened": f"""WITH RECURSIVE {WIDE}, {metrics('wide')}, cutoff AS (SELECT Symbol, max(PriceTimestamp) AS LastTs FROM bars WHERE PriceTimestamp < {AT} GROUP BY Symbol)
SELECT Symbol, PriceTimestamp AS FeatureTimestamp, {r6(['Return_20', 'Volatility_20', 'Target'])} FROM metric JOIN cutoff USING (Symbol) WHERE PriceTimestamp = LastTs""",
    "label_horizon": f"""WITH {bars()}, {LABELLED} SELECT {KEYS}, OpenPrice, HighPrice, LowPrice, Close_t, Volume, FutureClose_tN, round(Return_t_to_tN, 6) AS Return_t_to_tN,
  {LABEL} AS Label, {SPEC.horizon} AS HorizonMinutes, '{SPEC.label_type}' AS LabelType, 'v1' AS LabelVersion, 'v1' AS FeatureVersion, {TRAINABLE} AS IsTrainableRow, 0 AS IsOutlier,
  CAST(NULL AS VARCHAR) AS RegimeTag, CAST(NULL AS VARCHAR) AS MarketSession, {RUN_AT} AS LoadTimestamp, 'LABEL_20240131_000000' AS SourceRunID, 'LABEL_20240131_000000' AS RunId FROM labelled""",
    "label_minute": f"WITH {bars('minute')} SELECT b.Symbol, b.PriceTimestamp, b.ClosePrice AS Close_t, f.ClosePrice AS FutureClose_tN FROM bars b LEFT JOIN bars f ON f.Symbol = b.Symbol AND f.PriceTimestamp = b.PriceTimestamp + INTERVAL 5 MINUTE",
    "label_incremental": f"""WITH {bars()}, {LABELLED}, cutoff AS (SELECT Symbol, max(PriceTimestamp) AS LastTs FROM bars WHERE PriceTimestamp < {AT} GROUP BY Symbol)
SELECT {KEYS}, Close_t, FutureClose_tN, round(Return_t_to_tN, 6) AS Return_t_to_tN, {LABEL} AS Label, {TRAINABLE} AS IsTrainableRow FROM labelled LEFT JOIN cutoff USING (Symbol) WHERE LastTs IS NULL OR PriceTimestamp > LastTs""",
    "label_scan": f"WITH {bars()}, {LABELLED} SELECT {LABEL} AS Label, count(*) AS n FROM labelled GROUP BY 1",
    "stage_gate": f"WITH {STAGING} SELECT count(*) AS PendingRows, count(*) FILTER (NOT ({OPEN_HOURS})) AS InvalidRows, CAST(0 AS BIGINT) AS RejectedRows, count(*) FILTER (NOT ({OPEN_HOURS})) = 0 AS MayMerge FROM staging WHERE {PENDING}",
    "stage_pending": f"WITH {STAGING} SELECT Symbol, count(*) AS PendingRows FROM staging WHERE {PENDING} GROUP BY Symbol",
    "stage_dedup": f"WITH {STAGING}, {newest('fresh', 'staging', f'{PENDING} AND {OPEN_HOURS}')} SELECT * FROM fresh",
    "stage_insert_new": f"WITH {STAGING}, {RAW}, {newest('fresh', 'staging', f'{PENDING} AND {OPEN_HOURS}')} SELECT f.* FROM fresh f ANTI JOIN raw r USING (Symbol, PriceTimestamp)",
    "stage_merge_summary": f"""WITH {MARKET}, sizes AS (
  SELECT Symbol, count(*) AS p, 0 AS r, 0 AS i FROM market WHERE {PENDING} GROUP BY Symbol UNION ALL
  SELECT Symbol, 0, count(*), 0 FROM raw GROUP BY Symbol UNION ALL SELECT Symbol, 0, 0, count(*) FROM inserted GROUP BY Symbol)
SELECT Symbol, CAST(sum(p) AS BIGINT) AS PendingRows, CAST(0 AS BIGINT) AS RejectedRows, CAST(sum(r) AS BIGINT) AS RowsBefore, CAST(sum(i) AS BIGINT) AS InsertedRows, CAST(sum(r) + sum(i) AS BIGINT) AS RowsAfter FROM sizes GROUP BY Symbol""",
    "stage_merge_snapshot": f"WITH {MARKET} SELECT * FROM raw UNION ALL SELECT * FROM inserted",
    "stage_exported": f"WITH {MARKET} SELECT BatchID, 1 AS Exported, count(*) AS n FROM market GROUP BY BatchID",
    "stage_recent": f"WITH {STAGING} SELECT Symbol, count(*) AS LoadedRows FROM staging WHERE LoadTimestamp >= {AT} - INTERVAL 1440 MINUTE GROUP BY Symbol",
    "raw_dedup": f"WITH {STAGING}, {newest('kept', 'staging')} SELECT * FROM kept",
    "upsert_features": f"""WITH {bars()}, target AS (SELECT * FROM bars WHERE PriceTimestamp < {AT}),
source AS (SELECT * REPLACE (ClosePrice + 1 AS ClosePrice) FROM bars WHERE PriceTimestamp >= {AT} - INTERVAL 3 DAY)
SELECT {KEYS}, OpenPrice, HighPrice, LowPrice, round(ClosePrice, 6) AS ClosePrice, Volume FROM (SELECT t.* FROM target t ANTI JOIN source s USING (Symbol, PriceTimestamp) UNION ALL SELECT * FROM source)""",
    "ingest_filter": f"WITH {STAGING}, {VENDOR}, {cutoffs()} SELECT v.* FROM vendor v LEFT JOIN cutoff c USING (Symbol) WHERE LastTs IS NULL OR PriceTimestamp > LastTs",
    "ingest_offsets": """SELECT event_id, timezone('America/New_York', timezone('UTC', CASE event_id % 4
  WHEN 1 THEN date_trunc('second', ts) + INTERVAL 180 DAY + INTERVAL 5 HOUR WHEN 2 THEN date_trunc('second', ts) + INTERVAL 180 DAY
  ELSE date_trunc('second', ts) END)) AS exchange_ts FROM events""",
    "stage_rejects": f"""WITH {MARKET}, faulty AS (SELECT * REPLACE (CASE WHEN Volume % 11 <> 3 THEN PriceTimestamp END AS PriceTimestamp,
  CASE WHEN Volume % 11 <> 5 THEN Symbol END AS Symbol, CASE WHEN Volume % 11 <> 7 THEN ClosePrice END AS ClosePrice) FROM market WHERE {PENDING}),
good AS (SELECT Symbol, count(DISTINCT {MINUTE}) AS n FROM faulty WHERE Symbol IS NOT NULL AND PriceTimestamp IS NOT NULL AND ClosePrice IS NOT NULL GROUP BY Symbol)
SELECT f.Symbol, count(*) AS PendingRows, count(*) FILTER (f.Symbol IS NULL OR PriceTimestamp IS NULL OR ClosePrice IS NULL) AS RejectedRows,
  CAST(0 AS BIGINT) AS RowsBefore, coalesce(any_value(g.n), 0) AS InsertedRows, coalesce(any_value(g.n), 0) AS RowsAfter
FROM faulty f LEFT JOIN good g ON g.Symbol IS NOT DISTINCT FROM f.Symbol GROUP BY f.Symbol""",
    "ingest_backfill": f"""WITH {STAGING}, {VENDOR}, {cutoffs('length(Symbol) > 5')},
symbols AS (SELECT DISTINCT event_type AS Symbol, CASE WHEN length(event_type) % 2 = 0 THEN length(event_type) ELSE 7 END AS Days FROM events)
SELECT v.* FROM vendor v JOIN symbols s USING (Symbol) LEFT JOIN cutoff c USING (Symbol)
WHERE PriceTimestamp >= (SELECT max(PriceTimestamp) FROM vendor) - to_days(CAST(CASE WHEN LastTs IS NULL THEN Days ELSE 1 END AS INTEGER)) AND (LastTs IS NULL OR PriceTimestamp > LastTs)""",
    "ingest_range": f"WITH {VENDOR} SELECT * FROM vendor WHERE PriceTimestamp >= TIMESTAMP '2024-01-05' AND PriceTimestamp < TIMESTAMP '2024-01-12'",
    "ingest_summary": f"""WITH {bars('minute')}, per AS (
  SELECT Symbol, 1 AS Symbols, count(DISTINCT {DAY}) AS DaysProcessed, count(*) AS RowsInserted, min(PriceTimestamp) AS FirstTimestamp, max(PriceTimestamp) AS LastTimestamp FROM bars GROUP BY Symbol)
SELECT Symbol, CAST(Symbols AS BIGINT) AS Symbols, DaysProcessed, RowsInserted, FirstTimestamp, LastTimestamp FROM per UNION ALL
SELECT NULL, count(*), CAST(sum(DaysProcessed) AS BIGINT), CAST(sum(RowsInserted) AS BIGINT), min(FirstTimestamp), max(LastTimestamp) FROM per""",
    "ingest_per_date": f"WITH {bars('minute')} SELECT Symbol, {DAY} AS TradeDate, count(*) AS RowsInserted FROM bars GROUP BY 1, 2",
    "symbols_days": "SELECT c_name AS Symbol, CASE WHEN c_acctbal < 0 THEN 7 ELSE c_nationkey END AS Days FROM customer",
    "dq_dupe_keys": "SELECT 'lineitem' AS TableName, l_suppkey, l_shipdate, count(*) AS Cnt FROM lineitem GROUP BY l_suppkey, l_shipdate HAVING count(*) > 1",
    "dq_dupe_indicators": f"WITH {bars()}, {STEP}, {ROLLED} SELECT 'indicators' AS TableName, {KEYS}, 7 AS IndicatorId, CAST(2 AS BIGINT) AS Cnt FROM ind WHERE RSI_14 IS NOT NULL",
    "dq_dupe_rows": f"WITH {STAGING} SELECT * EXCLUDE (c) FROM (SELECT *, count(*) OVER (PARTITION BY Symbol, {MINUTE}) AS c FROM staging) WHERE c > 1",
    "dq_dupe_rows_exported": f"WITH {STAGING} SELECT * EXCLUDE (c) FROM (SELECT *, sum(Exported) OVER (PARTITION BY Symbol, {MINUTE}) AS c FROM staging) WHERE c > 1",
    "dq_minute_dupes": f"WITH {STAGING} SELECT Symbol, {MINUTE} AS MinuteTimestamp, count(*) AS Cnt FROM staging GROUP BY 1, 2 HAVING count(*) > 1",
    "dq_daily": f"WITH {bars()} {count_by(f'{DAY} AS TradeDate', '1')}",
    "dq_daily_symbol": f"WITH {bars()} {count_by(f'{DAY} AS TradeDate, Symbol', '1, 2')}",
    "dq_low_coverage": f"WITH {bars()} {count_by(f'{DAY} AS TradeDate, Symbol', '1, 2', 'HAVING count(*) < 24')}",
    "dq_inserted_today": f"WITH {STAGING} SELECT count(*) AS RowsInsertedToday FROM staging WHERE LoadTimestamp >= {AT}",
    "dq_inserted_by_run": f"SELECT count(*) AS RowsInsertedTodayByRunId FROM (SELECT 'SIGNAL_' || strftime(ts, '%Y%m%d_%H%M%S') AS id FROM events) WHERE starts_with(id, 'SIGNAL_{ASOF:%Y%m%d}')",
    "dq_rows_between": f"WITH {STAGING} SELECT count(*) AS RowsThisRun FROM staging WHERE LoadTimestamp >= {AT} AND LoadTimestamp <= {AT} + INTERVAL 2 DAY",
    "dq_ranges": f"WITH {STAGING} SELECT count(*) FILTER (OpenPrice - 5 <= 0) AS BadOpen, count(*) FILTER (HighPrice <= 0) AS BadHigh, count(*) FILTER (LowPrice <= 0) AS BadLow, count(*) FILTER (ClosePrice - 5 <= 0) AS BadClose, count(*) FILTER (Volume - 5 < 0) AS BadVolume FROM staging",
    "dq_nulls": "SELECT t.c AS ColumnName, CASE WHEN t.c = 'ClosePrice' THEN count(*) FILTER (value < 1) ELSE 0 END AS NullCount FROM events, (VALUES "
                + ", ".join(f"('{c}')" for c in BAR_COLUMNS) + ") AS t(c) GROUP BY t.c",
    "dq_rowcount": f"WITH {bars()} SELECT count(*) AS Cnt, count(*) >= 1000 AS Ok FROM bars",
    "dq_orphans": f"WITH RECURSIVE {WIDE}, {LONG} SELECT count(*) AS Orphans FROM long WHERE extract(hour FROM PriceTimestamp) % 2 <> 0",
    "dq_table_counts": f"WITH RECURSIVE {WIDE}, {LONG}, {STAGING}, {RAW} " + " UNION ALL ".join([
        table_row("staging", "staging"), table_row("raw_bars", "raw"), table_row("indicators", "long"),
        table_row("merged_features", "bars"), table_row("signal_features", f"(SELECT * FROM bars WHERE PriceTimestamp < {AT})"),
    ]),
    "dq_report": f"WITH {bars()} " + " UNION ALL ".join([
        "SELECT 'table_exists_raw_bars' AS \"check\", true AS ok, 'present' AS details",
        "SELECT 'table_exists_indicators', true, 'present'",
        "SELECT 'columns_raw_bars', true, 'all present'",
        check("nulls_raw_bars", f"({NULLS}) = 0", f"CAST({NULLS} AS VARCHAR) || ' NULLs'", "bars"),
        check("ranges_raw_bars", f"({BAD}) = 0", f"CAST({BAD} AS VARCHAR) || ' values out of range'", "bars"),
        check("row_count_raw_bars", "count(*) >= 1000", "CAST(count(*) AS VARCHAR) || ' rows'", "bars"),
        check("duplicates_raw_bars", "count(*) = 0", "CAST(count(*) AS VARCHAR) || ' duplicate keys'", DUPES),
        "SELECT 'orphans_indicators', true, '0 orphans'",
    ]),
    "dq_report_missing": f"WITH {bars()} " + " UNION ALL ".join([
        "SELECT 'table_exists_raw_bars' AS \"check\", true AS ok, 'present' AS details",
        "SELECT 'table_exists_indicators', false, 'missing'",
        "SELECT 'orphans_indicators', false, 'could not run: a table is missing'",
        "SELECT 'columns_raw_bars', true, 'all present'",
        check("nulls_raw_bars", f"({NULLS}) = 0", f"CAST({NULLS} AS VARCHAR) || ' NULLs'", "bars"),
        check("ranges_raw_bars", f"({BAD}) = 0", f"CAST({BAD} AS VARCHAR) || ' values out of range'", "bars"),
        check("row_count_raw_bars", "count(*) >= 1000", "CAST(count(*) AS VARCHAR) || ' rows'", "bars"),
        check("duplicates_raw_bars", "count(*) = 0", "CAST(count(*) AS VARCHAR) || ' duplicate keys'", DUPES),
    ]),
    "sanitise_numeric": """WITH t AS (SELECT event_id, value, ts, event_id % 6 AS k, CASE event_id % 6 WHEN 0 THEN value END AS x FROM events)
SELECT event_id, x AS without_infinity, x AS clean,
  CASE k WHEN 2 THEN 100.0::DOUBLE WHEN 3 THEN -100.0::DOUBLE ELSE CASE WHEN x > 100 THEN 100 ELSE x END END AS clipped,
  CASE WHEN k <> 1 THEN ts END AS at, CASE WHEN x > 50 OR k IN (2, 4) THEN 1 ELSE 0 END AS above,
  CASE WHEN value > 50 THEN 1 ELSE 0 END AS as_int FROM t""",
    "calendar_fields": """WITH t AS (SELECT *, CAST(extract(hour FROM ts) AS INTEGER) AS h FROM events)
SELECT event_id, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS minute_start, ts - INTERVAL 5 HOUR AS exchange_ts, h BETWEEN 9 AND 16 AS regular,
  CAST(isodow(ts) AS INTEGER) AS day_of_week, h AS hour_of_day, CAST(extract(minute FROM ts) AS INTEGER) AS minute_of_hour,
  CASE WHEN h < 9 OR h >= 16 THEN 0 WHEN h = 9 THEN 1 WHEN h = 15 THEN 3 ELSE 2 END AS session_type,
  CAST(ts AS DATE) AS trade_date, event_type || '_' || CAST(user_id AS VARCHAR) AS field_name FROM t""",
    "schema_columns": f"""SELECT table_name AS TableName, column_name AS ColumnName, CAST(ordinal_position AS INTEGER) AS OrdinalPosition,
  CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS DataType,
  CAST(NULL AS INTEGER) AS MaximumLength, is_nullable = 'YES' AS IsNullable
FROM information_schema.columns WHERE table_name IN ({", ".join(f"'{t}'" for t in SHOWN_TABLES)})""",
    "preview_top_n": f"WITH {bars()} SELECT * FROM bars WHERE Symbol = 'click' ORDER BY PriceTimestamp LIMIT 2000",
    "fs_active": f"WITH RECURSIVE {WIDE}, {NORM}, {RANKED}, {ENGINEERED} " + " UNION ALL ".join(
        f"SELECT '{name}' AS FeatureName, {ordinal} AS Ordinal, count({name}) AS NonNullRows FROM engineered"
        for set_id, name, ordinal in MEMBER_ROWS if set_id == 2 and name != "Not_There"),
    "train_split": split("PriceTimestamp, Symbol"),
    "train_split_symbol": split("Symbol, PriceTimestamp"),
    "class_weights": f"WITH {bars()}, {LABELLED}, c AS (SELECT {LABEL} AS Label, count(*) AS n FROM labelled GROUP BY 1) SELECT Label, n, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n), 6) AS weight FROM c",
    "eval_accuracy": f"WITH {bars()}, {SCORED}, placed AS (SELECT *, row_number() OVER ({TS_ORDER}) - 1 AS position, count(*) OVER () AS total FROM scored) SELECT position < floor(total * 0.8::DOUBLE) AS is_train, round(avg(CASE WHEN Label = Prediction THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy, count(*) AS n FROM placed GROUP BY 1",
    "eval_confusion": f"WITH {bars()}, {SCORED} SELECT Label, " + ", ".join(f"count(*) FILTER (Prediction = {v}) AS \"pred_{v}\"" for v in (-1, 0, 1)) + " FROM scored GROUP BY Label",
    "eval_report": f"""WITH {bars()}, {REPORT} SELECT CAST(label AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM score UNION ALL
SELECT 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), round(sum(hit) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM score UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM score UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM score""",
    "runlog_stages": rf"""WITH {LINES} SELECT run, {at(WHOLE, 'Total rows inserted:', '0')} AS ingest_rows, CAST(0 AS BIGINT) AS ingest_symbols, CAST(NULL AS DOUBLE) AS ingest_runtime,
  {at(r"TRY_CAST(regexp_extract(value, '(\d+) new rows', 1) AS BIGINT)", 'new rows into', '0')} AS merge_rows, {at(FLOAT, 'MERGE COMPLETED in')} AS merge_runtime,
  {at(WHOLE, 'Total computed indicator rows', '0')} AS indicator_rows, CAST(NULL AS DOUBLE) AS indicator_runtime,
  {at(r"TRY_CAST(replace(regexp_extract(value, '([\d,]+) rows', 1), ',', '') AS BIGINT)", 'Merged dataset:', '0')} AS feature_rows, {at(FLOAT, 'Insert step completed in')} AS feature_runtime,
  {at(r"TRY_CAST(replace(regexp_extract(value, '([\d,]+) price rows', 1), ',', '') AS BIGINT)", 'price rows')} AS raw_before, {at(WHOLE, 'RawPrices after merge')} AS raw_after,
  CAST(epoch({at("CAST(left(value, 19) AS TIMESTAMP)", 'Completed: merge')}) - epoch({at("CAST(left(value, 19) AS TIMESTAMP)", 'ORCHESTRATOR STARTED')}) AS BIGINT) AS total_runtime FROM lines GROUP BY run""",
    "runlog_symbols": rf"""WITH {LINES}, marks AS (SELECT run, line_no, kind, regexp_extract(value, 'Processing (\S+)', 1) AS Symbol, lead(CASE WHEN kind = 1 THEN {FLOAT} END) OVER (PARTITION BY run ORDER BY line_no) AS duration,
  FROM lines WHERE kind IN (0, 1)), latest AS (SELECT *, row_number() OVER (PARTITION BY run, Symbol ORDER BY line_no DESC) AS k FROM marks WHERE kind = 0)
SELECT run, Symbol, duration FROM latest WHERE k = 1""",
    "runlog_indicators": rf"""WITH {LINES} SELECT run, regexp_extract(value, 'indicator (\S+)', 1) AS IndicatorName, count(*) AS runs, round(avg({FLOAT}), 2) AS avg_seconds FROM lines WHERE kind = 2 GROUP BY 1, 2""",
}
