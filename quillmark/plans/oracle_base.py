"""Shared pieces of the DuckDB oracles: the stand-in views as CTEs and the common expressions."""

from __future__ import annotations


def r(x: str, places: int = 0) -> str:
    """Half-up rounding as the jobs do it."""
    return f"(floor(CAST({x} AS DOUBLE) * {float(10**places)} + 0.5) / {float(10**places)})"


def pct(cur: str, old: str) -> str:
    return f"CASE WHEN {cur} <> 0 AND {old} <> 0 THEN {r(f'CAST({cur} - {old} AS DOUBLE) / {old} * 100', 1)} END"


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN {a} <> 0 AND {b} <> 0 THEN {r(f'CAST({a} AS DOUBLE) / {b}', 2)} END"


def cents(x: str) -> str:
    return f"CAST(floor(CAST({x} AS DOUBLE) * 100 + 0.5) AS BIGINT)"


PRICES = f"""
prices AS (SELECT CAST(user_id AS VARCHAR) AS card_slug, CAST(ts AS DATE) AS date,
  max(CASE WHEN event_type = 'view' THEN {cents("value")} END) AS raw_usd, max(CASE WHEN event_type = 'click' THEN {cents("value")} END) AS psa9_usd,
  max(CASE WHEN event_type = 'purchase' THEN {cents("value")} END) AS psa10_usd, max(CASE WHEN event_type = 'signup' THEN {cents("value")} END) AS psa8_usd,
  max(CASE WHEN event_type = 'error' THEN {cents("value")} END) AS psa7_usd FROM events GROUP BY 1, 2)"""

MONTHLY = f"""
prices AS (SELECT CAST(l_partkey AS VARCHAR) AS card_slug, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
  max(CASE WHEN l_returnflag = 'N' THEN {cents("l_extendedprice / l_quantity")} END) AS raw_usd, max(CASE WHEN l_returnflag = 'A' THEN {cents("l_extendedprice / l_quantity")} END) AS psa9_usd,
  max(CASE WHEN l_returnflag = 'R' THEN {cents("l_extendedprice / l_quantity")} END) AS psa10_usd FROM lineitem GROUP BY 1, 2)"""

CARDS = """
cards AS (SELECT CAST(p_partkey AS VARCHAR) AS card_slug, p_name || ' #' || p_size AS card_name, p_brand AS set_name FROM part)"""


def metrics(as_of: str, grades: tuple[str, ...]) -> str:
    """CTEs ending in ``metrics`` from ``prices``."""
    long = " UNION ALL ".join(f"SELECT card_slug, '{g}' AS grade, date, {g}_usd AS price FROM prices WHERE {g}_usd > 0" for g in grades)
    within = lambda d, x: f"CASE WHEN ago <= {d} THEN {x} END"
    slopes = ", ".join(f"{r(f'regr_slope({within(d, "price")}, {within(d, f"{d} - ago")})', 4)} AS slope_{d}d" for d in (30, 90, 365))
    vols = ", ".join(f"CASE WHEN avg({within(d, 'price')}) <> 0 THEN {r(f'stddev_samp({within(d, "price")}) / avg({within(d, "price")})', 4)} END AS volatility_{d}d" for d in (30, 90))
    olds = ", ".join(f"arg_max(price, CASE WHEN ago >= {d} THEN date END) AS old_{d}" for d in (7, 30, 90, 180, 365))
    pcts = ", ".join(f"{pct('current_price', f'old_{d}')} AS pct_{d}d" for d in (7, 30, 90, 180, 365))
    return f"""
aso AS (SELECT {as_of} AS d),
long AS (SELECT *, date_diff('day', date, (SELECT d FROM aso)) AS ago FROM ({long}) WHERE date <= (SELECT d FROM aso)),
cur AS (SELECT card_slug, grade, price AS current_price FROM long WHERE ago = 0),
ath AS (SELECT card_slug, grade, price AS ath_price, date AS ath_date FROM long QUALIFY row_number() OVER (PARTITION BY card_slug, grade ORDER BY price DESC, date) = 1),
low AS (SELECT l.card_slug, l.grade, l.price AS bottom_price, l.date AS bottom_date FROM long l JOIN ath USING (card_slug, grade) WHERE l.date >= ath_date
  QUALIFY row_number() OVER (PARTITION BY l.card_slug, l.grade ORDER BY l.price, l.date) = 1),
top AS (SELECT card_slug, grade, price AS high_12m, date AS high_12m_date FROM long WHERE ago <= 365 QUALIFY row_number() OVER (PARTITION BY card_slug, grade ORDER BY price DESC, date) = 1),
agg AS (SELECT card_slug, grade, {slopes}, {vols}, {olds}, count(*) AS n, count(*) FILTER (ago <= 90) AS n90, min(ago) AS fresh FROM long GROUP BY 1, 2),
metrics AS (SELECT card_slug, grade, current_price, ath_price, ath_date, {pct("current_price", "ath_price")} AS drawdown_pct, bottom_price, bottom_date,
  CASE WHEN ath_price > bottom_price THEN {r("CAST(current_price - bottom_price AS DOUBLE) / (ath_price - bottom_price) * 100", 2)} ELSE 100.0 END AS recovery_pct,
  high_12m, high_12m_date, coalesce(current_price >= high_12m, false) AS is_new_12m_high, slope_30d, slope_90d, slope_365d, volatility_30d, volatility_90d, {pcts},
  n AS data_points_total, n90 AS data_points_90d, CAST(fresh AS BIGINT) AS freshness_days,
  CASE WHEN n >= 12 AND n90 >= 2 THEN 'high' WHEN n >= 6 THEN 'medium' WHEN n >= 3 THEN 'low' ELSE 'very_low' END AS confidence, (SELECT d FROM aso) AS as_of
  FROM cur JOIN ath USING (card_slug, grade) JOIN low USING (card_slug, grade) JOIN top USING (card_slug, grade) JOIN agg USING (card_slug, grade))"""


def spread(as_of: str, cols: tuple[str, ...]) -> str:
    """CTEs ending in ``spread`` from ``prices``."""
    c = lambda x: f"t.{x}_usd" if x in cols else "CAST(NULL AS BIGINT)"
    h = lambda a, x: f"{a}.{x}_usd"
    now = {"10_to_raw": ratio(c("psa10"), c("raw")), "10_to_9": ratio(c("psa10"), c("psa9")), "9_to_raw": ratio(c("psa9"), c("raw"))}
    old = {f"{n}_{d}d": ratio(h(f"h{d}", a), h(f"h{d}", b)) for d in (30, 90) for n, a, b in (("10_to_raw", "psa10", "raw"), ("10_to_9", "psa10", "psa9"), ("9_to_raw", "psa9", "raw"))}
    trend = lambda n: f"CASE WHEN ratio_{n} - coalesce(ratio_{n}_90d, ratio_{n}_30d) IS NULL THEN 'insufficient_data' WHEN abs(ratio_{n} - coalesce(ratio_{n}_90d, ratio_{n}_30d)) < 0.1 THEN 'stable' WHEN ratio_{n} > coalesce(ratio_{n}_90d, ratio_{n}_30d) THEN 'expanding' ELSE 'compressing' END"
    r8 = ratio("psa8_price", "raw_price")
    best = f"CASE WHEN ratio_9_to_raw > 0 AND ratio_9_to_raw <= coalesce(nullif(ratio_10_to_raw, 0), 1e300) AND ratio_9_to_raw <= coalesce(nullif({r8}, 0), 1e300) THEN 'psa9' WHEN ratio_10_to_raw > 0 AND ratio_10_to_raw <= coalesce(nullif({r8}, 0), 1e300) THEN 'psa10' WHEN {r8} > 0 THEN 'psa8' END"
    return f"""
sd AS (SELECT {as_of} AS d0), s30 AS (SELECT max(date) AS d FROM prices WHERE date <= (SELECT d0 FROM sd) - 30), s90 AS (SELECT max(date) AS d FROM prices WHERE date <= (SELECT d0 FROM sd) - 90),
spread0 AS (SELECT t.card_slug, {", ".join(f"{c(x)} AS {x}_price" for x in ("raw", "psa7", "psa8", "psa9", "cgc95", "psa10"))},
  {", ".join(f"{x} AS ratio_{n}" for n, x in now.items())}, {ratio(c("psa9"), c("psa8"))} AS ratio_9_to_8, {ratio(c("psa9"), c("psa7"))} AS ratio_9_to_7,
  {", ".join(f"{x} AS ratio_{n}" for n, x in old.items())}
  FROM prices t LEFT JOIN prices h30 ON t.card_slug = h30.card_slug AND h30.date = (SELECT d FROM s30) LEFT JOIN prices h90 ON t.card_slug = h90.card_slug AND h90.date = (SELECT d FROM s90)
  WHERE t.date = (SELECT d0 FROM sd) AND {c("raw")} <> 0 AND greatest(coalesce({c("psa7")}, 0), coalesce({c("psa8")}, 0), coalesce({c("psa9")}, 0), coalesce({c("psa10")}, 0)) > 0),
spread AS (SELECT *, {trend("10_to_raw")} AS premium_10_trend, {trend("9_to_raw")} AS premium_9_trend, {best} AS best_value_grade, (SELECT d0 FROM sd) AS as_of FROM spread0)"""


HORIZONS = {"7d": 7, "30d": 30, "90d": 90, "180d": 180, "365d": 365, "2y": 730, "5y": 1825}


def trends(as_of: str) -> str:
    """CTEs ending in ``trends`` from ``prices`` and ``cards``."""
    anchors = ", ".join(f"a{h} AS (SELECT max(date) AS d FROM prices WHERE date <= (SELECT d FROM td) - {d})" for h, d in HORIZONS.items())
    joins = " ".join(f"LEFT JOIN prices h{h} ON t.card_slug = h{h}.card_slug AND h{h}.date = (SELECT d FROM a{h})" for h in HORIZONS)
    old = lambda g, h: f"CASE WHEN h30d.card_slug IS NULL THEN fb.{g}_usd ELSE h30d.{g}_usd END" if h == "30d" else f"h{h}.{g}_usd"
    raw = ", ".join(f"{old('raw', h)} AS raw_{h}_ago" for h in HORIZONS)
    ten = ", ".join(f"{old('psa10', h)} AS psa10_{h}_ago" for h in ("30d", "90d"))
    pcts = ", ".join([*[f"{pct('current_raw', f'raw_{h}_ago')} AS raw_pct_{h}" for h in HORIZONS], *[f"{pct('current_psa10', f'psa10_{h}_ago')} AS psa10_pct_{h}" for h in ("30d", "90d")]])
    return f"""
td AS (SELECT {as_of} AS d), {anchors},
fb AS (SELECT * FROM prices WHERE date BETWEEN (SELECT d FROM td) - 40 AND (SELECT d FROM td) - 20 AND date <> (SELECT d FROM a30d) QUALIFY row_number() OVER (PARTITION BY card_slug ORDER BY date DESC) = 1),
trends0 AS (SELECT t.card_slug, card_name, set_name, t.raw_usd AS current_raw, t.psa9_usd AS current_psa9, t.psa10_usd AS current_psa10, {raw}, {ten}
  FROM prices t JOIN cards USING (card_slug) {joins} LEFT JOIN fb ON t.card_slug = fb.card_slug WHERE t.date = (SELECT d FROM td)),
trends AS (SELECT *, {pcts}, (SELECT d FROM td) AS as_of FROM trends0)"""


def sets() -> str:
    """CTEs ending in ``sets`` from ``trends`` and ``cards``."""
    top = lambda k: f"{r(f'CAST(sum(current_raw) FILTER (rk <= {k}) AS DOUBLE) / sum(current_raw) * 100', 1)}"
    weighted = ", ".join(f"{r(f'sum(raw_pct_{p} * current_raw) / sum(current_raw) FILTER (raw_pct_{p} IS NOT NULL)', 1)} AS set_pct_{p}" for p in ("30d", "90d", "180d", "365d"))
    return f"""
rk AS (SELECT *, row_number() OVER (PARTITION BY set_name ORDER BY current_raw DESC, card_slug) AS rk FROM trends WHERE set_name <> '' AND current_raw > 0),
sets0 AS (SELECT set_name, count(*) AS priced_cards, count(*) FILTER (current_raw >= 1000) AS cards_over_10, count(*) FILTER (current_raw >= 10000) AS cards_over_100,
  CAST(sum(current_raw) AS BIGINT) AS set_total_value, CAST(floor(median(current_raw)) AS BIGINT) AS set_median_value, {top(1)} AS top1_share_pct, CASE WHEN count(*) >= 5 THEN {top(5)} END AS top5_share_pct,
  CASE WHEN count(*) >= 10 THEN {top(10)} END AS top10_share_pct, max(card_name) FILTER (rk = 1) AS top1_card_name, max(current_raw) FILTER (rk = 1) AS top1_card_price, {weighted},
  {r("avg(raw_pct_90d) FILTER (rk <= 5)", 1)} AS top5_avg_pct_90d, {r("avg(raw_pct_90d) FILTER (rk > 5)", 1)} AS rest_avg_pct_90d FROM rk GROUP BY set_name HAVING count(*) >= 2),
sets AS (SELECT s.*, n AS total_cards, set_total_value // n AS set_avg_value, {r("rest_avg_pct_90d - top5_avg_pct_90d", 1)} AS divergence_90d, (SELECT d FROM td) AS as_of
  FROM sets0 s JOIN (SELECT set_name, count(*) AS n FROM cards GROUP BY 1) USING (set_name))"""


def index() -> str:
    """CTEs ending in ``idx`` and ``idx_pct`` from ``prices``."""
    near = lambda d: f"(SELECT h.total_raw_usd FROM idx h WHERE h.date BETWEEN i.date - {d + 5} AND i.date - {d - 5} AND h.date <> i.date ORDER BY h.date > i.date - {d}, abs(date_diff('day', h.date, i.date - {d})) LIMIT 1)"
    return f"""
idx AS (SELECT date, CAST(coalesce(sum(raw_usd) FILTER (raw_usd > 0), 0) AS BIGINT) AS total_raw_usd, count(*) FILTER (raw_usd > 0) AS cards_with_raw_price, CAST(floor(median(raw_usd) FILTER (raw_usd > 0)) AS BIGINT) AS median_raw_usd,
  CAST(coalesce(sum(psa10_usd) FILTER (psa10_usd > 0), 0) AS BIGINT) AS total_psa10_usd, count(*) FILTER (psa10_usd > 0) AS cards_with_psa10_price, CAST(floor(median(psa10_usd) FILTER (psa10_usd > 0)) AS BIGINT) AS median_psa10_usd,
  CAST(sum(coalesce(raw_usd, 0) + coalesce(psa9_usd, 0) + coalesce(psa10_usd, 0)) AS BIGINT) AS total_combined_usd, count(*) AS total_cards_tracked FROM prices GROUP BY date),
past AS (SELECT i.*, {", ".join(f"{near(d)} AS p{d}" for d in (1, 7, 30))} FROM idx i),
idx_pct AS (SELECT * EXCLUDE (p1, p7, p30), {", ".join(f"CASE WHEN p{d} > 0 THEN {r(f'CAST(total_raw_usd - p{d} AS DOUBLE) / p{d} * 100', 4)} END AS raw_pct_{d}d" for d in (1, 7, 30))} FROM past)"""
