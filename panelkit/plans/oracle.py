"""Independent SQL text (DuckDB dialect) for the oracle side of every query.

The CTEs mirror the Spark plans step by step but are written from the
operator semantics, not generated from the Spark plan. Every float is
rounded to 6 digits and every integer cast to BIGINT in final selects.
"""

from __future__ import annotations

from panelkit import constants as K

PANEL = """panel AS (
  SELECT concat('p', lpad(CAST(user_id AS varchar), 6, '0')) AS patient_id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS iculos,
         CASE WHEN event_type <> 'error'    THEN 50 + value/2 END AS hr,
         CASE WHEN event_type <> 'view'     THEN greatest(60e0, 100 - value/12) END AS o2sat,
         CASE WHEN event_type <> 'signup'   THEN 35.5e0 + k/25e0 END AS temp,
         85 + ((event_id*53) % 100)*7/10e0 AS sbp,
         CASE WHEN event_type <> 'click'    THEN 55 + ((event_id*37) % 100)/2e0 END AS map,
         40 + ((event_id*71) % 100)/2e0 AS dbp,
         CASE WHEN event_type <> 'purchase' THEN CAST(10 + ((event_id*89 + k) % 20) AS double) END AS resp,
         CASE WHEN event_type = 'purchase'  THEN 0.5e0 + value/40 END AS lactate,
         CAST(20 + user_id % 70 AS double) AS age,
         CAST(user_id % 2 AS double) AS gender,
         CASE WHEN value > 90 AND k > 60 THEN 1 ELSE 0 END AS sepsislabel
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) e
)"""

W_RUN = "(PARTITION BY patient_id ORDER BY iculos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
W_ALL = "(PARTITION BY patient_id ORDER BY iculos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
W_ORD = "(PARTITION BY patient_id ORDER BY iculos)"


def w_trail(n: int) -> str:
    return f"(PARTITION BY patient_id ORDER BY iculos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


VITALS = ["hr", "o2sat", "temp", "sbp", "map", "dbp", "resp"]


def _ffbf(c: str) -> str:
    return f"coalesce(last_value({c} IGNORE NULLS) OVER {W_RUN}, first_value({c} IGNORE NULLS) OVER {W_ALL}) AS {c}"


IMP = ("imp AS (\n  SELECT patient_id, iculos,\n    "
       + ",\n    ".join(_ffbf(c) for c in VITALS)
       + f",\n    last_value(lactate IGNORE NULLS) OVER {W_RUN} AS lactate,"
       + "\n    age, gender, sepsislabel\n  FROM panel\n)")

_OPS_SQL = {">": ">", "<": "<", ">=": ">=", "==": "=", "<=": "<="}


FEAT0_COLS = (
    [f"avg({src}) OVER {w_trail(n)} AS {name}" for name, src, n in K.ROLLING_MEANS]
    + [f"{src} - lag({src}) OVER {W_ORD} AS {name}" for name, src in K.TRENDS]
    + [f"coalesce(stddev_samp({src}) OVER {w_trail(n)}, 0e0) AS {name}" for name, src, n in K.ROLLING_STDS]
    + [f"CASE WHEN {src} {_OPS_SQL[op]} {t}e0 THEN 1 ELSE 0 END AS {name}" for name, src, op, t in K.ALARM_FLAGS]
    + ["iculos AS hours_in_icu"]
)

FEAT0 = "feat0 AS (\n  SELECT *,\n    " + ",\n    ".join(FEAT0_COLS) + "\n  FROM imp\n)"

_DOUBLE_FEATS = (VITALS + ["lactate", "age", "gender"]
                 + [c for c, _, _ in K.ROLLING_MEANS] + [c for c, _ in K.TRENDS]
                 + [c for c, _, _ in K.ROLLING_STDS])
_INT_FEATS = ["sepsislabel"] + K.FLAG_COLS + ["hours_in_icu"]

FEAT = ("feat AS (\n  SELECT patient_id, iculos,\n    "
        + ",\n    ".join([f"coalesce({c}, 0e0) AS {c}" for c in _DOUBLE_FEATS]
                         + [f"coalesce({c}, 0) AS {c}" for c in _INT_FEATS]
                         + ["flag_tachypnea + flag_low_bp AS qsofa"])
        + "\n  FROM feat0\n)")

FEATURE_CTES = [PANEL, IMP, FEAT0, FEAT]

DOUBLE_COLS = _DOUBLE_FEATS
INT_COLS = ["iculos"] + _INT_FEATS + ["qsofa"]


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def r6(expr: str, alias: str | None = None) -> str:
    return f"round({expr}, 6) AS {alias or expr}"


def i64(expr: str, alias: str | None = None) -> str:
    return f"CAST({expr} AS BIGINT) AS {alias or expr}"


def feature_select(prefix: str = "") -> str:
    """Select list of the whole feature table, rounded/cast like Spark's ``finish``."""
    p = prefix
    return ", ".join([f"{p}patient_id AS patient_id"]
                     + [f"CAST({p}{c} AS BIGINT) AS {c}" for c in INT_COLS]
                     + [f"round({p}{c}, 6) AS {c}" for c in DOUBLE_COLS])


# next-hour table (D4 + B5) and the ordered 80/20 split over it
NH = (f"nh AS (SELECT * FROM (SELECT *, lead(hr) OVER {W_ORD} AS hr_next_hour FROM feat) t "
      "WHERE hr_next_hour IS NOT NULL)")
SPLIT = ("sp AS (SELECT *, row_number() OVER (ORDER BY patient_id, iculos) AS rn, "
         "count(*) OVER () AS n_all FROM nh)")
TRAIN = "train AS (SELECT * FROM sp WHERE rn <= n_all - CAST(ceil(n_all * 0.2) AS BIGINT))"
TEST = "test AS (SELECT * FROM sp WHERE rn > n_all - CAST(ceil(n_all * 0.2) AS BIGINT))"
SPLIT_CTES = FEATURE_CTES + [NH, SPLIT, TRAIN, TEST]

# sliding windows over hr (D5) and their time-ordered 80/20 split (floor for train)
WIN = ("win AS (SELECT * FROM (SELECT patient_id, iculos, "
       + ", ".join(f"lag(hr, {i}) OVER {W_ORD} AS lag{i}" for i in range(6, 0, -1))
       + f", hr AS y, row_number() OVER {W_ORD} AS rn_e FROM feat) t WHERE rn_e > 6)")
WSPLIT = ("wsp AS (SELECT *, row_number() OVER (ORDER BY patient_id, iculos) AS rn, "
          "count(*) OVER () AS n_all FROM win)")
WTEST = "wtest AS (SELECT * FROM wsp WHERE rn > CAST(floor(n_all * 0.8) AS BIGINT))"
WIN_CTES = FEATURE_CTES + [WIN, WSPLIT, WTEST]

RISK_SQL = "((flag_tachy + flag_hypoxia + flag_fever + flag_hypotemp + flag_low_bp + flag_tachypnea + qsofa) / 8e0)"


def bround_sql(expr: str, digits: int = 1) -> str:
    """Half-even rounding of the shortest decimal form of a double (Spark's
    ``bround``), done in exact DECIMAL arithmetic."""
    t = f"(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38, 20)) * {10 ** digits})"
    f = f"floor({t})"
    return (f"CAST((CASE WHEN {t} - {f} > 0.5 THEN {f} + 1 WHEN {t} - {f} < 0.5 THEN {f} "
            f"WHEN {f} % 2 = 0 THEN {f} ELSE {f} + 1 END) / {10 ** digits}e0 AS DOUBLE)")


def exact_mean_sql(c: str) -> str:
    """Half-up mean of ``c`` at 6 decimals from an exact DECIMAL sum (integer
    arithmetic; DuckDB divides decimals in floating point)."""
    s = f"CAST(sum(CAST({c} AS DECIMAL(18,6))) * 1000000 AS HUGEINT)"
    n = f"CAST(count({c}) AS HUGEINT)"
    return f"CAST(sign({s}) * ((abs({s}) * 2 + {n}) // (2 * {n})) AS DOUBLE) / 1e6"
