"""Streaming queries (ST1-ST3): each runs a Structured Streaming job over the
event files to completion (availableNow) into a checkpointed file sink in
the shared folder and returns that table; the oracle is the batch SQL with
forward-only imputation (a stream cannot fill backward)."""

from __future__ import annotations

from panelkit import constants as K
from panelkit.plans import oracle as O
from panelkit.plans.registry import finish, query
from panelkit.streaming import stateful as ST

IMP_FWD = ("imp AS (SELECT patient_id, iculos, "
           + ", ".join(f"last_value({c} IGNORE NULLS) OVER {O.W_RUN} AS {c}" for c in O.VITALS + ["lactate"])
           + ", age, gender, sepsislabel FROM panel)")
FWD_CTES = [O.PANEL, IMP_FWD, O.FEAT0, O.FEAT]
FC_SQL = ", ".join(
    f"{O.bround_sql(f'i.hr + (i.hr - lag(i.hr, 5) OVER (PARTITION BY i.patient_id ORDER BY i.iculos)) / 5e0 * {i}e0', 1)} AS fc{i}"
    for i in range(1, 7))


def events_glob(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/event[s].parquet"


@query("stream_rolling_features", "ST2 ST3 C2 D1 D2 D3 E1 E2 J15",
       O.with_(FWD_CTES + [f"fc AS (SELECT i.patient_id, i.iculos, {FC_SQL} FROM imp i)"],
               f"SELECT {O.feature_select('f.')}, " + ", ".join(f"round(fc.fc{i}, 6) AS fc{i}" for i in range(1, 7))
               + " FROM feat f JOIN fc ON f.patient_id = fc.patient_id AND f.iculos = fc.iculos"))
def q_stream_rolling_features(spark, sf_dir):
    return finish(ST.stream_features(spark, events_glob(sf_dir)).select(*ST.OUT_COLS))


DANGER_SQL = " + ".join(f"(CASE WHEN fc.fc{i} > 100 THEN 1 ELSE 0 END)" for i in range(1, 7))


@query("stream_scores", "ST1 ST3 E4 E7 E12",
       O.with_(FWD_CTES + [f"fc AS (SELECT i.patient_id, i.iculos, {FC_SQL} FROM imp i)"],
               "SELECT f.patient_id, CAST(f.iculos AS BIGINT) AS iculos, round(f.hr, 6) AS hr, round(f.temp, 6) AS temp, "
               f"round({O.RISK_SQL}, 6) AS score, CASE WHEN {O.RISK_SQL} >= 0.7e0 THEN 'HIGH RISK' "
               f"WHEN {O.RISK_SQL} >= 0.4e0 THEN 'MODERATE RISK' ELSE 'LOW RISK' END AS risk_level, "
               "concat_ws(', ', " + ", ".join(f"CASE WHEN {f} > 0 THEN '{t}' END" for f, t in K.ALERTS)
               + f", CASE WHEN qsofa >= 2 THEN '{K.QSOFA_ALERT}' END) AS alerts, "
               f"CAST({DANGER_SQL} AS BIGINT) AS danger_hours, "
               f"CASE WHEN {DANGER_SQL} > 0 THEN 'HR predicted >100bpm in ' || ({DANGER_SQL}) || ' of next 6 hours' "
               "ELSE 'No danger predicted' END AS forecast_message "
               "FROM feat f JOIN fc ON f.patient_id = fc.patient_id AND f.iculos = fc.iculos"))
def q_stream_scores(spark, sf_dir):
    return finish(ST.stream_scores(spark, events_glob(sf_dir)))
