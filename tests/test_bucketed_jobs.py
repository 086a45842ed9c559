"""Jobs read the feature table by its buckets (A9): no shuffle below the windows and profiles."""

import pytest

from panelkit import constants as K
from panelkit.operators import aggregate as agg
from panelkit.operators import windows
from panelkit.plans import jobs
from panelkit.sources.tables import panel_from_events

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def feats(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("bucketed")
    panel_from_events(spark, SF_SMALL).write.parquet(str(base / "panel"))
    spark.sql("DROP TABLE IF EXISTS patient_features")
    yield jobs.features(spark, str(base / "panel"), str(base / "out"), buckets=4)
    spark.sql("DROP TABLE IF EXISTS patient_features")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name,derive", [
    ("train", lambda f: windows.lead_target(f, jobs.SPEC)),
    ("forecast", lambda f: windows.sliding_windows(f, jobs.SPEC, "hr", K.WINDOW_SIZE)),
    ("lookalikes", lambda f: agg.entity_profile(f, jobs.SPEC)),
])
def test_no_exchange_below_windows_and_profiles(feats, name, derive):
    text = plan(derive(feats))
    assert "Exchange" not in text, text
    assert "Bucketed: true" in text or "SelectedBucketsCount: 4 out of 4" in text


def test_rules_job_shuffles_only_for_its_counts(feats):
    """P6 takes rows as they lie: binning and the hash cut add no exchange."""
    from panelkit.functions import scalar as X
    from panelkit.operators import split
    ev = feats.select("patient_id", "iculos", "sepsislabel", *X.event_bins())
    text = plan(split.balanced_sample(ev, ["patient_id", "iculos"], "sepsislabel", K.NEGATIVES_PER_POSITIVE))
    assert "Exchange hashpartitioning(patient_id" not in text and "SinglePartition" not in text
