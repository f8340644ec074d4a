"""The report reads one written ledger and model; classes are ranked by range parts."""

from lapse.operators.dataset import fit_encoder
from lapse.plans.catalog import W, Tables
from lapse.plans.study import Study
from tests.conftest import SF001


def test_outputs_read_the_stored_tables(spark):
    t = Tables(spark, SF001)
    twice = t.ledger.unionAll(t.ledger)
    s = Study(t.profile, twice, W).stored()
    for df in (s.tx_clean, s.model, s.rfm):
        assert df.inputFiles() and all("/study-" in f for f in df.inputFiles())
    plain = Study(t.profile, twice, W)
    assert s.tx_clean.exceptAll(plain.tx_clean).isEmpty() and plain.tx_clean.count() == s.tx_clean.count()
    assert s.model.exceptAll(plain.model).isEmpty() and plain.model.count() == s.model.count()


def test_classes_with_one_prefix_are_ranked_in_byte_order(spark):
    values = [f"location-{i}" for i in range(3000)]
    df = spark.createDataFrame([(v, i % 2 == 0) for i, v in enumerate(values)] + [(None, None)], "location string, gender boolean")
    got = {(r["column_name"], r["value"]): r["code"] for r in fit_encoder(df, ["location", "gender", "absent"]).collect()}
    want = {("location", v): i for i, v in enumerate(sorted([*values, "None"]))} | {("gender", v): i for i, v in enumerate(sorted(["None", "True", "False"]))}
    assert got == want
