"""Source contracts and published schemas."""

from dataclasses import replace

import pytest

from pathwise.plans.refresh import DASHBOARDS, MonthlyRefresh
from pathwise.sources import publish as P
from pathwise.sources.schemas import DASHBOARD_SCHEMAS, struct


def test_fixture_sources_meet_their_contracts(refresh):
    assert refresh.src.validate() is refresh.src


def test_contract_violations_are_listed(refresh):
    src = refresh.src
    broken = replace(src, referral=src.referral.drop("usable"),
                     calendar=src.calendar.withColumn("full_date", src.calendar.full_date.cast("string")))
    with pytest.raises(ValueError) as err:
        broken.validate()
    assert "referral.usable: missing" in str(err.value)
    assert "calendar.full_date: string, expected date" in str(err.value)


def test_text_flags_are_accepted(refresh):
    src = refresh.src
    as_text = replace(src, referral=src.referral.withColumn("usable", src.referral.usable.cast("string")))
    as_text.validate()


def test_every_dashboard_matches_its_published_schema(refresh):
    published = MonthlyRefresh(refresh.src, first=refresh.first, averages="decimal",
                               questionnaire_offset=refresh.questionnaire_offset)
    for name in DASHBOARDS:
        df = getattr(published, name)
        want = struct(DASHBOARD_SCHEMAS[name])
        assert df.columns == want.names, name
        assert [f.dataType for f in df.schema.fields] == [f.dataType for f in want.fields], name


def test_published_tables_read_back_with_their_schema(spark, refresh):
    out = P.new_run_dir(spark, "test-schema")
    paths = refresh.publish(f"{out}/dash", f"{out}/work")
    for name, path in paths.items():
        got = P.read_published(spark, path, struct(DASHBOARD_SCHEMAS[name]).names)
        assert [(f.name, f.dataType) for f in got.schema.fields] == \
            [(f.name, f.dataType) for f in struct(DASHBOARD_SCHEMAS[name]).fields], name
