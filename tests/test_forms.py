"""The formulations used as a yardstick give the same rows."""

import pytest

import __spark_entry__ as entry
from checks.forms import join_form, profile_form, user_readings, window_form
from checks.queries import rounded
from compare import assert_same

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("form", [profile_form, join_form, window_form])
def test_same_rows(spark, form):
    sql = entry.oracle_sql()["mask_outliers_by_user"]
    assert assert_same(rounded(form(*user_readings(spark, DATA))), sql, DATA) > 0


@pytest.mark.parametrize("form", [profile_form, join_form])
def test_copies_of_users(spark, form):
    assert form(*user_readings(spark, DATA, 3)).count() == 3 * 150 * 720
