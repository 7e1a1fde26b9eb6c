from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from potluck.session import checkpoint_dir, get_spark

    s = get_spark("potluck-tests", master="local[4]", shuffle_partitions=8)
    checkpoint_dir(s)  # tests set their own folder when the cluster names none
    yield s


@pytest.fixture(scope="session")
def interactions(spark):
    """The 6-row interactions fixture (one null review)."""
    rows = [
        (1, 10, 5.0, "Amazing recipe! Loved it", dt.datetime(2020, 1, 15)),
        (1, 11, 4.0, "Pretty good; thanks!", dt.datetime(2020, 2, 2)),
        (2, 10, 3.0, "ok taste", dt.datetime(2020, 2, 20)),
        (3, 12, 5.0, "BEST EVER!!!", dt.datetime(2020, 3, 5)),
        (3, 12, 2.0, "not good", dt.datetime(2020, 4, 1)),
        (3, 13, 4.0, None, dt.datetime(2020, 4, 28)),
    ]
    return spark.createDataFrame(rows, "user_id long, recipe_id long, rating double, review string, date timestamp_ntz")


@pytest.fixture(scope="session")
def recipes(spark):
    """The 4-row recipes fixture (id 2 duplicated with a different list)."""
    rows = [
        (1, "Apple Pie", 45, 8, dt.datetime(2020, 1, 1), ["apple", "flour", "sugar"],
         [250.0, 10.0, 30.0, 200.0, 3.0, 2.0, 40.0], ["dessert", "baked"], "US", "winter"),
        (2, "Tomato Pasta", 20, 5, dt.datetime(2020, 2, 1), ["tomato", "pasta", "basil"],
         [500.0, 14.0, 8.0, 600.0, 13.0, 4.0, 70.0], ["italian", "quick"], "IT", "all"),
        (2, "Tomato Pasta", 20, 5, dt.datetime(2020, 2, 1), ["tomato", "pasta", "garlic"],
         [480.0, 12.0, 7.0, 580.0, 12.0, 3.5, 68.0], ["italian", "garlicky"], "IT", "all"),
        (3, "Avocado Toast", 10, 3, dt.datetime(2021, 6, 15), ["avocado", "bread", "lemon"],
         [300.0, 20.0, 2.0, 350.0, 6.0, 3.0, 25.0], ["breakfast", "quick"], "US", "summer"),
    ]
    return spark.createDataFrame(rows, "id long, name string, minutes long, n_steps long, submitted timestamp_ntz, "
                                       "ingredients array<string>, nutrition array<double>, tags array<string>, "
                                       "country string, season string")
