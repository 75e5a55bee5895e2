"""Types found by a full pass over raw CSV, against hand-written files."""

from __future__ import annotations

import datetime as dt

from kpiloom.operators.clean import clean_market
from kpiloom.plans.catalog import market_csv_inferred
from kpiloom.schemas import MARKET_COLUMNS
from kpiloom.sources.market import read_market_csv
from kpiloom.sources import testdata

from conftest import SF_SMALL

ROW = {"obs_date": "2024-03-01", "platform": "PC", "genre": "RPG", "current_price_usd": "9.99", "discount_pc": "10", "is_on_sale": "1",
       "concurrent_players": "1500", "hype_score": "7.5", "estimated_revenue_usd": "1234.5", "is_early_access": "0", "holiday_sale": "0"}


def folder(tmp_dir, *files):
    for n, rows in enumerate(files):
        with open(f"{tmp_dir}/part{n}.csv", "w") as f:
            f.write(",".join(MARKET_COLUMNS) + "\n")
            f.writelines(",".join({**ROW, **r}[c] for c in MARKET_COLUMNS) + "\n" for r in rows)
    return tmp_dir


def test_types_by_all_rows(spark, tmp_dir):
    types = dict(read_market_csv(spark, folder(tmp_dir, [{}] * 3000, [{}] * 10 + [{"is_early_access": ""}]), infer_schema=True).dtypes)
    assert types == {"obs_date": "date", "platform": "string", "genre": "string", "current_price_usd": "double", "discount_pc": "int", "is_on_sale": "int",
                     "concurrent_players": "int", "hype_score": "double", "estimated_revenue_usd": "double", "is_early_access": "int", "holiday_sale": "int"}


def test_one_cell_of_the_last_file_changes_a_type(spark, tmp_dir):
    last = {"concurrent_players": "3000000000", "discount_pc": "12.5", "is_on_sale": "yes", "obs_date": "soon", "hype_score": "1e3"}
    df = read_market_csv(spark, folder(tmp_dir, [{}] * 20_000, [{}] * 50 + [last]), infer_schema=True)
    types = dict(df.dtypes)
    assert [types[c] for c in ("concurrent_players", "discount_pc", "is_on_sale", "obs_date", "hype_score")] == ["bigint", "double", "string", "string", "double"]
    assert df.count() == 20_051 and df.where("concurrent_players > 2147483647").count() == 1
    # Cleaning gives the curated types all the same: what does not fit is NULL.
    clean = clean_market(df)
    row = clean.where("concurrent_players is null").collect()
    assert dict(clean.dtypes)["concurrent_players"] == "int" and len(row) == 1 and row[0].obs_date is None and row[0].is_on_sale is None and row[0].discount_pc == 12.5
    assert clean.where("concurrent_players = 1500").first().obs_date == dt.date(2024, 3, 1)


def test_inferred_and_declared_types_clean_alike(spark):
    found = market_csv_inferred(spark, SF_SMALL)
    assert found.select("types").distinct().count() == 1
    one, other = clean_market(found.drop("types")), clean_market(testdata.market_raw(spark, SF_SMALL))
    assert one.dtypes == other.dtypes and one.exceptAll(other).count() == other.exceptAll(one).count() == 0
