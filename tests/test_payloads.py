import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from larkspur.functions import payloads as P


def ask(spark, column, payload):
    text = payload if payload is None or isinstance(payload, str) else json.dumps(payload)
    return spark.createDataFrame([(text,)], "p string").select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("payload,want", [({"low": 1}, 1.0), ({"low": "1.5", "market": 2.5}, 2.5), ({"low": True}, 1.0), ({"low": None, "market": 0}, 0.0), ({}, None), (None, None), ("not json", None), ({"low": 1e300}, 1e300)])
def test_first_number(spark, payload, want):
    assert ask(spark, P.first_number(F.col("p"), ["low", "market"]), payload) == want


def test_best_variant_prefers(spark):
    best = P.best_variant(F.col("p"))
    direct = ask(spark, best, {"market": 1, "normal": {"market": 2}})
    assert direct["name"] is None and json.loads(direct["json"])["market"] == 1
    assert ask(spark, best, {"holofoil": {"market": 3}, "reverse": {"low": 1}})["name"] == "reverse"
    assert ask(spark, best, {"normal": {"market": "3"}, "zeta": {"low": 1}, "alpha": {"low": 1, "market": 2}})["name"] == "alpha"
    assert ask(spark, best, {"zeta": {"low": 1}, "alpha": {"low": 2}})["name"] == "zeta", "equal scores keep the order of the text"
    assert ask(spark, best, {"normal": {}}) is None
    assert ask(spark, best, None) is None


def test_usd_source(spark):
    s = ask(spark, P.usd_source(F.col("p")), {"updatedAt": " 2026/04/06 ", "prices": {"holofoil": {"market": 2.2}}})
    assert (s["unit"], s["updated"], s["variant_name"]) == ("USD", "2026/04/06", "holofoil")
    s = ask(spark, P.usd_source(F.col("p")), {"unit": "CAD", "normal": {"market": 1, "updated": "2026/01/01"}})
    assert (s["unit"], s["updated"]) == ("CAD", "2026/01/01")
    s = ask(spark, P.usd_source(F.col("p")), {"prices": {"zeta": {"low": 1}, "alpha": {"low": 2}}})
    assert s["variant_name"] == "zeta", "the order of the text holds inside members too"
    assert ask(spark, P.usd_source(F.col("p")), {"prices": {}}) is None


def test_eur_source(spark):
    s = ask(spark, P.eur_source(F.col("p")), {"updated": "", "avg": 1.5})
    assert (s["unit"], s["updated"]) == ("EUR", None)
    assert ask(spark, P.eur_source(F.col("p")), {"avg": "1.5"}) is None


def test_bulk_price_zero_falls_through(spark):
    assert ask(spark, P.bulk_price(F.col("p")), {"prices": {"market": 0, "mid": 3, "low": 1}})["market"] == 3.0
    assert ask(spark, P.bulk_price(F.col("p")), {"prices": {"market": 0, "mid": 0}})["market"] == 0.0
    only = ask(spark, P.bulk_price(F.col("p")), {"prices": {"market": "x", "mid": 3, "low": 1}})
    assert only["market"] is None and only["low"] == 1.0 and only["updated"] is None
    assert ask(spark, P.bulk_price(F.col("p")), {"prices": {"high": 3}}) is None
    assert ask(spark, P.bulk_price(F.col("p")), {"prices": 3}) is None


def test_condition_price(spark):
    p = P.condition_price(F.col("p"))
    assert ask(spark, p, {"prices": {"tcgplayer": {"NEAR_MINT": {"avg": 45.61, "low": 40}}}, "lastUpdated": "2026/01/01"})["market"] == 45.61
    assert ask(spark, p, {"prices": {"tcgplayer": {"LIGHT": {"avg": 2}, "HEAVY": {"avg": 1}}}})["market"] == 2.0
    assert ask(spark, p, {"prices": {"tcgplayer": {"NEAR_MINT": {}}, "ebay": {"near_mint": {"avg": 0, "market": 5}}}})["market"] == 5.0
    assert ask(spark, p, {"prices": {}}) is None


def test_variants_price(spark):
    card = {"variants": [{"prices": [{"currency": "usd", "low": 2, "market": 3}, {"currency": "EUR", "low": 1}]}, {"prices": [{"currency": "USD", "low": 1.5, "market": 5, "high": 9}]}]}
    r = ask(spark, P.variants_price(F.col("p")), card)
    assert (r["low"], r["market"], r["high"]) == (1.5, 5.0, 9.0)
    r = ask(spark, P.variants_price(F.col("p")), {"market": 4, "low": 2})
    assert (r["low"], r["market"], r["high"]) == (2.0, 4.0, None)


@pytest.mark.parametrize("text,want", [("2026-04-06T01:02:03.5Z", dt.datetime(2026, 4, 6, 1, 2, 3, 500000)), ("2026-04-06T01:02:03Z", dt.datetime(2026, 4, 6, 1, 2, 3)), ("2026/4/6", dt.datetime(2026, 4, 6)), ("2026/04/06 07:08:09", dt.datetime(2026, 4, 6, 7, 8, 9)), ("  ", None), ("junk", None), (None, None)])
def test_dates(spark, text, want):
    df = spark.createDataFrame([(text,)], "p string")
    row = df.select(P.parse_updated(F.col("p")).cast("timestamp_ntz").alias("x"), P.invalid_updated(F.col("p")).alias("bad")).first()
    assert row["x"] == want and row["bad"] == (text == "junk")


def test_fresh_bounds(spark):
    now = F.lit("2026-04-20").cast("timestamp")
    for text, want in (("2026/04/06", True), ("2026/04/05", False), ("2027/01/01", True), (None, False), ("junk", False)):
        assert ask(spark, P.is_fresh(F.col("p"), now, 14), text) is want
