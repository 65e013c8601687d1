import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from larkspur import schemas
from larkspur.functions import text as T
from larkspur.operators import checks, selection
from larkspur.plans import corpus, gaps, prices
from larkspur.sources import writers

NOW = dt.datetime(2026, 4, 20)
CARD = "id string, locale string, set_id string, set_name string, card_number string, name string, pricing string, ord int"


def card(n, set_id="sv1", number=None, locale="en", pricing=None, set_name="Base"):
    return (f"pokemon:{locale}:{set_id}:{n}", locale, set_id, set_name, number or str(n), f"N{n}", json.dumps(pricing) if pricing else None, n)


def payload(market=1.5, updated="2026/04/10", **more):
    return json.dumps({"updatedAt": updated, "prices": {"normal": {"market": market, "low": 1, "high": 3}}, **more})


@pytest.fixture
def build(spark):
    cards = [card(1), card(2, number="002"), card(3), card(4), card(5), card(6), card(7), card(8, locale="fr", pricing={"cardmarket": {"avg": 2.5, "trend": 3, "updated": "x"}}), card(9, locale="fr")]
    provider = [("sv1", "1", payload(), 0), ("sv1", "2", payload(9.0), 1), ("sv1", "3", payload(updated="2026/04/05"), 2), ("sv1", "4", payload(updated="soon"), 3), ("sv1", "5", json.dumps({"prices": {}}), 4), ("sv1", "6", None, 5), ("sv1", "1", payload(77.0), 6)]
    return spark.createDataFrame(cards, CARD), spark.createDataFrame(provider, "set_id string, number string, tcgplayer string, ord int")


def test_reasons_rows_and_counters(build):
    b = prices.build_prices(*build, NOW)
    rows = {(r["card_id"].split(":")[-1], r["source_name"]): r for r in b.rows.collect()}
    assert {k: (r["market_price"], r["is_primary"]) for k, r in rows.items()} == {("1", "tcgplayer"): (1.5, 1), ("2", "tcgplayer"): (9.0, 1), ("8", "cardmarket"): (2.5, 1)}
    assert {r["id"].split(":")[-1]: r["reason"] for r in b.selected.collect()} == {"1": None, "2": None, "3": selection.OLD_DATE, "4": selection.BAD_DATE, "5": selection.NO_NUMBERS, "6": selection.MISSING_PAYLOAD, "7": selection.NO_MATCH}
    c = b.counters.first()
    assert (c["english_cards_considered"], c["english_cards_with_match"], c["alias_required_matches"], c["stale_tcgplayer_rows"], c["stale_or_missing_tcgplayer"], c["english_cards_without_tcgplayer"]) == (7, 6, 1, 2, 4, 2)
    cover = {r["group"]: r for r in b.coverage.collect()}
    assert (cover["en"]["cards_total"], cover["en"]["cards_with_tcgplayer"], cover["en"]["cards_without_prices"]) == (7, 2, 5) and cover["fr"]["cards_primary_cardmarket"] == 1
    assert [r["card_id"].split(":")[-1] for r in b.gaps.collect()] == ["3", "4", "5", "6", "7"]


def test_fallbacks_in_their_order(spark, build):
    bulk = spark.createDataFrame([("Base", json.dumps({"name": "N3 - 3/9", "prices": {"market": 0, "mid": 4}}), 0), ("Base", json.dumps({"number": "3", "prices": {"market": 9}}), 1)], "set_name string, card string, ord int")
    single = spark.createDataFrame([("pokemon:en:sv1:4", 0, json.dumps({"cardNumber": "44", "prices": {"market": 1}}), False), ("pokemon:en:sv1:4", 1, json.dumps({"cardNumber": "4", "set": "SV: Base", "prices": {"market": 5}}), False)], "id string, pos int, card string, error boolean")
    other = spark.createDataFrame([("base", "5", json.dumps({"prices": {"ebay": {"NEAR_MINT": {"avg": 6}}}}), False)], "slug string, number string, card string, error boolean")
    slugs = spark.createDataFrame([("sv1", "base")], "key string, slug string")
    b = prices.build_prices(*build, NOW, bulk=bulk, single=single, other=other, slugs=slugs)
    got = {r["card_id"].split(":")[-1]: (r["market_price"], r["updated_at"]) for r in b.rows.collect()}
    assert got["3"] == (4.0, None) and got["4"] == (5.0, None) and got["5"] == (6.0, None)
    assert {(r["transport"], r["n"]) for r in b.transports.collect()} == {("pokemontcgio", 2), ("ppt_bulk", 1), ("ppt", 1), ("poketrace", 1), ("tcgdex", 1)}
    none = prices.build_prices(*build, NOW, bulk=bulk, single=single, other=other, slugs=slugs, max_fallback_cards=0)
    assert none.rows.count() == 3


def test_reused_rows_and_publication(spark, build, tmp_path):
    seed = spark.createDataFrame([("pokemon:en:sv1:7", "US", "USD", "tcgplayer", 1.0, 8.0, 9.0, "2026/04/10", 0)], schemas.PRICES)
    b = prices.build_prices(*build, NOW, seed=seed, reuse_prefix="2026/04/10")
    kept = b.rows.where(F.col("card_id") == "pokemon:en:sv1:7").first()
    assert (kept["market_price"], kept["is_primary"]) == (8.0, 1)
    prices.publish_prices(b, f"{tmp_path}/p", 3, build[0])
    with pytest.raises(checks.CheckFailed, match="row_count"):
        prices.publish_prices(b, f"{tmp_path}/p", 1000)
    s = prices.summarize(b)
    assert s["rows"] == 4 and len(s["content_hash"]) == 64 and s["coverage_by_locale"]["en"]["cards_with_tcgplayer"] == 3
    assert {r["group"] for r in prices.inspect(b.rows).collect()} == {"en", "fr"}


def cards12(spark):
    rows = [(f"pokemon:en:s{i % 3}:{i}", "en", f"u{i}", f"s{i % 3}", "Promo" if i % 5 == 0 else "Base", str(i), f"n{i}", "Ultra Rare" if i % 4 == 1 else "Common", "url", None, f"k{i // 2}", None, "tcgdex") for i in range(12)]
    return spark.createDataFrame(rows, schemas.CARDS + ", upstream_source string")


def test_corpus_tables_are_checked_and_published(spark, tmp_path):
    import numpy as np

    cards = cards12(spark)
    draw = np.random.default_rng(0)
    e = corpus.expand_variants(cards).select("id", "variant_idx", "variant_tag").collect()
    unit = lambda: (lambda v: (v / np.linalg.norm(v)).tolist())(draw.normal(size=8))
    emb = spark.createDataFrame([(r["id"], "m", r["variant_idx"], r["variant_tag"], 8, unit()) for r in e], schemas.EMBEDDINGS)
    nothing = {n: spark.createDataFrame([], s) for n, s in (("cards", schemas.CARDS + ", upstream_source string"), ("embeddings", schemas.EMBEDDINGS), ("embeddings_int8", schemas.EMBEDDINGS_INT8), ("card_equivalents", schemas.CARD_EQUIVALENTS))}
    tables = corpus.merge_corpus(nothing, cards, emb)
    corpus.publish_corpus(tables, f"{tmp_path}/c", 12)
    assert writers.read_published(spark, f"{tmp_path}/c/embeddings_int8")[0].count() == 12
    again = corpus.merge_corpus(tables, cards.withColumn("name", F.lit("new")), emb)
    assert again["cards"].where("name = 'new'").count() == 0 and again["embeddings"].count() == 48
    broken = dict(tables, embeddings=emb.where("variant_idx < 3"))
    with pytest.raises(checks.CheckFailed, match="variants"):
        corpus.publish_corpus(broken, f"{tmp_path}/c", 12)
    with pytest.raises(Exception, match="dimension of"):
        corpus.int8_table(emb.withColumn("dim", F.lit(9))).collect()


def test_manifests(spark):
    records = corpus.training_manifest(cards12(spark), spark.createDataFrame([(f"pokemon:en:s{i % 3}:{i}", f"/p/{i}") for i in range(11)], "id string, image_path string"))
    assert records.count() == 11
    frames = corpus.benchmark_manifest(records, max_clips=8, frames=3, ratio=0.5)
    # four of five pairs give one clip each, then the only singleton, then the two of the last pair
    assert frames.count() == 21 and frames.select("clip_id").distinct().count() == 7
    assert frames.where("frame_index = 2").select("timestamp_millis").distinct().collect() == [(200,)]
    assert corpus.subset_manifest(records, 4).count() == 4
    s = corpus.split(records, 0.25).groupBy("is_validation").count().collect()
    assert {r[0]: r[1] for r in s} == {True: 2, False: 9}


def test_status_reconciliation_releases(spark):
    cards = spark.createDataFrame([("a", "en", "u"), ("b", "en", " "), ("c", "en", "u"), ("d", "ja", "u")], "id string, locale string, image_url string")
    status = corpus.image_status(cards, spark.createDataFrame([("c", "timeout")], "id string, error string"), spark.createDataFrame([("a", True)], "id string, valid boolean"))
    assert {r["id"]: r["reason"] for r in status.collect()} == {"a": None, "b": "missing_image_url", "c": "download_failed", "d": "invalid_image"}
    emb = spark.createDataFrame([("a",)], "card_id string")
    counts = corpus.reconciliation(cards, emb, status.where("reason is not null"))
    assert {tuple(r) for r in counts.collect()} == {("en", 3, 1, 2), ("ja", 1, 0, 1)}
    checks.enforce(checks.check_reconciled(counts, "detailed", ["embedded", "skipped"], "locale"))
    rel = spark.createDataFrame([(f"embeddings-v{i}", f"2026-01-0{i}", None) for i in range(1, 6)] + [("other", "2020", None)], "tag_name string, published_at string, created_at string")
    assert sorted(r["tag_name"] for r in corpus.stale_releases(rel).where("stale").collect()) == ["embeddings-v1", "embeddings-v2"]


def test_gap_plan(spark):
    cards = cards12(spark)
    priced = spark.createDataFrame([("pokemon:en:s0:0", "tcgplayer"), ("pokemon:en:s1:1", "cardmarket"), ("pokemon:en:s2:2", "cardmarket"), ("pokemon:en:s2:2", "tcgplayer")], "card_id string, source_name string")
    sets = spark.createDataFrame([("s0", "2024-1-1"), ("s1", None)], "set_id string, release_date string")
    pop = gaps.gap_population(cards, priced, sets, pinned=("pokemon:en:s1:7",))
    got = {r["card_id"]: (r["gap_group"], r["stratum"]) for r in pop.collect()}
    assert len(got) == 10 and got["pokemon:en:s1:1"] == ("cardmarket_only", "unknown:alt_art") and got["pokemon:en:s0:3"] == ("missing", "recent:standard")
    sample = gaps.gap_sample(pop, 4, pinned=("pokemon:en:s1:7",)).collect()
    assert len(sample) == 5 and sample[-1]["card_id"] == "pokemon:en:s1:7" or sample[1]["card_id"] == "pokemon:en:s1:7"
    total = {(r["dimension"], r["value"]): r["n"] for r in gaps.population_summary(pop).collect()}
    assert total["all", ""] == 10 and total["release_bucket", "recent"] == 3


def test_scorecard_of_lookups(spark):
    rows = [("a", "p", True, 1.0, "x"), ("b", "p", False, None, "error: z"), ("c", "p", True, None, "no set mapping"), ("d", "q", None, None, None)]
    df = spark.createDataFrame(rows, "card_id string, provider string, found boolean, market_price double, notes string")
    got = {r["provider"]: (r["cards_found"], r["cards_with_price"], r["errors"], r["set_mapping_failures"], r["coverage_rate"]) for r in gaps.provider_scorecard(df).collect()}
    assert got == {"p": (2, 1, 1, 1, 66.7), "q": (0, 0, 0, 0, 0.0)}


def test_retrieval_plan(spark):
    refs = spark.createDataFrame([("a", [1.0, 0.0], "Pika", "k1"), ("b", [0.9, 0.1], "Pika", "k1"), ("c", [0.0, 1.0], "Evo", "k2")], "card_id string, vector array<float>, name string, group_key string")
    asked = spark.createDataFrame([(1, "b", [1.0, 0.0], "pika", "en", "k1"), (2, "c", [0.0, 1.0], "Evo", " ", "k2"), (3, "zz", [0.5, 0.5], "none", None, "k9")], "query_id int, card_id string, vector array<float>, name string, locale string, group_key string")
    total, by_locale, rows, _ = gaps.evaluate_retrieval(asked, refs)
    m = total.first()
    assert (m["sample_count"], round(m["recall_at_1"], 3), round(m["same_art_top1_confusion_rate"], 3), m["mean_rank"]) == (3, 0.333, 0.333, (2 + 1 + 4) / 3)
    assert {r["locale"] for r in by_locale.collect()} == {"en", "unknown"}
    assert T.STRATA[0] == "recent:promo"
