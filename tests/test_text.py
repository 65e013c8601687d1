from pyspark.sql import functions as F

from larkspur.functions import text as T


def one(spark, column, **values):
    schema = ", ".join(f"{k} {v[1]}" for k, v in values.items())
    return spark.createDataFrame([tuple(v[0] for v in values.values())], schema).select(column.alias("x")).first()["x"]


def test_slug_and_plain_text(spark):
    assert one(spark, T.slugify(F.col("a")), a=("  Scarlet & Violet--151! ", "string")) == "scarlet-violet-151"
    assert one(spark, T.normalize_text(F.col("a")), a=("Évoli V-MAX", "string")) == "voli v max"
    assert one(spark, T.normalize_text(F.col("a")), a=(None, "string")) == ""


def test_compact_token(spark):
    rows = spark.createDataFrame([("043", "43"), ("TG02", "TG2"), ("SV000", "SV000"), (" 7 ", "7"), ("0", "0"), ("a-1", "a-1")], "a string, b string")
    assert all(r[0] == r[1] for r in rows.select(T.compact_token(F.col("a")), "b").collect())


def test_alias_order(spark):
    keys = one(spark, F.transform(T.candidate_keys(F.col("s"), F.col("n")), T.match_key), s=("swsh09.5", "string"), n=("TG02", "string"))
    assert keys[:4] == ["swsh09.5-TG02", "swsh09.5-TG2", "swsh9.5-TG02", "swsh9.5-TG2"]
    assert keys[4] == "swsh09pt5-TG02" and keys[-1] == "swsh9pt5tg-TG2" and len(keys) == 16
    assert one(spark, F.transform(T.candidate_keys(F.col("s"), F.col("n")), T.match_key), s=("sv10.5b", "string"), n=("157", "string"))[:2] == ["sv10.5b-157", "zsv10pt5-157"]


def test_provider_numbers(spark):
    for raw, want in (("002/165", "2"), ("tg02", "TG02"), ("015a", "15A"), ("", ""), (None, ""), ("000", "0")):
        assert one(spark, T.provider_number(F.col("a")), a=(raw, "string")) == want
    named = T.provider_card_number([F.col("a"), F.col("b")], F.col("n"))
    assert one(spark, named, a=(None, "string"), b=("3/100", "string"), n=("X - 9/9", "string")) == "3"
    assert one(spark, named, a=(None, "string"), b=("", "string"), n=("Infernape - 173/167", "string")) == "173"
    assert one(spark, named, a=(None, "string"), b=(None, "string"), n=(None, "string")) == ""
    assert one(spark, T.provider_set_name(F.col("a")), a=("SV06: Twilight Masquerade", "string")) == "twilight masquerade"


def test_match_needs_a_number(spark):
    m = T.provider_matches(F.col("s"), F.col("no"), F.col("t"), F.col("n"))
    assert one(spark, m, s=("SV1: Base", "string"), no=("2", "string"), t=("base", "string"), n=("002", "string")) is True
    assert one(spark, m, s=("Other", "string"), no=("2", "string"), t=("base", "string"), n=("002", "string")) is False
    assert one(spark, m, s=(None, "string"), no=("", "string"), t=("base", "string"), n=("002", "string")) is False


def test_image_urls(spark):
    u = T.image_urls(F.col("l"), F.col("s"), F.col("p"))
    assert tuple(one(spark, u, l=(None, "string"), s=(None, "string"), p=("https://a/b/", "string"))) == ("https://a/b/high.webp", "https://a/b/low.webp")
    assert tuple(one(spark, u, l=(None, "string"), s=(None, "string"), p=("https://a/b.PNG?x=1", "string"))) == ("https://a/b.PNG?x=1", None)
    assert tuple(one(spark, u, l=("L", "string"), s=(" ", "string"), p=("z", "string"))) == ("L", None)
    assert tuple(one(spark, u, l=(None, "string"), s=(None, "string"), p=(None, "string"))) == ("", None)


def test_damage_attacks_equivalence(spark):
    assert one(spark, T.normalize_damage(F.col("a")), a=("20＋×", "string")) == "20+x"
    attacks = "array<struct<cost:array<string>,damage:string>>"
    assert one(spark, T.attack_signature(F.col("a")), a=([(["Fire", "Water"], "30＋"), (None, None)], attacks)) == "Fire,Water:30+|:"
    assert one(spark, T.attack_signature(F.col("a")), a=(None, attacks)) == ""


def test_classes(spark):
    c = T.card_class(F.col("i"), F.col("s"), F.col("r"))
    assert one(spark, c, i=("SVP", "string"), s=("x", "string"), r=("Ultra Rare", "string")) == "promo"
    assert one(spark, c, i=("sv1", "string"), s=("Black Star Promos", "string"), r=("", "string")) == "promo"
    assert one(spark, c, i=("sv1", "string"), s=("x", "string"), r=("Special illustration rare", "string")) == "alt_art"
    assert one(spark, c, i=("sv1", "string"), s=("x", "string"), r=(None, "string")) == "standard"
    b = T.release_bucket(F.to_date("d"))
    for d, want in (("2024-01-01", "recent"), ("2023-12-31", "modern"), ("2019-12-31", "legacy"), (None, "unknown")):
        assert one(spark, b, d=(d, "string")) == want


def test_ids_and_seed(spark):
    import hashlib

    assert one(spark, T.canonical_id(F.lit("en"), F.col("a"), F.col("b")), a=(" sv01 ", "string"), b=("001", "string")) == "pokemon:en:sv01:001"
    assert one(spark, T.canonical_id(F.lit("en"), F.col("a"), F.col("b")), a=(" ", "string"), b=("001", "string")) is None
    want = int.from_bytes(hashlib.sha256(b"x|2").digest()[:8], "big")
    assert int(one(spark, T.variant_seed(F.col("a"), F.lit(2)), a=("x", "string"))) == want
    assert one(spark, T.locale_of_id(F.col("a")), a=("a:b", "string")) == "unknown"
