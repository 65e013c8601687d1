import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur import schemas
from larkspur.operators import checks
from larkspur.sources import http, images, readers, writers


def lines(path, rows):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in rows) + "\n", encoding="utf-8")
    return str(path)


def test_detail_cache_skips_junk_and_last_wins(spark, tmp_path):
    p = lines(tmp_path / "c.jsonl", [{"locale": "en", "id": "a", "v": 1}, "{broken", "", {"locale": "en", "id": "a", "v": 2}, {"locale": "en", "id": ""}, {"id": "b"}])
    got = readers.detail_cache(spark, p, ["locale", "id"]).collect()
    assert [(r["id"], json.loads(r["line"])["v"]) for r in got] == [("a", 2)]


def test_pages_stop_at_a_short_page(spark, tmp_path):
    pages = [[{"id": "a"}, {"id": "b"}], [{"id": "b"}, {"name": "x"}], [{"id": "c"}], [{"id": "d"}, {"id": "e"}]]
    for i, p in enumerate(pages, 1):
        lines(tmp_path / f"page-{i}.json", [p])
    got = readers.paged_listing(spark, f"{tmp_path}/*.json", 2).collect()
    assert sorted(str(r["id"]) for r in got) == ["None", "a", "b", "c"]


def fake_fetch(url):
    page = int(url.rsplit("=", 1)[1])
    if page == 2 and not fake_fetch.failed:
        fake_fetch.failed = True
        return 503, "", {"Retry-After": "0"}
    return 200, json.dumps({"data": [{"id": f"{page}-{i}"} for i in range(3 if page < 3 else 1)]}), {}


fake_fetch.failed = False


def test_live_listing_pages_and_retries(spark):
    spark.dataSource.register(http.PagedRest)
    df = spark.read.format("paged_rest").option("url", "http://x?page={page}").option("items", "data").option("page_size", "3").option("fetch", "tests.test_sources:fake_fetch").load()
    assert [r["page"] for r in df.orderBy("page", "pos").collect()] == [1, 1, 1, 2, 2, 2, 3]


def test_retry_policy():
    waits, answers = [], [(429, "", {}), (500, "", {"Retry-After": "99"}), (200, "ok", {})]
    assert http.with_retries(lambda u: answers.pop(0), "u", sleep=waits.append, cap=5) == "ok" and waits == [1.0, 5]
    assert http.with_retries(lambda u: (404, "", {}), "u") is None
    with pytest.raises(PermissionError):
        http.with_retries(lambda u: (401, "", {}), "u")
    with pytest.raises(RuntimeError):
        http.with_retries(lambda u: (400, "", {}), "u", sleep=waits.append)


def body_of(url):
    return (404, "", {}) if url.endswith("z") else (200, f"body {url}", {})


def test_only_missing_keys_are_fetched(spark):
    wanted, cached = spark.createDataFrame([("a",), ("b",), ("b",), ("z",)], "k string"), spark.createDataFrame([("a",)], "k string")
    got = http.fetch_missing(wanted, cached, "k", "http://x/{key}", "tests.test_sources:body_of", 2).collect()
    assert [(r["k"], r["body"]) for r in got] == [("b", "body http://x/b")]


def test_cards_are_normalized_or_rejected(spark):
    good = {"id": " base1-1 ", "localId": "1", "set": {"id": "base1", "name": " Base "}, "name": "Alakazam", "rarity": " ", "image": "https://a/b", "hp": 80, "category": "Pokemon", "illustrator": "Ken", "dexId": [65], "types": ["Psychic"], "stage": "Stage2", "retreat": 3, "abilities": [{}], "attacks": [{"cost": ["Psychic"], "damage": "30×"}, {"damage": 20}], "pricing": {"cardmarket": {"avg": 2}}}
    rows = [("en", json.dumps(good)), ("fr", json.dumps({"id": "x", "set": {"id": ""}, "localId": "1"})), ("en", json.dumps({"id": "t-1", "localId": 1, "set": {"id": "t"}, "images": {"small": "s", "large": "l"}}))]
    cards, rejects = readers.normalized_cards(spark.createDataFrame(rows, "locale string, item string"))
    a, b = sorted(cards.collect(), key=lambda r: r["id"])
    assert (a["id"], a["set_name"], a["rarity"], a["image_url"], a["hp"]) == ("pokemon:en:base1:1", "Base", "Unknown", "https://a/b/high.webp", "80")
    assert a["equivalence_key"] == "pokemon:xlocale:pokemon:65:ken:80:psychic:stage2::3:1:psychic:30x|:20"
    assert (b["name"], b["image_url"], b["image_url_low"], b["equivalence_key"]) == ("pokemon:en:t:1", "l", "s", "pokemon:tcgdex:t-1")
    assert [r["reason"] for r in rejects.collect()] == ["missing set.id"]


def test_small_files(spark, tmp_path):
    p = lines(tmp_path / "m.json", [{"a": "x", " ": "y", "b": "", "c": " z "}])
    assert {tuple(r) for r in readers.mapping_file(spark, p).collect()} == {("a", "x"), ("c", "z")}
    assert readers.mapping_file(spark, lines(tmp_path / "n.json", ["[1]"])).count() == 0
    p = lines(tmp_path / "r.csv", ["card_id,provider,found,market_price,notes", "a,p,true,1.5,x", "b,p,False,,error: y"])
    assert [(r["found"], r["market_price"]) for r in readers.lookups_csv(spark, p).orderBy("card_id").collect()] == [(True, 1.5), (False, None)]
    p = lines(tmp_path / "f.jsonl", [{"clip_id": "c", "frame_index": 1, "equivalence_key": "e"}])
    assert readers.benchmark_frames(spark, p).first()["group_key"] == "e"
    p = lines(tmp_path / "man.jsonl", [{"card_id": "a", "name": "n", "image_path": "p", "image_url": "u"}, ""])
    assert readers.manifest(spark, p).where("card_id is not null").count() == 1


def test_targeted_takes_the_first_probe(spark):
    cards = spark.createDataFrame([("a", ["x", "y"]), ("b", ["z"])], "id string, probes array<string>")
    captured = spark.createDataFrame([("y", 1), ("x", 2)], "k string, v int")
    assert [(r["id"], r["probe_pos"], r["v"]) for r in readers.targeted(cards, "id", F.col("probes"), captured, "k").collect()] == [("a", 0, 2)]


def test_publish_is_all_or_nothing(spark, tmp_path):
    path = f"{tmp_path}/out/prices"
    one = spark.createDataFrame([("a", "US", "USD", "tcgplayer", 1.0, 1.0, 1.0, None, 1)], schemas.PRICES)
    check = lambda t, m: checks.check_prices(t, m, schemas.PRICES_VERSION, 1)
    writers.publish(one, path, schemas.PRICES_VERSION, check)
    with pytest.raises(checks.CheckFailed, match="one_primary"):
        writers.publish(one.withColumn("is_primary", F.lit(0)), path, schemas.PRICES_VERSION, check)
    table, meta = writers.read_published(spark, path)
    assert table.first()["is_primary"] == 1 and meta.first()[0] == 2
    writers.publish(one.union(one.withColumn("card_id", F.lit("b"))), path, schemas.PRICES_VERSION, check)
    assert writers.read_published(spark, path)[0].count() == 2
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["prices"]
    assert writers.publish_if_changed("x", "x", lambda: 1 / 0) is False and writers.publish_if_changed("x", None, lambda: None) is True


def test_readers_always_find_a_table_and_conflicts_abort(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    rows = lambda *ks: spark.createDataFrame([(k, 1) for k in ks], "k string, v int")
    keys = lambda: sorted(r["k"] for r in writers.read_published(spark, path)[0].collect())
    writers.publish(rows("a"), path, 1)
    reader = writers.read_published(spark, path)[0]
    commit, seen = writers.manifests.commit, []
    monkeypatch.setattr(writers.manifests, "commit", lambda *a: (seen.append(keys()), commit(*a))[1])
    writers.publish(rows("a", "b"), path, 1)
    assert seen == [["a"]] and keys() == ["a", "b"] and [r["k"] for r in reader.collect()] == ["a"]
    with pytest.raises(writers.Conflict, match="is there already"):
        writers.insert(rows("c", "b"), path, ["k"], 1)
    with pytest.raises(writers.Conflict, match="stands twice"):
        writers.insert(rows("c", "c"), path, ["k"], 1)
    assert keys() == ["a", "b"]

    def beaten(*a):  # another writer is first, once
        monkeypatch.setattr(writers.manifests, "commit", commit)
        writers.insert(rows("x"), path, ["k"], 1)
        return commit(*a)

    monkeypatch.setattr(writers.manifests, "commit", beaten)
    writers.insert(rows("c"), path, ["k"], 1)
    assert keys() == ["a", "b", "c", "x"]
    monkeypatch.setattr(writers.manifests, "commit", lambda *a: False)
    with pytest.raises(writers.Conflict, match="another writer"):
        writers.publish(rows("z"), path, 1)
    monkeypatch.setattr(writers.manifests, "commit", commit)
    assert keys() == ["a", "b", "c", "x"]
    for _ in range(3):
        writers.publish(rows("q"), path, 1)
    assert keys() == ["q"] and len(list((tmp_path / "t" / "versions").iterdir())) == 2


def test_files_and_retention(spark, tmp_path):
    df = spark.createDataFrame([("b", ["x", "y"]), ("a", [])], "k string, names array<string>")
    writers.write_csv(df, f"{tmp_path}/c", ["names", "k"], ["k"])
    text = next((tmp_path / "c").glob("part*")).read_text().split()
    assert text == ["names,k", ",a", '"x,y",b']
    writers.append_cache(None, df, ["k"], f"{tmp_path}/cache")
    writers.append_cache(spark.read.json(f"{tmp_path}/cache"), spark.createDataFrame([("b", []), ("c", [])], df.schema), ["k"], f"{tmp_path}/cache")
    assert sorted(r["k"] for r in spark.read.json(f"{tmp_path}/cache").collect()) == ["a", "b", "c"]
    gone = []
    stale = spark.createDataFrame([("t1", True), ("t2", False)], "tag_name string, stale boolean")
    assert writers.prune(stale, gone.append) == ["t1"] and not gone
    writers.prune(stale, gone.append, dry_run=False)
    assert gone == ["t1"]
    writers.write_summary({"b": 1, "a": 2}, f"{tmp_path}/s.json")
    assert list(json.load(open(f"{tmp_path}/s.json"))) == ["a", "b"]


def decode(content):
    if content.startswith(b"bad"):
        raise ValueError("not a picture")
    return np.frombuffer(content, np.uint8).reshape(40, 30, 3)


def model(batch):
    return batch.reshape(len(batch), -1)[:, :8] * 3


def wrong_model(batch):
    return np.zeros((len(batch), 3))


def test_pictures_are_embedded_in_variants(spark):
    draw = np.random.default_rng(0)
    rows = [(f"c{i}", draw.integers(0, 256, 3600, np.uint8).tobytes()) for i in range(3)]
    df = spark.createDataFrame(rows, "card_id string, content binary")
    got = images.embed(df, "tests.test_sources:decode", "tests.test_sources:model", dim=8, batch=2).collect()
    assert len(got) == 12 and {r["variant_tag"] for r in got} == set(images.VARIANTS)
    assert all(abs(np.linalg.norm(r["vector"]) - 1) < 1e-5 for r in got)
    again = images.embed(df.repartition(3), "tests.test_sources:decode", "tests.test_sources:model", dim=8).collect()
    assert {(r["card_id"], r["variant_idx"]): r["vector"] for r in got} == {(r["card_id"], r["variant_idx"]): r["vector"] for r in again}
    with pytest.raises(Exception, match="the model gave"):
        images.embed(df, "tests.test_sources:decode", "tests.test_sources:wrong_model", dim=8).collect()
    valid = images.validate(spark.createDataFrame([("a", rows[0][1]), ("b", b"bad")], "path string, content binary"), "tests.test_sources:decode").collect()
    assert {r["path"]: r["valid"] for r in valid} == {"a": True, "b": False}


def test_picture_steps():
    a = np.arange(60 * 40 * 3, dtype=np.uint8).reshape(60, 40, 3)
    assert images.crop_inset(a).shape == (52, 34, 3) and images.base_image(a).shape == (224, 224, 3)
    assert (images.resize(a, 60, 40) == a).all() and images.longest_edge(a, 30).shape == (30, 20, 3)
    base = images.base_image(a)
    for tag in images.VARIANTS[1:]:
        one, two = (images.variant(base, tag, np.random.default_rng(5)) for _ in range(2))
        assert one.shape == base.shape and (one == two).all() and (one != base).any()
    assert images.perturb(base, np.random.default_rng(1)).shape == base.shape
    assert images.frame_pixels(a).shape == (64,)


def cursor_fetch(url):
    """Cursors a, b, c and then a again; the flag ends it earlier where it is asked for."""
    after = {"": "a", "a": "b", "b": "c", "c": "a"}
    at = url.split("cursor=")[1].split("&")[0]
    return 200, json.dumps({"data": {"rows": [{"id": f"row{at}"}]}, "pagination": {"nextCursor": after[at], "hasMore": at != "b"}}), {}


def total_fetch(url):
    assert url.endswith("&select=id,number")
    page = int(url.split("page=")[1].split("&")[0])
    return 200, json.dumps({"totalCount": 4, "data": [{"id": f"{page}-{i}"} for i in range(2)]}), {}


def test_nested_cursors_cycles_and_totals(spark):
    listing = lambda **o: [json.loads(r["item"])["id"] for r in spark.read.format("paged_rest").options(**o).load().orderBy("page", "pos").collect()]
    by_cursor = {"url": "http://x?cursor={cursor}", "items": "data.rows", "cursor": "pagination.nextCursor", "fetch": "tests.test_sources:cursor_fetch"}
    assert listing(**by_cursor) == ["row", "rowa", "rowb", "rowc"]
    assert listing(**by_cursor, more="pagination.hasMore") == ["row", "rowa", "rowb"]
    assert listing(url="http://x?page={page}", items="data", page_size="2", total="totalCount", select="id,number", fetch="tests.test_sources:total_fetch") == ["1-0", "1-1", "2-0", "2-1"]


def test_locales():
    assert readers.parse_locales(" ") == readers.parse_locales(None) == ("en",) and readers.parse_locales("ja, en ,ja", ("en", "ja")) == ("ja", "en")
    for bad in (" , ,", "xx", "en,xx"):
        with pytest.raises(ValueError):
            readers.parse_locales(bad)
