"""Registered queries over the price path: payload normalization, selection with reasons, fallbacks, rows, audits.

Payloads are made of `part` rows by one text that Spark and DuckDB read alike; each query's SQL derives its result from the
payload with DuckDB's own JSON functions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import payloads as P
from ..functions import vectors as V
from ..operators import coverage, selection
from . import prices

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


_S, _T = "cast(p_size as string)", "cast(p_size + 3 as string)"
#: Payloads of a US provider: variants, direct prices, text and booleans for numbers, no object, missing, bad, old and blank dates.
_USD = f"""CASE p_partkey % 13
 WHEN 0 THEN concat('{{"updatedAt":"2024/01/05","prices":{{"holofoil":{{"low":', {_S}, ',"market":', {_T}, '.5}},"normal":{{"mid":', {_S}, ',"highPrice":9}}}}}}')
 WHEN 1 THEN concat('{{"updated":"2024/01/05","prices":{{"normal":{{"low":"', {_S}, '","market":"1.5"}}}}}}')
 WHEN 2 THEN NULL
 WHEN 3 THEN '[1,2]'
 WHEN 4 THEN concat('{{"prices":{{"zeta":{{"market":', {_S}, '}},"alpha":{{"low":1,"mid":', {_T}, '}}}}}}')
 WHEN 5 THEN concat('{{"updated":"soon","market":', {_S}, '}}')
 WHEN 6 THEN concat('{{"updated":"2023/12/01","unit":"","low":', {_S}, '}}')
 WHEN 7 THEN concat('{{"updated":"2024-01-05T10:11:12Z","unit":"CAD","directLow":', {_S}, '.25}}')
 WHEN 8 THEN '{{"updated":"2024/01/05 1:2:3","prices":{{"odd":{{"market":true,"low":false}},"reverse":{{"mid":0}}}}}}'
 WHEN 9 THEN concat('{{"updated":"2024/01/05","prices":{{"zeta":{{"market":', {_S}, '}},"alpha":{{"market":', {_T}, '}},"beta":{{"name":"x"}}}}}}')
 WHEN 10 THEN '{{}}'
 WHEN 11 THEN concat('{{"updated":"  ","updatedAt":"2024/01/05","market":', {_S}, '}}')
 ELSE concat('{{"prices":{{"1stEditionNormal":{{"updatedAt":"2024/01/05","averageSellPrice":', {_T}, '}}}}}}') END"""  # fmt: skip
_EUR = f"""CASE p_partkey % 4 WHEN 0 THEN concat('{{"avg":', {_S}, ',"trend":', {_T}, ',"updated":"2024/01/02"}}') WHEN 1 THEN concat('{{"unit":"CHF","prices":{{"lowPrice":', {_S}, ',"avg7":2}}}}')
 WHEN 2 THEN '{{"avg":"3"}}' ELSE NULL END"""
_BULK = f"""CASE p_partkey % 6 WHEN 0 THEN concat('{{"prices":{{"market":0,"mid":', {_S}, ',"high":7}}}}') WHEN 1 THEN concat('{{"prices":{{"market":', {_T}, ',"low":1}}}}') WHEN 2 THEN '{{"prices":{{"market":"2","mid":3}}}}'
 WHEN 3 THEN '{{"prices":{{"low":0.5}}}}' WHEN 4 THEN '{{"prices":{{"high":4}}}}' ELSE NULL END"""
_CONDITION = f"""CASE p_partkey % 6 WHEN 0 THEN concat('{{"lastUpdated":" 2024-01-01 ","prices":{{"tcgplayer":{{"PLAYED":{{"avg":1}},"NEAR_MINT":{{"avg":', {_S}, ',"low":1}}}}}}}}')
 WHEN 1 THEN concat('{{"prices":{{"tcgplayer":{{"PLAYED":{{"avg":0,"market":', {_T}, '}},"A":{{"avg":9}}}},"ebay":{{"NEAR_MINT":{{"avg":8}}}}}}}}') WHEN 2 THEN concat('{{"lastUpdated":"","prices":{{"tcgplayer":{{}},"ebay":{{"near_mint":{{"market":', {_S}, ',"high":3}}}}}}}}')
 WHEN 3 THEN '{{"prices":{{"ebay":{{"NEAR_MINT":{{"high":3}}}}}}}}' WHEN 4 THEN '{{"prices":[]}}' ELSE NULL END"""
_FIELDS = f"p_partkey AS id, {_USD} AS tcgplayer, {_EUR} AS cardmarket, {_BULK} AS bulk, {_CONDITION} AS conditions"


def _cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(*_split(_FIELDS))


def _split(fields: str) -> list[str]:
    """Select items; none of the payload texts has a comma right before a name and AS."""
    import re

    parts = re.split(r" AS (id|tcgplayer|cardmarket|bulk|conditions)(?:, |$)", fields)
    return [f"{e} AS {n}" for e, n in zip(parts[:-1:2], parts[1::2], strict=True)]


def _num(j: str, key: str) -> str:
    """SQL for a member that is a number or a boolean."""
    at = f"'$.\"{key}\"'"
    return f"CASE json_type({j}, {at}) WHEN 'BOOLEAN' THEN (({j}->>{at}) = 'true')::int::double WHEN 'DOUBLE' THEN ({j}->>{at})::double WHEN 'UBIGINT' THEN ({j}->>{at})::double WHEN 'BIGINT' THEN ({j}->>{at})::double END"


def _first(j: str, keys: Sequence[str]) -> str:
    return "coalesce(" + ", ".join(_num(j, k) for k in keys) + ", NULL)"


def _count(j: str) -> str:
    return "(" + " + ".join(f"(({_num(j, k)}) IS NOT NULL)::int" for k in P.TCGPLAYER_KEYS) + ")"


def _text(*items: str) -> str:
    return "nullif(trim(coalesce(" + ", ".join(f"nullif({i}, '')" for i in items) + ")), '')"


def _or(j: str, a: str, b: str) -> str:
    """The first unless it is missing, null, 0 or empty; then the second."""
    at = f"'$.{a}'"
    return f"CASE WHEN coalesce(json_type({j}, {at}), 'NULL') = 'NULL' OR coalesce(({_num(j, a)}) = 0, false) OR ({j}->>{at}) = '' THEN {_num(j, b)} ELSE {_num(j, a)} END"


_WANTED = "[" + ", ".join(f"'{v}'" for v in P.VARIANT_PREFERENCE) + "]"
_USD_SQL = f"""src AS (SELECT {_FIELDS} FROM part),
obj AS (SELECT id, tcgplayer AS p, CASE WHEN json_type(tcgplayer, '$.prices') = 'OBJECT' THEN tcgplayer->'$.prices' ELSE tcgplayer::json END AS inside FROM src WHERE json_type(tcgplayer) = 'OBJECT'),
each AS (SELECT id, unnest(json_keys(inside)) AS k, generate_subscripts(json_keys(inside), 1) AS i, inside FROM obj),
vals AS (SELECT id, k, i, json_extract(inside, '$."' || k || '"') AS v FROM each),
ranked AS (SELECT id, k, v, row_number() OVER (PARTITION BY id ORDER BY coalesce(list_position({_WANTED}, k), 99), CASE WHEN list_contains({_WANTED}, k) THEN 0 ELSE -({_count("v")}) END, CASE WHEN list_contains({_WANTED}, k) THEN 0 ELSE -coalesce({_first("v", P.ANCHOR_KEYS)}, 0) END, i) AS rn
  FROM vals WHERE json_type(v) = 'OBJECT' AND {_count("v")} > 0),
best AS (SELECT o.id, o.p, CASE WHEN {_count("o.inside")} > 0 THEN NULL ELSE r.k END AS variant_name, CASE WHEN {_count("o.inside")} > 0 THEN o.inside ELSE r.v END AS v FROM obj o LEFT JOIN ranked r ON r.id = o.id AND r.rn = 1),
usd AS (SELECT id, coalesce(nullif(p->>'$.unit', ''), 'USD') AS unit, {_text("p->>'$.updated'", "p->>'$.updatedAt'", "v->>'$.updated'", "v->>'$.updatedAt'")} AS updated, variant_name,
  {_first("v", P.LOW_KEYS)} AS low, {_first("v", P.MARKET_KEYS)} AS market, {_first("v", P.HIGH_KEYS)} AS high FROM best WHERE v IS NOT NULL)"""
_EUR_SQL = f"""euro AS (SELECT id, cardmarket AS p, CASE WHEN json_type(cardmarket, '$.prices') = 'OBJECT' THEN cardmarket->'$.prices' ELSE cardmarket::json END AS v FROM src),
eur AS (SELECT id, coalesce(nullif(p->>'$.unit', ''), 'EUR') AS unit, {_text("p->>'$.updated'", "p->>'$.updatedAt'")} AS updated,
  {_first("v", P.EURO_LOW_KEYS)} AS low, {_first("v", P.EURO_MARKET_KEYS)} AS market, {_first("v", P.EURO_HIGH_KEYS)} AS high FROM euro WHERE {_first("v", P.CARDMARKET_KEYS)} IS NOT NULL)"""


@query(f"WITH {_USD_SQL} SELECT s.id, unit, updated, variant_name, low, market, high FROM src s LEFT JOIN usd USING (id)")
def usd_normalization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best variant, unit, date and three prices of each US payload; null where it has no price."""
    s = F.col("s")
    rows = _cards(spark, sf_dir).select("id", P.usd_source(F.when(F.schema_of_variant(F.try_parse_json("tcgplayer")).startswith("OBJECT"), F.col("tcgplayer"))).alias("s"))
    three = {n: P.first_number(s["variant"], k) for n, k in (("low", P.LOW_KEYS), ("market", P.MARKET_KEYS), ("high", P.HIGH_KEYS))}
    return rows.select("id", s["unit"].alias("unit"), s["updated"].alias("updated"), s["variant_name"].alias("variant_name"), *[c.alias(n) for n, c in three.items()])


@query(f"WITH {_USD_SQL}, {_EUR_SQL} SELECT s.id, unit, updated, low, market, high FROM src s LEFT JOIN eur USING (id)")
def eur_normalization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit, date and three prices of each European payload."""
    s = F.col("s")
    rows = _cards(spark, sf_dir).select("id", P.eur_source(F.col("cardmarket")).alias("s"))
    three = {n: P.first_number(s["variant"], k) for n, k in (("low", P.EURO_LOW_KEYS), ("market", P.EURO_MARKET_KEYS), ("high", P.EURO_HIGH_KEYS))}
    return rows.select("id", s["unit"].alias("unit"), s["updated"].alias("updated"), *[c.alias(n) for n, c in three.items()])


@query(f"SELECT id, {_count('tcgplayer')} AS keys, coalesce({_first('tcgplayer', P.ANCHOR_KEYS)}, 0) AS anchor FROM (SELECT {_FIELDS} FROM part) WHERE json_type(tcgplayer) = 'OBJECT'")
def variant_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric keys and market anchor of a payload taken as a variant."""
    rows = _cards(spark, sf_dir).where(F.schema_of_variant(F.try_parse_json("tcgplayer")).startswith("OBJECT"))
    return rows.select("id", P.variant_score(F.col("tcgplayer")).alias("s")).select("id", "s.keys", "s.anchor")


_BULK_SQL = f"""(SELECT id, CASE WHEN market IS NOT NULL OR low IS NOT NULL THEN market END AS market, CASE WHEN market IS NOT NULL OR low IS NOT NULL THEN low END AS low, CASE WHEN market IS NOT NULL OR low IS NOT NULL THEN high END AS high
FROM (SELECT id, {_or("j", "market", "mid")} AS market, {_num("j", "low")} AS low, {_num("j", "high")} AS high FROM (SELECT id, bulk->'$.prices' AS j FROM (SELECT {_FIELDS} FROM part))))"""


@query(f"SELECT id, low, market, high FROM {_BULK_SQL}")
def bulk_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set-level provider prices: 0 falls through to mid, text is no number, null without market and low."""
    return _cards(spark, sf_dir).select("id", P.bulk_price(F.col("bulk")).alias("p")).select("id", "p.low", "p.market", "p.high")


def _near(venue: str) -> str:
    at = f"conditions->'$.prices.{venue}'"
    return f"coalesce(nullif({at}->'$.NEAR_MINT', '{{}}'), nullif({at}->'$.near_mint', '{{}}'), nullif(json_extract({at}, '$.' || json_keys({at})[1]), '{{}}'))"


_CONDITION_SQL = f"""(SELECT id, updated, low, market, high FROM (SELECT id, nullif(trim(conditions->>'$.lastUpdated'), '') AS updated, {_or("j", "avg", "market")} AS market, {_num("j", "low")} AS low, {_num("j", "high")} AS high
FROM (SELECT id, conditions, coalesce({_near("tcgplayer")}, {_near("ebay")}) AS j FROM (SELECT {_FIELDS} FROM part))) WHERE market IS NOT NULL OR low IS NOT NULL)"""


@query(f"SELECT id, updated, low, market, high FROM {_CONDITION_SQL}")
def condition_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Condition-level provider prices: near mint, else the first condition, of the first venue that has any."""
    return _cards(spark, sf_dir).select("id", P.condition_price(F.col("conditions")).alias("p")).where("p is not null").select("id", "p.updated", "p.low", "p.market", "p.high")


_NOW = "2024-01-15 00:00:00"


def _selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards named by hundreds of part keys; two of seventeen are not in the provider's listing."""
    cards = _cards(spark, sf_dir).select("id", F.concat(F.lit("zz"), F.floor(F.col("id") / 100).cast("string")).alias("set_id"), (F.col("id") % 100 + 1).cast("string").alias("card_number"), "tcgplayer")
    listing = cards.where("id % 17 > 1").select("set_id", F.col("card_number").alias("number"), "tcgplayer", F.col("id").alias("ord"))
    index = selection.provider_index(listing)
    return selection.select_usd(cards.select("id", "set_id", "card_number"), index, F.lit(_NOW).cast("timestamp"), 14)


_REASON_SQL = f"""{_USD_SQL},
dated AS (SELECT s.id, tcgplayer, u.id IS NOT NULL AS priced, updated, coalesce(try_strptime(updated, '%Y-%m-%dT%H:%M:%SZ'), try_strptime(updated, '%Y/%m/%d %H:%M:%S'), try_strptime(updated, '%Y/%m/%d')) AS stamp FROM src s LEFT JOIN usd u USING (id)),
sel AS (SELECT id, id % 17 > 1 AS matched, CASE WHEN id % 17 <= 1 THEN '{selection.NO_MATCH}' WHEN coalesce(json_type(tcgplayer), '') <> 'OBJECT' THEN '{selection.MISSING_PAYLOAD}' WHEN NOT priced THEN '{selection.NO_NUMBERS}' WHEN updated IS NULL THEN '{selection.NO_DATE}'
  WHEN stamp IS NULL THEN '{selection.BAD_DATE}' WHEN stamp < TIMESTAMP '{_NOW}' - INTERVAL 14 DAY THEN '{selection.OLD_DATE}' END AS reason FROM dated)"""


@query(f"WITH {_REASON_SQL} SELECT id, reason FROM sel")
def select_usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reason why a card gets no US price; null where it gets one."""
    return _selected(spark, sf_dir).select("id", "reason")


_WHY = lambda *r: "count_if(coalesce(reason, '') IN (" + ", ".join(f"'{x}'" for x in r) + "))"


@query(
    f"""WITH {_REASON_SQL} SELECT count(*) AS english_cards_considered, count_if(matched) AS english_cards_with_match, {_WHY(selection.NO_MATCH)} AS english_cards_without_match, count_if(reason IS NULL) AS english_cards_with_tcgplayer,
{_WHY(selection.MISSING_PAYLOAD, selection.NO_NUMBERS)} AS english_cards_without_tcgplayer, 0 AS alias_required_matches, {_WHY(selection.NO_DATE, selection.BAD_DATE, selection.OLD_DATE)} AS stale_tcgplayer_rows,
{_WHY(selection.MISSING_PAYLOAD, selection.NO_NUMBERS, selection.NO_DATE, selection.BAD_DATE, selection.OLD_DATE)} AS stale_or_missing_tcgplayer, {_WHY(selection.NO_DATE)} AS missing_updated_at, {_WHY(selection.BAD_DATE)} AS invalid_updated_at, {_WHY(selection.OLD_DATE)} AS older_than_max_age FROM sel"""
)
def selection_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All counters of the selection."""
    return selection.selection_counters(_selected(spark, sf_dir))


_ROWS_SQL = f"""{_USD_SQL}, {_EUR_SQL},
both_ AS (SELECT id AS card_id, 'US' AS market_code, unit AS currency_code, 'tcgplayer' AS source_name, low AS low_price, market AS market_price, high AS high_price, updated AS updated_at, 1 AS is_primary FROM usd
  UNION ALL SELECT id, 'EU', unit, 'cardmarket', low, market, high, updated, 0 FROM eur),
priced AS (SELECT * EXCLUDE (is_primary), (row_number() OVER (PARTITION BY card_id ORDER BY is_primary DESC, CASE source_name WHEN 'tcgplayer' THEN 0 ELSE 1 END, source_name) = 1)::int AS is_primary FROM both_)"""


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = _cards(spark, sf_dir).withColumn("tcgplayer", F.when(F.schema_of_variant(F.try_parse_json("tcgplayer")).startswith("OBJECT"), F.col("tcgplayer")))
    return selection.embedded_rows(cards)


@query(f"WITH {_ROWS_SQL} SELECT * FROM priced")
def price_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both sources, with one primary a card."""
    return _rows(spark, sf_dir)


@query(f"WITH {_ROWS_SQL} SELECT count(*) AS rows, count_if(coalesce(low_price, market_price, high_price) IS NOT NULL) AS priced_rows, count(DISTINCT card_id) AS cards FROM priced")
def price_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, rows with a price and cards."""
    return coverage.price_totals(_rows(spark, sf_dir))


@query(f"WITH {_REASON_SQL} SELECT id AS card_id, coalesce(reason, '{selection.AFTER_FALLBACK}') AS reason FROM sel WHERE id NOT IN (SELECT id FROM usd WHERE unit = 'USD') ORDER BY id LIMIT 50")
def gap_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 50 cards without a US row in dollars, with their reason."""
    return selection.gap_audit(_selected(spark, sf_dir), _rows(spark, sf_dir), 50).select("card_id", "reason")


@query(
    f"""SELECT id, CASE WHEN b IS NOT NULL THEN 'ppt_bulk' WHEN c IS NOT NULL THEN 'poketrace' END AS transport, coalesce(b, c) AS price FROM (SELECT p.id, coalesce(p.market, p.low) AS b, coalesce(c.market, c.low) AS c FROM {_BULK_SQL} p LEFT JOIN {_CONDITION_SQL} c USING (id))
WHERE b IS NOT NULL OR c IS NOT NULL"""
)
def fallback_transport(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price and transport a card falls back to: the set-level provider, then the condition-level one."""
    rows = _cards(spark, sf_dir).select("id", P.bulk_price(F.col("bulk")).alias("b"), P.condition_price(F.col("conditions")).alias("c"))
    price, transport = selection.fallback_choice(F.col("b"), F.lit(None).cast(rows.schema["b"].dataType), F.col("c"))
    out = rows.select("id", transport.alias("transport"), price.alias("p")).where("p is not null")
    return out.select("id", "transport", F.coalesce("p.market", "p.low").alias("price"))


@query(
    """WITH g AS (SELECT c_custkey AS id, 's' || c_nationkey AS set_id, 'Set ' || c_nationkey AS set_name, (c_custkey % 40)::varchar AS card_number, c_custkey AS ord FROM customer),
slugs AS (SELECT 's' || n_nationkey AS set_id, 'slug' || n_nationkey AS slug FROM nation WHERE n_nationkey % 5 > 0),
other AS (SELECT 'slug' || (s_suppkey % 25) AS slug, (s_suppkey % 40)::varchar AS number, min(s_suppkey % 7 + 1)::double AS market FROM supplier WHERE s_suppkey % 3 > 0 GROUP BY 1, 2)
SELECT id, market AS price, 'poketrace' AS transport FROM g JOIN slugs USING (set_id) JOIN other USING (slug) WHERE number = card_number"""
)
def fallback_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as cards that lack a price, suppliers as answers of the condition-level provider, by mapped set names."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    gaps = read("customer").selectExpr("c_custkey as id", "concat('s', c_nationkey) as set_id", "concat('Set ', c_nationkey) as set_name", "cast(c_custkey % 40 as string) as card_number", "c_custkey as ord")
    slugs = read("nation").where("n_nationkey % 5 > 0").selectExpr("concat('s', n_nationkey) as key", "concat('slug', n_nationkey) as slug")
    answer = "concat('{\"prices\":{\"tcgplayer\":{\"NEAR_MINT\":{\"avg\":', min(s_suppkey % 7 + 1), '}}}}')"
    other = read("supplier").where("s_suppkey % 3 > 0").selectExpr("concat('slug', s_suppkey % 25) as slug", "cast(s_suppkey % 40 as string) as number", "s_suppkey").groupBy("slug", "number").agg(F.expr(answer).alias("card")).withColumn("error", F.lit(False))
    out = prices.fallback_prices(gaps, None, None, other, slugs, None, None)
    return out.select("id", F.col("price.market").alias("price"), "transport")


@query("SELECT vec_id, len(embedding)::int AS dim, substr(sha256(array_to_string(list_transform(embedding, lambda x: (round(x::double * 1000))::bigint), ',')), 1, 12) AS hash_prefix FROM embeddings")
def content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and hash prefix of each vector, over its components in thousandths as text."""
    whole = F.transform("embedding", lambda x: F.round(x.cast("double") * 1000).cast("long").cast("string"))
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return rows.select("vec_id", F.size("embedding").alias("dim"), V.hash_prefix(F.array_join(whole, ",").cast("binary"), 12).alias("hash_prefix"))


@query(
    """SELECT flag, count(*) AS n, array_to_string(list_sort(list(user_id::varchar))[1:5], ',') AS keys FROM (SELECT DISTINCT flag, user_id FROM (SELECT user_id, unnest(list_filter([CASE WHEN s > 95 THEN 'high' END, CASE WHEN n < 5 THEN 'few' END, CASE WHEN n % 2 = 0 THEN 'even' END], lambda x: x IS NOT NULL)) AS flag
FROM (SELECT user_id, count(*) AS n, max(value) AS s FROM events GROUP BY 1))) GROUP BY flag"""
)
def flagged_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by flag: their number and the first five."""
    per = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("user_id").agg(F.count("*").alias("n"), F.max("value").alias("s"))
    return coverage.flagged(per, "user_id", {"high": F.col("s") > 95, "few": F.col("n") < 5, "even": F.col("n") % 2 == 0}, 5).withColumn("keys", F.array_join("keys", ","))


@query(
    """SELECT 'locale' AS dimension, lang AS value, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'reason', source, count(*) FROM documents GROUP BY source
UNION ALL SELECT 'example', doc_id::varchar, row_number() OVER (ORDER BY doc_id) FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 20)"""
)
def skip_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by language and by source, and the first 20."""
    return coverage.skip_report(spark.read.parquet(f"{sf_dir}/documents.parquet"), "lang", "source", "doc_id")


@query("SELECT event_id, coalesce(sum(event_id % 7) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS before FROM events")
def running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running total over all events, in ranges."""
    from ..operators import ranking

    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "value")
    return ranking.running_total(events, ["event_id"], F.col("event_id") % 7, "before").select("event_id", "before")
