"""Schemas of the tables at rest and of the records in flight, as DDL."""

CARDS = "id string, locale string, upstream_id string, set_id string, set_name string, card_number string, name string, rarity string, image_url string, image_url_low string, equivalence_key string, hp string"
EMBEDDINGS = "card_id string, model_name string, variant_idx int, variant_tag string, dim int, vector array<float>"
EMBEDDINGS_INT8 = "card_id string, dim int, vector_int8 array<tinyint>"
CARD_EQUIVALENTS = "card_id string, equivalence_key string, upstream_source string, upstream_id string, locale string, set_id string, local_id string"
PRICES = "card_id string, market_code string, currency_code string, source_name string, low_price double, market_price double, high_price double, updated_at string, is_primary int"
MANIFEST = "card_id string, name string, set_name string, number string, image_path string, image_url string, locale string, upstream_id string, set_id string, equivalence_key string"
BENCHMARK_FRAMES = "clip_id string, frame_index int, timestamp_millis long, card_id string, name string, locale string, set_id string, set_name string, number string, image_path string, same_art_key string, equivalence_key string, perturbation_seed long"
LOOKUPS = "card_id string, provider string, found boolean, market_price double, low_price double, high_price double, provider_card_name string, provider_set_name string, latency_ms long, notes string"
SAMPLE_CARDS = "card_id string, name string, set_id string, set_name string, card_number string, gap_group string, stratum string"
GAP_SAMPLE_COLUMNS = ["sample_index", "gap_group", "card_id", "name", "set_id", "set_name", "card_number", "rarity", "source_names", "release_date", "release_bucket", "card_class", "stratum", "notes"]
#: Stored beside each table in a one-row metadata table.
EMBEDDINGS_VERSION, PRICES_VERSION = 6, 2
