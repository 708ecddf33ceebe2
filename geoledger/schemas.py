"""Column layouts shared by sources and operators (DDL text accepted by every Spark reader)."""

from geoledger.constants import CATEGORIES, SCORES

GEOMETRY = "array<array<array<struct<x:double,y:double>>>>"  # polygons > rings > points

TRANSACTIONS = (
    "tx_id string, tx_date date, price double, postal_code string, city_id string, city_name string, "
    "parcel_id string, built_area double, land_area double, lat double, lon double"
)

# One GeoJSON line holds one FeatureCollection; coordinates stay text until the type is known.
FEATURE_COLLECTION = (
    "type string, features array<struct<type:string,"
    "properties:struct<code:string,nom:string,departement:string,region:string>,"
    "geometry:struct<type:string,coordinates:string>>>"
)

_scores = ",".join(f"{name}:double" for name in SCORES)
_categories = ",".join(f"{name}:double" for name in CATEGORIES)

CITY_DOCUMENTS = (
    "city_id string, name string, postal_code string, insee_code string, department_id string, "
    f"url string, scores struct<{_scores}>, review_count bigint, status string, processed_at timestamp"
)
REVIEW_DOCUMENTS = (
    "review_id string, city_id string, url string, author string, review_date string, score double, "
    f"scores struct<{_categories}>, description string, thumbs_up bigint, thumbs_down bigint, "
    "status string, processed_at timestamp"
)
WORDS = "array<struct<word:string,weight:bigint>>"
SENTIMENT = (
    "struct<positive:bigint,neutral:bigint,negative:bigint,"
    "positive_percent:double,neutral_percent:double,negative_percent:double>"
)
CITY_WORD_DOCUMENTS = f"city_id string, city_name string, words {WORDS}, sentiment {SENTIMENT}"
LEXICON = "token string, lemma string, pos string, is_stop boolean"

# CSV header -> column of TRANSACTIONS.
TRANSACTION_HEADER = {
    "id_mutation": "tx_id",
    "date_mutation": "tx_date",
    "valeur_fonciere": "price",
    "code_postal": "postal_code",
    "code_commune": "city_id",
    "nom_commune": "city_name",
    "id_parcelle": "parcel_id",
    "surface_reelle_bati": "built_area",
    "surface_terrain": "land_area",
    "latitude": "lat",
    "longitude": "lon",
}
