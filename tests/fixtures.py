"""Small inputs in the shapes of the production data."""

from __future__ import annotations

from acreage import contract as C

LOOKUP = [
    ("Z", "01", "09007", "09007010", "連江縣", "南竿鄉"), ("K", "02", "10005", "10005020", "苗栗縣", "頭份市"),
    ("A", "01", "63000", "63000010", "臺北市", "松山區"), ("I", "01", "10020", "10020010", "嘉義市", "東區")
]
ALIASES = [("K", "頭份鎮", "頭份市")]
BASE = dict(
    no="", trans_y=112, trans_m=1, trans_d=15, county="連江縣", countycd="Z", town="南竿鄉", type=C.HOUSE, trans_landsize=50.0, usage_type="住", nonurban_type="", building_type=C.BUILDING_TYPES[0], usage="住家用",
    date_complete="1000101", trans_size=100.0, room=3, hall=2, bath=2, manage="有", housing_totprice=10_000_000.0, h_price_m2=100_000.0, parking_size=0.0, parking_price=0.0, note="",
)
KINDS = {
    "int": ("trans_y", "trans_m", "trans_d", "room", "hall", "bath"),
    "double": ("trans_landsize", "trans_size", "housing_totprice", "h_price_m2", "parking_size", "parking_price")
}
EDITS = [
    dict(no="VALID", h_price_m2=100_000.25), dict(
        no="BAD_DAY", trans_m=2, trans_d=30, housing_totprice=0.0
    ), dict(no="LAND", type=C.LAND, note=" 備註 "), dict(no="ALIAS", countycd="K", town="頭份鎮", type=C.LAND),
    dict(
        no="PARKING", type=C.HOUSE_PARKING, parking_size=10.0, parking_price=500_000.0
    ), dict(no="EXACT"), dict(no="EXACT"), dict(no="CONFLICT"), dict(no="CONFLICT", housing_totprice=9_000_000.0),
    dict(no="  ", trans_y=100), dict(
        no="INVALID_PERIOD", trans_y=100
    ), dict(no="UNMAPPED", town=""), dict(no="EXCLUDED_TYPE", type="車位"),
]


def lookup(spark):
    from acreage.sources.reference import LOOKUP as NAMES

    return spark.createDataFrame(LOOKUP, ", ".join(f"{c} string" for c in NAMES))


def aliases(spark):
    return spark.createDataFrame(ALIASES, "legacy_county_code string, raw_town string, normalized_town string")


def raw(spark, edits=EDITS):
    kind = {c: k for k, cs in KINDS.items() for c in cs}
    schema = ", ".join(["_row_pos long", *[f"{c} {kind.get(c, 'string')}" for c in C.RAW_COLUMNS]])
    return spark.createDataFrame([(k + 1, *[(BASE | e)[c] for c in C.RAW_COLUMNS]) for k, e in enumerate(edits)], schema)
