"""Rule-based quality flags: an ordered rule list, first match wins.

``quality_flag(rules)`` folds the list into one chained CASE expression, so a
flag costs one projection inside the scan's whole-stage-codegen span. The
nine rule sets mirror the silver layer. Rules test the *raw* input columns
(as the silver SQL does: raw ``sp`` is flagged although the output reads
``SP``) unless ``normalize=True``, where the rule sees the cleaned value.

Rules that a null-key filter of the same dataset makes unreachable are not
listed (the silver functions always apply that filter first).

The labels are fixed values (they must equal the source's labels); ``overflow_*`` and
``unparsable_score`` are additions for values that a cast would lose, tested after the
source's rules. ``malformed_record``, for what the reader could not parse, comes before
them all: the fields of such a row are NULL or out of place, so a rule on NULL would
name the wrong fault.

NULL semantics are SQL's: ``NULL NOT IN (...)`` and ``NULL < 0`` are unknown,
so such a rule does not fire and the row stays ``valid``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from ..functions.cleaning import cast_money, cast_score, clean_lower, clean_upper, string_len
from ..sources.files import CORRUPT_RECORD
from .filters import outside_range

VALID = "valid"


def quality_flag(rules: list[tuple[Column, str]], valid: str = VALID) -> Column:
    """CASE WHEN p1 THEN l1 WHEN p2 THEN l2 ... ELSE 'valid' END."""
    if not rules:
        return F.lit(valid)
    expr = None
    for pred, label in rules:
        expr = F.when(pred, label) if expr is None else expr.when(pred, label)
    return expr.otherwise(valid)


def _state_zip_rules(state: str, zipc: str, normalize: bool) -> list:
    st = clean_upper(state) if normalize else F.col(state)
    return [
        (~st.isin(*C.STATE_CODES), "invalid_state"),
        (string_len(zipc) < 4, "invalid_zipcode"),
    ]


def customer_rules(normalize: bool = False) -> list:
    return _state_zip_rules("customer_state", "customer_zip_code_prefix", normalize)


def seller_rules(normalize: bool = False) -> list:
    return _state_zip_rules("seller_state", "seller_zip_code_prefix", normalize)


def geolocation_rules() -> list:
    lat, lng = F.col("geolocation_lat"), F.col("geolocation_lng")
    return [
        (lat.isNull() | lng.isNull(), "missing_coordinates"),
        (outside_range("geolocation_lat", C.LAT_MIN, C.LAT_MAX), "invalid_latitude"),
        (outside_range("geolocation_lng", C.LNG_MIN, C.LNG_MAX), "invalid_longitude"),
    ]


def order_rules() -> list:
    return [
        (F.col("order_purchase_timestamp").isNull(), "missing_purchase_date"),
        (~clean_upper("order_status").isin(*C.ORDER_STATUSES), "invalid_status"),
    ]


def lost_in_cast(column: str, cast) -> Column:
    """A value is there, but the cast has no room for it or cannot read it."""
    return F.col(column).isNotNull() & cast(column).isNull()


def malformed_rules(df) -> list:
    """Rows of which the reader could not parse a field (see
    ``sources.files.csv_scan_permissive``), where the input says so."""
    if CORRUPT_RECORD not in df.columns:
        return []
    return [(F.col(CORRUPT_RECORD).isNotNull(), "malformed_record")]


def order_item_rules() -> list:
    return [
        (F.col("price") < 0, "negative_price"),
        (F.col("freight_value") < 0, "negative_freight"),
        (lost_in_cast("price", cast_money), "overflow_price"),
        (lost_in_cast("freight_value", cast_money), "overflow_freight"),
    ]


def payment_rules(normalize: bool = False) -> list:
    pt = clean_lower("payment_type") if normalize else F.col("payment_type")
    return [
        (F.col("payment_value") < 0, "invalid_payment_value"),
        (~pt.isin(*C.PAYMENT_TYPES), "invalid_payment_type"),
        (lost_in_cast("payment_value", cast_money), "overflow_payment_value"),
    ]


def review_rules() -> list:
    # The raw score is compared with integers: a numeric string compares by
    # value; a non-numeric one, which the source's cast would fail on, has a
    # label of its own.
    score = F.col("review_score").try_cast("int")
    return [
        (F.col("order_id").isNull(), "invalid_null_order_id"),
        (~score.isin(*C.REVIEW_SCORES), "invalid_score"),
        (lost_in_cast("review_score", cast_score), "unparsable_score"),
    ]


def product_rules() -> list:
    cat = F.col("product_category_name")
    return [
        (cat.isNull() | (F.trim(cat) == ""), "missing_category"),
        (F.col("product_weight_g") < 0, "negative_weight"),
        (F.col("product_length_cm") < 0, "negative_length"),
        (F.col("product_height_cm") < 0, "negative_height"),
        (F.col("product_width_cm") < 0, "negative_width"),
    ]


def category_rules() -> list:
    return [
        (F.trim("product_category_name") == "", "invalid_empty_name"),
        (F.trim("product_category_name_english") == "", "invalid_empty_english"),
    ]
