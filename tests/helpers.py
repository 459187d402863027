"""Hand-made listing rows for edge-case tests."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from vitrine.sources.schema import LISTING_SCHEMA

_DEFAULT = {
    "id": None, "type": "t", "name": "red ring", "description": None, "keywords": "red ring",
    "gender_target": "Women", "category": "C", "season": "Q1", "condition": "new",
    "like_count": 1.0, "material": "ring", "color": "red", "price_usd": Decimal("10"),
    "brand": "B", "sold": True, "reserved": False, "available": False,
    "seller_id": "s1", "username": "u1", "country": "X", "seller_price": Decimal("10"),
    "earning": Decimal("5"), "products_sold": 1, "num_products_listed": 1, "community_rank": None,
    "num_followers": 10.0, "pass_rate": 90.0, "badge": "Expert", "buyers_fees": Decimal("1"),
    "warehouse_name": "W",
}


def _dec(v):
    return None if v is None else Decimal(str(v))


def listing(**kw) -> tuple:
    r = {**_DEFAULT, **kw}
    return (
        r["id"], r["type"], r["name"], r["description"], r["keywords"], r["gender_target"], r["category"],
        r["season"], r["condition"], _dec(r["like_count"]),
        r["material"], r["color"], _dec(r["price_usd"]),
        (r["brand"], r["brand"]),
        (r["sold"], r["reserved"], r["available"]),
        (
            r["seller_id"], r["username"], r["country"], _dec(r["seller_price"]), _dec(r["earning"]),
            r["products_sold"], r["num_products_listed"], r["community_rank"],
            _dec(r["num_followers"]),
            None if r["pass_rate"] is None else float(r["pass_rate"]), r["badge"],
        ),
        (_dec(r["buyers_fees"]), r["warehouse_name"]),
    )


def make_listings(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame([listing(**r) for r in rows], LISTING_SCHEMA)
