"""A fruit shop with inline data, and order and payment totals per customer."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.quality import case, is_in, is_not_null
from tidemark.operators.reports import group_counts
from tidemark.plans.resources import Resource, source, transformation
from tidemark.sources.inline import inline_rows, seeded_purchases

# The rows of the shop.
CUSTOMERS = [
    {"id": 1, "name": "simon", "city": "berlin"},
    {"id": 2, "name": "violet", "city": "montreal"},
    {"id": 3, "name": "tammo", "city": "new york"},
    {"id": 4, "name": "dave", "city": "berlin"},
    {"id": 5, "name": "andrea", "city": "montreal"},
    {"id": 6, "name": "marcin", "city": "new york"},
    {"id": 7, "name": "sarah", "city": "berlin"},
    {"id": 8, "name": "miguel", "city": "new york"},
    {"id": 9, "name": "yuki", "city": "montreal"},
    {"id": 10, "name": "olivia", "city": "berlin"},
    {"id": 11, "name": "raj", "city": "montreal"},
    {"id": 12, "name": "sofia", "city": "new york"},
    {"id": 13, "name": "chen", "city": "berlin"},
]
CATEGORIES = [
    {"id": 1, "name": "pomes"},
    {"id": 2, "name": "berries"},
    {"id": 3, "name": "stone fruits"},
]
INVENTORY = [
    {"id": 1, "name": "apple", "price": Decimal("1.50"), "category_id": 1},
    {"id": 2, "name": "pear", "price": Decimal("1.70"), "category_id": 1},
    {"id": 3, "name": "cherry", "price": Decimal("2.50"), "category_id": 2},
    {"id": 4, "name": "strawberry", "price": Decimal("1.00"), "category_id": 2},
    {"id": 5, "name": "peach", "price": Decimal("1.20"), "category_id": 3},
    {"id": 6, "name": "plum", "price": Decimal("1.30"), "category_id": 3},
]

INVENTORY_CHECKS = [
    is_in("name", ["apple", "pear", "cherry"]),
    is_not_null("price"),
    case("price < 0"),
]


@source
def fruit_shop() -> Sequence[Resource]:
    return [
        Resource(
            "customers",
            lambda spark: inline_rows(spark, CUSTOMERS, "id bigint, name string, city string"),
            primary_key="id",
            columns={"name": {"pii": True}},
        ),
        Resource(
            "inventory_categories",
            lambda spark: inline_rows(spark, CATEGORIES, "id bigint, name string"),
            primary_key="id",
        ),
        Resource(
            "inventory",
            lambda spark: inline_rows(
                spark, INVENTORY, "id bigint, name string, price decimal(10,2), category_id bigint"
            ),
            primary_key="id",
        ),
        Resource("purchases", seeded_purchases, primary_key="id"),
    ]


def customers_per_city(customers: DataFrame) -> DataFrame:
    return group_counts(customers, ["city"], "id", "number_of_customers")


@transformation
def customer_orders(dataset) -> DataFrame:
    """First and last order and the number of orders of each customer."""
    return (
        dataset["orders"]
        .groupBy("customer_id")
        .agg(
            F.min("ordered_at").alias("first_order"),
            F.max("ordered_at").alias("most_recent_order"),
            F.count("id").alias("number_of_orders"),
        )
    )


@transformation
def customer_payments(dataset) -> DataFrame:
    """Total paid per customer; payments without a known order form the NULL customer.

    Payments are summed per order before the join. That gives the same totals, and an
    order with very many payments is one row by the time it is shuffled to the join.
    """
    orders = dataset["orders"].select("id", "customer_id")
    per_order = dataset["payments"].groupBy("order_id").agg(F.sum("amount").alias("amount"))
    joined = per_order.join(orders, per_order.order_id == orders.id, "left")
    return joined.groupBy("customer_id").agg(F.sum("amount").alias("total_amount"))


@source
def customer_metrics(dataset) -> Sequence[Resource]:
    return [customer_orders(dataset), customer_payments(dataset)]
