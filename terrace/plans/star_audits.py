"""Audit, constraint and relation specs for the driver's star-schema tables.

These are configuration for the generic operators, the same way
``terrace.schemas`` configures them for the league entities.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from terrace.operators.quality import AuditSpec, Rule
from terrace.schemas import ForeignKey, TableSpec

LINEITEM_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                    "l_shipdate"]


def lineitem_spec() -> AuditSpec:
    return AuditSpec(
        "lineitem", ["l_orderkey", "l_linenumber"],
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus",
         "l_shipdate"],
        [Rule("Quantity must be between 1 and 50", F.col("l_quantity").between(1, 50)),
         Rule("Discount must be between 0 and 0.1", F.col("l_discount").between(0.0, 0.1)),
         Rule("Tax must be between 0 and 0.08", F.col("l_tax").between(0.0, 0.08)),
         Rule("Extended price must be positive", F.col("l_extendedprice") > 0)],
        order=LINEITEM_COLUMNS)


def customer_spec() -> AuditSpec:
    return AuditSpec(
        "customer", "c_custkey", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"],
        [Rule("Account balance cannot be negative", F.col("c_acctbal") >= 0),
         Rule("Nation key must be between 0 and 24", F.col("c_nationkey").between(0, 24))],
        order=["c_custkey"])


def orders_spec() -> AuditSpec:
    return AuditSpec(
        "orders", "o_orderkey", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"],
        [Rule("Total price must be positive", F.col("o_totalprice") > 0),
         Rule("Order status must be F, O or P", F.col("o_orderstatus").isin("F", "O", "P"))],
        order=["o_orderkey"])


STAR_TABLE_SPECS = {
    "customer": TableSpec(
        "customer", ["c_custkey"], not_null=["c_custkey", "c_name", "c_nationkey", "c_acctbal"],
        checks={"check_acctbal_non_negative": "c_acctbal >= 0"},
        foreign_keys=[ForeignKey(["c_nationkey"], "nation", ["n_nationkey"], "fk_customer_nation")]),
    "supplier": TableSpec(
        "supplier", ["s_suppkey"],
        checks={"check_acctbal_non_negative": "s_acctbal >= 0"},
        foreign_keys=[ForeignKey(["s_nationkey"], "nation", ["n_nationkey"], "fk_supplier_nation")]),
    "part": TableSpec("part", ["p_partkey"], unique=[["p_name"]],
                      checks={"check_size_positive": "p_size > 0",
                              "check_retailprice_positive": "p_retailprice > 0"}),
    "orders": TableSpec(
        "orders", ["o_orderkey"],
        checks={"check_totalprice_positive": "o_totalprice > 0"},
        foreign_keys=[ForeignKey(["o_custkey"], "customer", ["c_custkey"], "fk_orders_customer")]),
    "lineitem": TableSpec(
        "lineitem", ["l_orderkey", "l_linenumber"],
        checks={"check_quantity_positive": "l_quantity > 0",
                "check_discount_range": "l_discount BETWEEN 0 AND 0.1",
                "check_ship_after_order_year": "year(l_shipdate) >= 1990"},
        foreign_keys=[ForeignKey(["l_orderkey"], "orders", ["o_orderkey"], "fk_lineitem_orders"),
                      ForeignKey(["l_partkey"], "part", ["p_partkey"], "fk_lineitem_part"),
                      ForeignKey(["l_suppkey"], "supplier", ["s_suppkey"], "fk_lineitem_supplier")]),
    "nation": TableSpec(
        "nation", ["n_nationkey"], unique=[["n_name"]],
        foreign_keys=[ForeignKey(["n_regionkey"], "region", ["r_regionkey"], "fk_nation_region")]),
}
