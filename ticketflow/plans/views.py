"""Ticket tables derived from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.plans import booked_time as bt

# Schemas of the star-schema tables read here; declaring them saves a look into the files.
STAR = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
}


def _star(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.schema(STAR[name]).parquet(f"{base}/{name}.parquet")


def tickets(spark: SparkSession, base: str, team: bool = True) -> DataFrame:
    """Tickets; without `team` the app group and the join that fetches it are left out.

    The customer is looked up by its key with a left join, so leaving the join
    out changes no row.
    """
    orders = _star(spark, base, "orders")
    if team:
        customers = _star(spark, base, "customer").select("c_custkey", "c_mktsegment")
        orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    return orders.selectExpr(
        "o_orderkey AS oid",
        """CASE o_orderpriority WHEN '1-URGENT' THEN 'DEV' WHEN '2-HIGH' THEN 'DEV-VIP' WHEN '3-MEDIUM' THEN 'SDEV'
             WHEN '4-NOT SPECIFIED' THEN 'RFC' WHEN '5-LOW' THEN 'INC' END AS ticket_type""",
        *(["c_mktsegment AS appgroup"] if team else []),
        "o_orderdate AS created",
        """CASE WHEN o_orderstatus = 'F'
             THEN o_orderdate + make_dt_interval(CAST(o_orderkey % 97 AS INT)) END AS closed""",
    )


def worktimesheet(spark: SparkSession, base: str) -> DataFrame:
    return _star(spark, base, "lineitem").selectExpr(
        "l_orderkey AS issue",
        "CASE WHEN l_linenumber <> 7 THEN l_suppkey % 4 END AS owner",
        "4 + l_partkey % 2 AS actiontypegroup",
        """TIMESTAMP_NTZ '1995-01-01' + make_dt_interval(CAST(l_orderkey % 2400 + l_linenumber % 2 AS INT), l_linenumber)
             AS startdate""",
        "l_quantity AS hours",
        """CASE WHEN l_linenumber = 6 THEN NULL WHEN l_returnflag = 'A' THEN 'TravelTime' ELSE 'WorkTime' END
             AS timetype""",
    )


def permissionpolicyuser(spark: SparkSession, base: str) -> DataFrame:
    return _star(spark, base, "supplier").selectExpr(
        "s_suppkey AS oid",
        "'User#' || s_suppkey % 2 AS name",
        "CASE WHEN s_suppkey % 10 <> 0 THEN s_suppkey % 2 END AS defaultorganization",
    )


def organization(spark: SparkSession, base: str) -> DataFrame:
    return _star(spark, base, "nation").selectExpr("CAST(n_nationkey AS BIGINT) AS oid", "n_name AS name")


def actiontypegroup(spark: SparkSession, base: str) -> DataFrame:
    return _star(spark, base, "region").selectExpr("CAST(r_regionkey AS BIGINT) AS oid", "r_name AS name")


def dev_milestones(spark: SparkSession, base: str) -> DataFrame:
    """Milestones, some tickets with a second row.

    Both rows come from one scan: an order explodes into its one or two.
    """
    first = """named_struct(
      'demand_start', CASE WHEN o_orderkey % 4 <> 0
                        THEN o_orderdate + make_dt_interval(CAST(o_orderkey % 50 AS INT), 9) END,
      'release_start', CASE WHEN o_orderkey % 3 = 0
                         THEN o_orderdate + make_dt_interval(CAST(200 + o_orderkey % 30 AS INT)) END)"""
    second = """named_struct('demand_start', o_orderdate + make_dt_interval(30),
                             'release_start', CAST(NULL AS TIMESTAMP_NTZ))"""
    rows = f"CASE WHEN o_orderkey % 11 = 0 THEN array({first}, {second}) ELSE array({first}) END"
    return (
        _star(spark, base, "orders")
        .filter("o_orderkey % 13 <> 0")
        .selectExpr("o_orderkey AS oid", f"inline({rows})")
    )


def named_work(spark: SparkSession, base: str) -> DataFrame:
    """Work bookings with names."""
    return bt.named_work(
        worktimesheet(spark, base),
        permissionpolicyuser(spark, base),
        organization(spark, base),
        actiontypegroup(spark, base),
    )


def inputs(spark: SparkSession, base: str) -> bt.Inputs:
    return bt.Inputs(
        tickets=tickets(spark, base),
        worktimesheet=worktimesheet(spark, base),
        permissionpolicyuser=permissionpolicyuser(spark, base),
        organization=organization(spark, base),
        actiontypegroup=actiontypegroup(spark, base),
        dev_milestones=dev_milestones(spark, base),
    )
