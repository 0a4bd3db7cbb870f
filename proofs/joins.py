"""Join operators: lookups, left and anti joins, change detection, integrity."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverlens.operators import facts, grain, lookups
from proofs import roles, sql
from proofs.registry import proof
from proofs.roles import table


@proof(
    "star_join",
    f"""WITH {sql.ENROL} SELECT period_key, r_name AS region, CAST(s_nationkey AS VARCHAR) AS kind,
  CAST(sum(active) AS BIGINT) AS active_members
FROM enrol JOIN nation ON locality_sk // 5 = n_nationkey JOIN region ON n_regionkey = r_regionkey
JOIN supplier ON carrier_sk = s_suppkey GROUP BY ALL""",
)
def star_join(spark, sf_dir):
    """Fact to two dimensions; summed by keys first, so the joins see one row per key pair."""
    keyed = grain.sum_to_grain(
        roles.enrolment(spark, sf_dir), ["period_key", "carrier_sk", "locality_sk"], ["active"]
    )
    joined = keyed.join(roles.places(spark, sf_dir), "locality_sk").join(roles.carriers(spark, sf_dir), "carrier_sk")
    return joined.groupBy("period_key", "region", "kind").agg(F.sum("active").alias("active_members"))


@proof(
    "left_measures",
    """SELECT c.nation, c.customers, coalesce(s.suppliers, 0) AS suppliers
FROM (SELECT c_nationkey AS nation, count(*) AS customers FROM customer GROUP BY 1) c
LEFT JOIN (SELECT s_nationkey AS nation, count(*) AS suppliers FROM supplier WHERE s_acctbal < 3000 GROUP BY 1) s
  USING (nation)""",
)
def left_measures(spark, sf_dir):
    left = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.count(F.lit(1)).alias("customers")
    )
    right = (
        table(spark, sf_dir, "supplier")
        .where("s_acctbal < 3000")
        .groupBy(F.col("s_nationkey").alias("nation"))
        .agg(F.count(F.lit(1)).alias("suppliers"))
    )
    return lookups.left_measures(left, right, ["nation"], ["suppliers"])


@proof(
    "left_condition_in_on",
    """SELECT c_mktsegment AS segment, count(*) AS rows, count(o_orderkey) AS urgent_orders
FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT' GROUP BY 1""",
)
def left_condition_in_on(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), "o_orderkey", "o_orderpriority")
    joined = lookups.left_where(customers, orders, ["key"], F.col("o_orderpriority") == "1-URGENT")
    return joined.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("o_orderkey").alias("urgent_orders")
    )


@proof(
    "lookup_default",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN s_acctbal >= 0 THEN l_suppkey ELSE -1 END AS carrier_sk
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def lookup_default(spark, sf_dir):
    registered = table(spark, sf_dir, "supplier").where("s_acctbal >= 0")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    found = lookups.lookup_key(lines, registered, {"l_suppkey": "s_suppkey"}, "s_suppkey", -1, alias="carrier_sk")
    return found.drop("l_suppkey")


@proof(
    "anti_join",
    """SELECT c_custkey, c_nationkey FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')""",
)
def anti_join(spark, sf_dir):
    pending = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return lookups.without_match(customers, pending, {"c_custkey": "o_custkey"})


@proof(
    "anti_join_composite",
    """SELECT DISTINCT l_partkey, l_suppkey FROM lineitem a WHERE l_returnflag = 'R' AND NOT EXISTS (
  SELECT 1 FROM lineitem b WHERE b.l_returnflag <> 'R' AND b.l_partkey = a.l_partkey AND b.l_suppkey = a.l_suppkey)""",
)
def anti_join_composite(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    returned = lines.where("l_returnflag = 'R'").select("l_partkey", "l_suppkey").distinct()
    return lookups.without_match(returned, lines.where("l_returnflag <> 'R'"), ["l_partkey", "l_suppkey"])


@proof(
    "null_as_blank_join",
    """SELECT coalesce(a.segment, '') AS segment, customers, balance_rows FROM
  (SELECT nullif(c_mktsegment, 'BUILDING') AS segment, count(*) AS customers FROM customer GROUP BY 1) a JOIN
  (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS segment, count(*) AS balance_rows
   FROM customer WHERE c_acctbal < 0 GROUP BY 1) b ON coalesce(a.segment, '') = coalesce(b.segment, '')""",
)
def null_as_blank_join(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    segment = F.col("c_mktsegment")
    a = customers.groupBy(F.nullif(segment, F.lit("BUILDING")).alias("a_segment")).agg(
        F.count(F.lit(1)).alias("customers")
    )
    blank = F.when(segment == "BUILDING", "").otherwise(segment)
    b = customers.where("c_acctbal < 0").groupBy(blank.alias("b_segment")).agg(F.count(F.lit(1)).alias("balance_rows"))
    joined = a.join(b, lookups.same_or_blank(F.col("a_segment"), F.col("b_segment")))
    return joined.select(F.coalesce("a_segment", F.lit("")).alias("segment"), "customers", "balance_rows")


NEW_SUPPLIER = """(SELECT s_suppkey, CASE WHEN s_acctbal > 8000 THEN upper(s_name) ELSE s_name END AS s_name,
  CASE WHEN s_acctbal < 1000 THEN NULL ELSE s_nationkey END AS s_nationkey FROM supplier)"""


def next_suppliers(spark, sf_dir):
    """The supplier register one delivery later: rich ones renamed, poor ones without a nation."""
    balance = F.col("s_acctbal")
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.when(balance > 8000, F.upper("s_name")).otherwise(F.col("s_name")).alias("s_name"),
        F.when(balance >= 1000, F.col("s_nationkey")).alias("s_nationkey"),
    )


@proof(
    "changed_rows",
    f"""SELECT o.s_suppkey, o.s_name AS old_s_name, o.s_nationkey AS old_s_nationkey, n.s_name AS new_s_name,
  n.s_nationkey AS new_s_nationkey FROM supplier o JOIN {NEW_SUPPLIER} n USING (s_suppkey)
WHERE o.s_name <> n.s_name OR o.s_nationkey IS DISTINCT FROM n.s_nationkey""",
)
def changed_rows(spark, sf_dir):
    return lookups.changed_rows(
        table(spark, sf_dir, "supplier"), next_suppliers(spark, sf_dir), ["s_suppkey"], ["s_name", "s_nationkey"]
    )


@proof(
    "changed_keys_resolved",
    """SELECT p_partkey, o.type_sk AS old_type_sk, n.type_sk AS new_type_sk FROM
  (SELECT p_partkey, CASE WHEN p_type <> 'MEDIUM' THEN ascii(p_type) ELSE -1 END AS type_sk FROM part) o JOIN
  (SELECT p_partkey, CASE WHEN p_size > 40 THEN -1 WHEN p_type <> 'MEDIUM' THEN ascii(p_type) ELSE -1 END AS type_sk
   FROM part) n USING (p_partkey) WHERE o.type_sk <> n.type_sk""",
)
def changed_keys_resolved(spark, sf_dir):
    """Compared after both sides went through the lookup, so a change to an unknown type is seen."""
    parts = table(spark, sf_dir, "part")
    types = parts.where("p_type <> 'MEDIUM'").select("p_type", F.ascii("p_type").cast("bigint").alias("type_sk"))
    types = types.distinct()
    old = parts.select("p_partkey", "p_type")
    new = parts.select("p_partkey", F.when(F.col("p_size") > 40, "NEW TYPE").otherwise(F.col("p_type")).alias("p_type"))
    resolved = [lookups.lookup_key(side, types, ["p_type"], "type_sk") for side in (old, new)]
    return lookups.changed_rows(resolved[0], resolved[1], ["p_partkey"], ["type_sk"])


@proof(
    "merge_source",
    """SELECT DISTINCT p_partkey AS facility_sk, p_type AS facility_type_sk, p_size AS locality_sk FROM part
JOIN lineitem ON l_partkey = p_partkey WHERE p_retailprice >= 950 AND l_returnflag = 'R'""",
)
def merge_source(spark, sf_dir):
    facility = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("facility_sk"),
        F.col("p_partkey").alias("code"),
        F.col("p_type").alias("facility_type_sk"),
        F.col("p_size").alias("locality_sk"),
        (F.col("p_retailprice") >= 950).alias("is_current"),
    )
    batch = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("code"))
    return facts.network_members(facility, batch, "code")


@proof(
    "fk_violations",
    """SELECT l_suppkey, count(*) AS rows FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 500) GROUP BY 1""",
)
def fk_violations(spark, sf_dir):
    return lookups.foreign_key_violations(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "supplier").where("s_acctbal >= 500"),
        {"l_suppkey": "s_suppkey"},
    )


@proof(
    "grain_violations",
    """SELECT l_orderkey, l_linenumber, count(*) AS rows_in_key FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def grain_violations(spark, sf_dir):
    return grain.grain_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@proof(
    "sum_conservation",
    f"""WITH {sql.ENROL} SELECT 'active' AS measure, (SELECT CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT)
  FROM lineitem) AS source_total, CAST(sum(active) AS BIGINT) AS target_total,
  (SELECT CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) FROM lineitem) - CAST(sum(active) AS BIGINT) AS difference
FROM enrol
UNION ALL SELECT 'cancelled', (SELECT CAST(sum(l_linenumber) AS BIGINT) FROM lineitem),
  CAST(sum(cancelled) AS BIGINT), (SELECT CAST(sum(l_linenumber) AS BIGINT) FROM lineitem) - CAST(sum(cancelled) AS BIGINT)
FROM enrol""",
)
def sum_conservation(spark, sf_dir):
    source = table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").cast("bigint").alias("active"), F.col("l_linenumber").cast("bigint").alias("cancelled")
    )
    fact = grain.sum_to_grain(
        roles.enrolment(spark, sf_dir), ["period_key", "carrier_sk", "locality_sk"], ["active", "cancelled"]
    )
    return grain.conservation(source, fact, ["active", "cancelled"])
