"""The given tables in the roles of the star schema.

An order line is an enrolment row: the order's month is the period, the supplier
the carrier, the customer's nation the state and its market segment the locality
within.  A facility is a part at a supplier, active in the months it is ordered; it
lies in one of the five localities of the supplier's nation, by the part's number,
so some localities have none in a month.  Events are stage runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.functions.periods import period_of_date
from coverlens.plans.star import Star
from coverlens.session import configure
from proofs.sql import SEGMENTS

PERIOD = 199806
DISTRICTS = 5
ATTENTION, CRITICAL = 25, 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def locality_key(nation: str, district: Column) -> Column:
    return (F.col(nation) * DISTRICTS + district).cast("bigint")


def enrolment(spark: SparkSession, sf_dir: str, locality: bool = True) -> DataFrame:
    """Fact rows at the finest grain.  ``locality=False`` leaves out the customer join."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("_order"),
        F.col("l_suppkey").alias("carrier_sk"),
        F.col("l_returnflag").alias("sex"),
        F.col("l_linestatus").alias("tie_type"),
        F.col("l_partkey").alias("plan"),
        F.col("l_quantity").cast("bigint").alias("active"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("joined"),
        F.col("l_linenumber").cast("bigint").alias("cancelled"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("_order"),
        F.col("o_custkey").alias("_customer"),
        period_of_date("o_orderdate").alias("period_key"),
        F.col("o_orderpriority").alias("age_band"),
    )
    if locality:
        customers = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("_customer"),
            locality_key("c_nationkey", F.array_position(F.array(*map(F.lit, SEGMENTS)), F.col("c_mktsegment")) - 1).alias("locality_sk"),
            F.col("c_mktsegment").alias("segment"),
        )
        orders = orders.join(customers, "_customer")
    return lines.join(orders, "_order").drop("_order", "_customer")


def places(spark: SparkSession, sf_dir: str, state_is_region: bool = False) -> DataFrame:
    """Five localities a nation; the nation is their state, or its region is."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    state = "r_name" if state_is_region else "n_name"
    districts = joined.withColumn("district", F.explode(F.sequence(F.lit(0), F.lit(DISTRICTS - 1))))
    number = locality_key("n_nationkey", F.col("district"))
    return districts.select(
        number.alias("locality_sk"),
        number.cast("string").alias("locality_code"),
        F.concat_ws("/", "n_name", "district").alias("locality_name"),
        F.col(state).alias("state"),
        F.col(state).alias("state_name"),
        F.col("r_name").alias("region"),
    )


def carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("carrier_sk"),
        F.col("s_suppkey").cast("string").alias("carrier_code"),
        F.col("s_name").alias("legal_name"),
        F.col("s_nationkey").cast("string").alias("kind"),
    )


def network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per period and facility.

    Distinct facilities are formed before their parts and suppliers are joined.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", period_of_date("o_orderdate").alias("period_key"))
    seats = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    active = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("period_key", "l_partkey", "l_suppkey").distinct()
    typed = active.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return typed.join(seats, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "period_key",
        F.concat_ws("-", "l_partkey", "l_suppkey").alias("facility_code"),
        F.col("p_type").alias("facility_type_sk"),
        locality_key("s_nationkey", F.col("l_partkey") % DISTRICTS).alias("locality_sk"),
        F.lit(1).cast("bigint").alias("facilities"),
    )


def facility_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = table(spark, sf_dir, "part").select("p_type").distinct()
    return types.select(
        F.col("p_type").alias("facility_type_sk"),
        F.col("p_type").alias("type_code"),
        F.concat(F.lit("Tipo "), F.col("p_type")).alias("type_label"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a stage run: user as source, error events as failures."""
    events = table(spark, sf_dir, "events")
    key = F.get_json_object("props", "$.k").cast("bigint")
    cents = F.round(F.col("value") * 100).cast("bigint")
    started = F.date_trunc("second", F.col("ts").cast("timestamp"))
    return events.select(
        F.col("event_id").alias("run_id"),
        F.lit("coverage").alias("pipeline"),
        F.col("event_type").alias("stage"),
        F.date_format("ts", "yyyy-MM").alias("period"),
        F.concat(F.lit("source "), F.col("user_id").cast("string")).alias("source"),
        started.alias("started_at"),
        F.when(F.col("event_type") != "signup", F.timestamp_seconds(F.unix_timestamp(started) + key)).alias(
            "finished_at"
        ),
        F.when(F.col("event_type") != "signup", key).alias("duration_seconds"),
        F.when(F.col("event_type") == "error", "FAILED")
        .when(F.col("event_type") == "signup", "RUNNING")
        .otherwise("SUCCESS")
        .alias("status"),
        cents.alias("received"),
        F.greatest(cents - key, F.lit(0)).alias("valid"),
        F.least(cents, key).alias("rejected"),
    )


def rule_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rule results per run."""
    base = runs(spark, sf_dir).select("run_id", "stage", "received", "rejected", "started_at")
    entry = lambda rule, description, severity, violated: F.struct(
        F.lit(rule).alias("rule"),
        F.lit(description).alias("description"),
        F.lit(severity).alias("severity"),
        F.col("received").alias("evaluated"),
        (F.col("received") - violated).alias("accepted"),
        violated.alias("violated"),
    )
    results = F.array(
        entry("negative_count", "below zero", "ERROR", F.col("rejected")),
        entry("carrier_unknown", "not registered", "WARNING", F.floor(F.col("rejected") / 2)),
    )
    return base.select("run_id", "stage", F.col("started_at").alias("evaluated_at"), F.inline(results))


def star(spark: SparkSession, sf_dir: str, *parts: str, state_is_region: bool = False) -> Star:
    """The named parts of the star; what a query does not name is not even opened."""
    build = {
        "enrolment": lambda: enrolment(spark, sf_dir, "locality" in parts),
        "network": lambda: network(spark, sf_dir),
        "locality": lambda: places(spark, sf_dir, state_is_region),
        "carrier": lambda: carriers(spark, sf_dir),
        "facility_type": lambda: facility_types(spark, sf_dir),
        "runs": lambda: runs(spark, sf_dir),
        "rules": lambda: rule_results(spark, sf_dir),
    }
    return Star(**{name: build[name]() for name in parts})


def plain(df: DataFrame) -> DataFrame:
    """Types both engines print alike: decimals as doubles, dates and times as text."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        c = F.col(f"`{f.name}`")
        if kind == "decimal":
            c = (c.cast("decimal(38,6)") if f.dataType.scale > 6 else c).cast("double")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)
