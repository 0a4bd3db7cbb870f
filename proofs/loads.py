"""Dimension and fact loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverlens import layouts
from coverlens.operators import dimensions, facts
from coverlens.operators.grain import sum_to_grain
from coverlens.plans import loading
from coverlens.plans.loading import Warehouse
from coverlens.session import materialise, scratch_path
from proofs import roles, sql
from proofs.joins import NEW_SUPPLIER, next_suppliers
from proofs.registry import proof
from proofs.roles import table

FIRST_DAY, SECOND_DAY = "2024-01-01", "2024-02-01"


def bucket_order(key: str, text: str | None = None) -> str:
    return f"substr(md5({text or key}), 1, {dimensions.KEY_BUCKET_DIGITS}), {key}"


@proof(
    "surrogate_keys",
    f"""SELECT c_name, CAST(1000 + row_number() OVER (ORDER BY {bucket_order("c_name")}) AS BIGINT) AS sk FROM customer""",
)
def surrogate_keys(spark, sf_dir):
    """Dense keys without a global sort."""
    return dimensions.assign_keys(table(spark, sf_dir, "customer").select("c_name"), ["c_name"], "sk", 1000)


@proof(
    "unknown_member",
    """SELECT n_nationkey AS locality_sk, n_name AS name FROM nation UNION ALL SELECT -1, 'unknown'""",
)
def unknown_member(spark, sf_dir):
    dim = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("locality_sk"), F.col("n_name").alias("name"))
    once = dimensions.with_unknown(dim, {"locality_sk": -1, "name": "unknown"})
    return dimensions.with_unknown(once, {"locality_sk": -1, "name": "unknown"})


def _type1(spark, sf_dir, mode):
    """The dimension holds suppliers with a balance below 5000; the delivery has all of them."""
    old = table(spark, sf_dir, "supplier").where("s_acctbal < 5000")
    dim = old.select(
        (F.col("s_suppkey") + 1).alias("sk"), "s_name", F.col("s_nationkey").cast("string").alias("home")
    )
    incoming = table(spark, sf_dir, "supplier").select(
        "s_name", F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("home")
    )
    return dimensions.upsert_type1(dim, incoming, ["s_name"], ["home"], "sk", mode)


def _type1_sql(home: str) -> str:
    return f"""SELECT s_suppkey + 1 AS sk, s_name, {home} AS home FROM supplier WHERE s_acctbal < 5000
UNION ALL SELECT (SELECT max(s_suppkey) + 1 FROM supplier WHERE s_acctbal < 5000) +
  row_number() OVER (ORDER BY {bucket_order("s_name")}), s_name, 'n' || s_nationkey
FROM supplier WHERE s_acctbal >= 5000"""


@proof("type1_upsert", _type1_sql("'n' || s_nationkey"))
def type1_upsert(spark, sf_dir):
    return _type1(spark, sf_dir, "overwrite")


@proof("type1_insert_only", _type1_sql("CAST(s_nationkey AS VARCHAR)"))
def type1_insert_only(spark, sf_dir):
    return _type1(spark, sf_dir, "insert_only")


TYPE2_COLUMNS = "sk, s_suppkey, s_name, s_nationkey, valid_from, valid_to, is_current"


def _type2_first(spark, sf_dir):
    old = table(spark, sf_dir, "supplier").where("s_acctbal < 9000")
    return old.select(
        (F.col("s_suppkey") + 1).alias("sk"),
        "s_suppkey",
        "s_name",
        "s_nationkey",
        F.lit(FIRST_DAY).cast("date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


@proof(
    "type2_versions",
    f"""WITH n AS (SELECT o.*, x.s_name AS new_name, x.s_nationkey AS new_nation,
    x.s_name <> o.s_name OR x.s_nationkey IS DISTINCT FROM o.s_nationkey AS changed
  FROM supplier o JOIN {NEW_SUPPLIER} x USING (s_suppkey)),
opened AS (SELECT * FROM n WHERE s_acctbal >= 9000 OR changed)
SELECT s_suppkey + 1 AS sk, s_suppkey, s_name, s_nationkey, '{FIRST_DAY}' AS valid_from,
  CASE WHEN changed THEN '{SECOND_DAY}' END AS valid_to, NOT changed AS is_current FROM n WHERE s_acctbal < 9000
UNION ALL SELECT (SELECT max(s_suppkey) + 1 FROM supplier WHERE s_acctbal < 9000) +
  row_number() OVER (ORDER BY {bucket_order("s_suppkey", "CAST(s_suppkey AS VARCHAR)")}), s_suppkey, new_name,
  new_nation, '{SECOND_DAY}', NULL, true FROM opened""",
)
def type2_versions(spark, sf_dir):
    """Changed versions close, new and changed members open."""
    return dimensions.upsert_type2(
        _type2_first(spark, sf_dir), next_suppliers(spark, sf_dir), "s_suppkey", ["s_name", "s_nationkey"], [], "sk",
        SECOND_DAY,
    )


@proof(
    "type2_same_day",
    f"""SELECT count(*) AS versions, count(*) FILTER (is_current) AS current_versions, 0::BIGINT AS conflicts,
  count(*) FILTER (s_name = upper(s_name)) AS renamed FROM (
  SELECT x.s_name, true AS is_current FROM supplier o JOIN {NEW_SUPPLIER} x USING (s_suppkey))""",
)
def type2_same_day(spark, sf_dir):
    """A second change on the day a version opened replaces it, so one current version remains."""
    loaded = dimensions.upsert_type2(
        _type2_first(spark, sf_dir), next_suppliers(spark, sf_dir), "s_suppkey", ["s_name", "s_nationkey"], [], "sk",
        FIRST_DAY,
    )
    conflicts = dimensions.current_violations(loaded, "s_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return loaded.agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_if("is_current").alias("current_versions"),
        F.count_if(F.col("s_name") == F.upper("s_name")).alias("renamed"),
    ).select("*", conflicts.scalar().alias("conflicts"))


@proof(
    "type2_close_missing",
    f"""SELECT s_suppkey, '{FIRST_DAY}' AS valid_from, CASE WHEN s_acctbal < 4000 THEN '{SECOND_DAY}' END AS valid_to,
  s_acctbal >= 4000 AS is_current FROM supplier WHERE s_acctbal < 9000""",
)
def type2_close_missing(spark, sf_dir):
    delivered = table(spark, sf_dir, "supplier").where("s_acctbal >= 4000 and s_acctbal < 9000")
    loaded = dimensions.upsert_type2(
        _type2_first(spark, sf_dir), delivered, "s_suppkey", ["s_name", "s_nationkey"], [], "sk", SECOND_DAY,
        close_missing=True,
    )
    return loaded.select("s_suppkey", "valid_from", "valid_to", "is_current")


@proof(
    "facility_keys_resolved",
    """SELECT p_partkey AS facility_code, p_name AS facility_name,
  CASE WHEN p_type <> 'MEDIUM' THEN ascii(p_type) ELSE -1 END AS facility_type_sk,
  CASE WHEN p_size * 4 < 125 THEN p_size * 4 ELSE -1 END AS locality_sk FROM part""",
)
def facility_keys_resolved(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    batch = parts.select(
        F.col("p_partkey").alias("facility_code"),
        F.col("p_name").alias("facility_name"),
        F.col("p_type").alias("type_code"),
        (F.col("p_size") * 4).cast("string").alias("locality_code"),
        (F.col("p_size") * 4).cast("string").alias("state"),
    )
    types = parts.where("p_type <> 'MEDIUM'").select(
        F.col("p_type").alias("type_code"), F.ascii("p_type").cast("bigint").alias("facility_type_sk")
    )
    known = roles.places(spark, sf_dir).withColumn("state", F.col("locality_code"))
    return loading.resolve_facilities(batch, types.distinct(), known)


GRAIN = ["period_key", "carrier_sk", "segment"]


def _fact_and_batch(spark, sf_dir):
    """The fact holds open lines; the batch holds all lines of urgent orders.  One segment is blank or null."""
    rows = roles.enrolment(spark, sf_dir)
    building = F.col("segment") == "BUILDING"
    old = rows.where("tie_type = 'O'").withColumn("segment", F.when(~building, F.col("segment")))
    new = rows.where("age_band = '1-URGENT'").withColumn("segment", F.when(building, "").otherwise(F.col("segment")))
    return sum_to_grain(old, GRAIN, ["active"]), sum_to_grain(new, GRAIN, ["active"])


FACT_SQL = f"""WITH {sql.ENROL},
  f AS (SELECT period_key, carrier_sk, nullif(segment, 'BUILDING') AS segment, CAST(sum(active) AS BIGINT) AS active
        FROM enrol WHERE tie_type = 'O' GROUP BY ALL),
  b AS (SELECT period_key, carrier_sk, CASE WHEN segment = 'BUILDING' THEN '' ELSE segment END AS segment,
          CAST(sum(active) AS BIGINT) AS active FROM enrol WHERE age_band = '1-URGENT' GROUP BY ALL),
  m AS (SELECT coalesce(f.period_key, b.period_key) AS period_key, coalesce(f.carrier_sk, b.carrier_sk) AS carrier_sk,
          CASE WHEN f.period_key IS NOT NULL THEN f.segment ELSE b.segment END AS segment,
          coalesce(b.active, f.active) AS active,
          CASE WHEN f.period_key IS NULL THEN 'INSERT' WHEN b.period_key IS NULL THEN 'KEEP' ELSE 'UPDATE' END AS action
        FROM f FULL JOIN b ON f.period_key = b.period_key AND f.carrier_sk = b.carrier_sk
          AND coalesce(f.segment, '') = coalesce(b.segment, ''))"""


@proof("fact_upsert", f"{FACT_SQL} SELECT * FROM m")
def fact_upsert(spark, sf_dir):
    fact, batch = _fact_and_batch(spark, sf_dir)
    merged = facts.upsert_fact(fact, batch, GRAIN, ["active"], ["segment"])
    return merged.withColumnRenamed("_action", "action")


@proof("fact_replace", f"{FACT_SQL} SELECT * FROM m WHERE action <> 'KEEP'")
def fact_replace(spark, sf_dir):
    fact, batch = _fact_and_batch(spark, sf_dir)
    merged = facts.upsert_fact(fact, batch, GRAIN, ["active"], ["segment"], mode="replace")
    return merged.withColumnRenamed("_action", "action")


@proof("merge_action_counts", f"{FACT_SQL} SELECT action, count(*) AS rows FROM m GROUP BY 1")
def merge_action_counts(spark, sf_dir):
    fact, batch = _fact_and_batch(spark, sf_dir)
    return facts.action_counts(facts.upsert_fact(fact, batch, GRAIN, ["active"], ["segment"]))


LOAD_PERIOD, NEXT_PERIOD = roles.PERIOD, roles.PERIOD + 1
LOADED = f"period_key IN ({LOAD_PERIOD}, {NEXT_PERIOD})"
GRAIN_KEYS = "period_key, locality_sk, sex, age_band, tie_type, segment"


@proof(
    "warehouse_load",
    f"""WITH {sql.ENROL}, {sql.PLACES},
g AS (SELECT carrier_sk, {GRAIN_KEYS}, CAST(sum(active) AS BIGINT) AS active FROM enrol WHERE {LOADED} GROUP BY ALL),
loaded AS (
  SELECT CASE WHEN s_acctbal >= 0 THEN 'c' || carrier_sk ELSE '-' END AS carrier, g.*,
    period_key = {LOAD_PERIOD} AND tie_type <> 'F' AS again FROM g JOIN supplier ON carrier_sk = s_suppkey)
SELECT 'enrolment' AS name, period_key, carrier, 'p' || locality_sk AS locality,
  concat_ws('/', sex, age_band, tie_type, segment) AS detail,
  CAST(sum(active + CASE WHEN again AND sex = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS value,
  CAST(CASE WHEN again THEN 3 WHEN period_key = {LOAD_PERIOD} THEN 1 ELSE 2 END AS BIGINT) AS run_id
FROM loaded GROUP BY carrier, locality_sk, sex, age_band, tie_type, segment, period_key, again
UNION ALL SELECT 'carrier', NULL, 'c' || s_suppkey, NULL, s_name, NULL, NULL FROM supplier WHERE s_acctbal >= 0
UNION ALL SELECT DISTINCT 'locality', NULL::INTEGER, NULL, 'p' || locality_sk, 'place ' || locality_sk, NULL::BIGINT, NULL::BIGINT FROM g
UNION ALL SELECT DISTINCT 'time', period_key, NULL, NULL, NULL, NULL::BIGINT, NULL::BIGINT FROM g""",
)
def warehouse_load(spark, sf_dir):
    """Carriers, then two months of enrolment, then the first month again without closed rows and with other counts.

    Facts are shown under the natural keys that their surrogate keys lead to; rows that the last load lacks stay.
    """
    rows = roles.enrolment(spark, sf_dir).where(F.col("period_key").isin(LOAD_PERIOD, NEXT_PERIOD))
    rows = rows.withColumns(
        {
            "carrier_code": F.concat(F.lit("c"), F.col("carrier_sk").cast("string")),
            "locality_code": F.concat(F.lit("p"), F.col("locality_sk").cast("string")),
            "locality_name": F.concat(F.lit("place "), F.col("locality_sk").cast("string")),
            "state": F.lit("SP"),
        }
    )
    # The loads read their batches several times, so they are written first, as the validated layer would be.
    batch = materialise(sum_to_grain(rows, layouts.ENROLMENT_GRAIN, layouts.MEASURES), "batch")
    none = F.lit(None).cast("string")
    register = table(spark, sf_dir, "supplier").where("s_acctbal >= 0").select(
        F.concat(F.lit("c"), F.col("s_suppkey").cast("string")).alias("carrier_code"),
        F.col("s_name").alias("legal_name"),
        *[none.alias(c) for c in ("kind", "seat_state", "registration_no", "trade_name", "seat_locality")],
        F.lit(None).cast("date").alias("registered_on"),
    )
    house = Warehouse(spark, scratch_path(spark, "warehouse"))
    house.load_carriers(register, FIRST_DAY)
    month = {p: batch.where(F.col("period_key") == p) for p in (LOAD_PERIOD, NEXT_PERIOD)}
    house.load_enrolment(month[LOAD_PERIOD], LOAD_PERIOD, 1)
    house.load_enrolment(month[NEXT_PERIOD], NEXT_PERIOD, 2)
    changed = F.col("active") + F.when(F.col("sex") == "R", 1).otherwise(0)
    house.load_enrolment(month[LOAD_PERIOD].where("tie_type <> 'F'").withColumn("active", changed), LOAD_PERIOD, 3)
    carrier, locality = house.read("carrier"), house.read("locality")

    def shown(df, name, **values):
        kinds = {"period_key": "int", "carrier": "string", "locality": "string", "detail": "string", "value": "bigint", "run_id": "bigint"}
        columns = [values.get(c, F.lit(None)).cast(k).alias(c) for c, k in kinds.items()]
        return df.select(F.lit(name).alias("name"), *columns)

    fact = house.read("enrolment").join(carrier.select("carrier_sk", "carrier_code"), "carrier_sk", "left")
    fact = fact.join(locality.select("locality_sk", "locality_code"), "locality_sk", "left")
    named = F.when(F.col("carrier_sk") == layouts.UNKNOWN_KEY, "-").otherwise(F.col("carrier_code"))
    detail = F.concat_ws("/", "sex", "age_band", "tie_type", "segment")
    facts_shown = shown(fact, "enrolment", period_key=F.col("period_key"), carrier=named, locality=F.col("locality_code"), detail=detail,
                        value=F.col("active"), run_id=F.col("run_id"))
    known = carrier.where(F.col("carrier_sk") != layouts.UNKNOWN_KEY)
    places = locality.where(F.col("locality_sk") != layouts.UNKNOWN_KEY)
    return (
        facts_shown.unionByName(shown(known, "carrier", carrier=F.col("carrier_code"), detail=F.col("legal_name")))
        .unionByName(shown(places, "locality", locality=F.col("locality_code"), detail=F.col("locality_name")))
        .unionByName(shown(house.read("time"), "time", period_key=F.col("period_key")))
    )


STATE_VALUES = ", ".join(f"({i}, '{c}', '{n}', '{r}')" for i, (c, n, r) in enumerate(layouts.STATES))


def customer_states(spark, sf_dir):
    """Customers with a state code by nation; three nations have a code that no state has."""
    codes = F.array(*[F.lit(c) for c in layouts.STATE_CODES])
    nation = F.col("c_nationkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(nation < 22, F.element_at(codes, nation + 1)).otherwise("??").alias("state"),
        nation.cast("string").alias("locality_code"),
        F.concat(F.lit("place "), nation.cast("string")).alias("locality_name"),
    )


@proof(
    "state_lookup",
    f"""WITH s(i, code, name, region) AS (VALUES {STATE_VALUES})
SELECT coalesce(name, 'Não informado') AS state_name, coalesce(region, 'Não informado') AS region, count(*) AS customers
FROM customer LEFT JOIN s ON i = c_nationkey AND c_nationkey < 22 GROUP BY ALL""",
)
def state_lookup(spark, sf_dir):
    """Name and region of a state, with a default for unknown codes; counted before the lookup."""
    counted = customer_states(spark, sf_dir).groupBy("state").agg(F.count(F.lit(1)).alias("n"))
    named = counted.join(layouts.states(spark), "state", "left").fillna(
        layouts.NOT_INFORMED, ["state_name", "region"]
    )
    return named.groupBy("state_name", "region").agg(F.sum("n").alias("customers"))


@proof(
    "locality_members",
    f"""WITH s(i, code, name, region) AS (VALUES {STATE_VALUES})
SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS locality_code, 'place ' || c_nationkey AS locality_name, code AS state,
  name AS state_name, region FROM customer JOIN s ON i = c_nationkey WHERE c_nationkey < 22""",
)
def locality_members(spark, sf_dir):
    """Distinct localities of a batch; those without a valid state are left to the unknown member."""
    batch = customer_states(spark, sf_dir).withColumn(
        "state", F.when(F.col("state") == "??", layouts.UNKNOWN_STATE).otherwise(F.col("state"))
    )
    return loading.locality_members(batch, layouts.states(spark))


@proof(
    "type_members",
    """SELECT p_brand AS type_code, coalesce(min(p_type) FILTER (p_size > 40), 'Tipo ' || p_brand) AS type_label
FROM part WHERE p_brand <> 'Brand#3' GROUP BY 1""",
)
def type_members(spark, sf_dir):
    """Distinct facility types with the first label there is, or one made from the code."""
    batch = table(spark, sf_dir, "part").select(
        F.when(F.col("p_brand") != "Brand#3", F.col("p_brand")).alias("type_code"),
        F.when(F.col("p_size") > 40, F.col("p_type")).alias("type_label"),
    )
    return loading.type_members(batch)


@proof(
    "network_load",
    f"""WITH {sql.NETWORK}, b AS (SELECT DISTINCT period_key, l_partkey, l_partkey || '-' || l_suppkey AS facility, p_type, locality_sk
  FROM network WHERE {LOADED})
SELECT 'network' AS name, period_key, facility, p_type AS kind, 'p' || locality_sk AS locality,
  CAST(CASE period_key WHEN {LOAD_PERIOD} THEN 3 ELSE 2 END AS BIGINT) AS run_id
FROM b WHERE period_key <> {LOAD_PERIOD} OR l_partkey % 2 = 0
UNION ALL SELECT DISTINCT 'facility', NULL::INTEGER, facility, p_type, 'p' || locality_sk, NULL::BIGINT FROM b
UNION ALL SELECT DISTINCT 'type', NULL::INTEGER, NULL, p_type, NULL, NULL::BIGINT FROM b
UNION ALL SELECT DISTINCT 'locality', NULL::INTEGER, NULL, NULL, 'p' || locality_sk, NULL::BIGINT FROM b""",
)
def network_load(spark, sf_dir):
    """Two months of the network, then the first again in mode replace with the facilities of even parts only.

    Facts are shown under the natural keys that their surrogate keys lead to.
    """
    codes = F.array(*[F.lit(c) for c in layouts.STATE_CODES])
    batch = roles.network(spark, sf_dir).where(F.col("period_key").isin(LOAD_PERIOD, NEXT_PERIOD)).select(
        "period_key",
        "facility_code",
        F.concat(F.lit("facility "), "facility_code").alias("facility_name"),
        F.col("facility_type_sk").alias("type_code"),
        F.lit(None).cast("string").alias("type_label"),
        F.concat(F.lit("p"), F.col("locality_sk").cast("string")).alias("locality_code"),
        F.concat(F.lit("place "), F.col("locality_sk").cast("string")).alias("locality_name"),
        F.element_at(codes, (F.floor(F.col("locality_sk") / roles.DISTRICTS) + 1).cast("int")).alias("state"),
    )
    batch = materialise(batch, "batch")
    month = {p: batch.where(F.col("period_key") == p).drop("period_key") for p in (LOAD_PERIOD, NEXT_PERIOD)}
    house = Warehouse(spark, scratch_path(spark, "warehouse"))
    house.load_network(month[LOAD_PERIOD], LOAD_PERIOD, 1, FIRST_DAY)
    house.load_network(month[NEXT_PERIOD], NEXT_PERIOD, 2, SECOND_DAY)
    even = F.substring_index("facility_code", "-", 1).cast("bigint") % 2 == 0
    house.load_network(month[LOAD_PERIOD].where(even), LOAD_PERIOD, 3, SECOND_DAY, fact_mode="replace")
    unknown = layouts.UNKNOWN_KEY
    kinds = house.read("facility_type").where(F.col("facility_type_sk") != unknown).select("facility_type_sk", F.col("type_code").alias("kind"))
    places = house.read("locality").where(F.col("locality_sk") != unknown).select("locality_sk", F.col("locality_code").alias("locality"))
    known = house.read("facility").where(F.col("facility_sk") != unknown)
    named = known.select("facility_sk", F.col("facility_code").alias("facility"))
    fact = house.read("network").join(named, "facility_sk").join(kinds, "facility_type_sk").join(places, "locality_sk")
    members = known.join(kinds, "facility_type_sk").join(places, "locality_sk").withColumnRenamed("facility_code", "facility")

    def shown(df, name):
        kinds_of = {"period_key": "int", "facility": "string", "kind": "string", "locality": "string", "run_id": "bigint"}
        columns = [(F.col(c) if c in df.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds_of.items()]
        return df.select(F.lit(name).alias("name"), *columns)

    stacked = shown(fact, "network").unionByName(shown(members, "facility"))
    return stacked.unionByName(shown(kinds, "type")).unionByName(shown(places, "locality"))
