from __future__ import annotations

import math
import random
import struct

import pandas as pd
import pytest
from pyspark.sql import functions as F

from coverlens.operators import dedupe, dimensions, facts, grain, lookups, profile, quality, ranking, shape
from coverlens.operators.quality import ERROR, WARNING, Rule


def pairs(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))


# Shape


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(shape.LayoutError, match="'b'"):
        shape.require_columns(df, ["a", "b"])


def test_rename_known_coalesces_and_requires(spark):
    df = spark.createDataFrame([(None, "x"), ("y", "z")], "A string, B string")
    named = shape.rename_known(df, {"A": "s", "B": "s", "C": "t"}, ["s"])
    assert pairs(named) == [("x",), ("y",)]
    with pytest.raises(shape.LayoutError):
        shape.rename_known(df, {"A": "s"}, ["t"])


def test_stack_by_name_fills_absent_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3,)], "y int")
    assert pairs(shape.stack_by_name([a, b])) == [(1, 2), (None, 3)]


def test_assert_absent(spark):
    with pytest.raises(shape.LayoutError):
        shape.assert_absent(spark.createDataFrame([(1,)], "phone int"), ["phone"])


# Duplicates and grain


def test_exact_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert dedupe.exact_duplicate_counts(df).first().asDict() == {
        "rows_read": 3, "distinct_rows": 2, "exact_duplicates": 1,
    }
    assert dedupe.drop_exact_duplicates(df).count() == 2


def test_keep_first_and_flags_agree_with_pandas(spark):
    rng = random.Random(5)
    data = pd.DataFrame({"k": [rng.choice(["a", "a", "a", "b", "c", None]) for _ in range(300)], "pos": range(300)})
    df = spark.createDataFrame([(k, p) for k, p in data.itertuples(index=False)], "k string, pos int")
    firsts = {p for _, p in data.drop_duplicates(subset=["k"]).itertuples(index=False)}
    assert {r["pos"] for r in dedupe.keep_first(df, ["k"], ["pos"]).collect()} == firsts
    counted = dedupe.keep_first_counted(df, ["k"], ["pos"], "n").collect()
    assert {r["pos"] for r in counted} == firsts and sum(r["n"] for r in counted) == 300
    flagged = dedupe.flag_repeats(df, ["k"], ["pos"], "again").collect()
    assert {r["pos"] for r in flagged if not r["again"]} == firsts and len(flagged) == 300


def test_keep_first_cuts_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 3 as k", "id")
    plan = dedupe.keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_grain_sum_keeps_null_groups(spark):
    df = spark.createDataFrame([("a", 10), ("a", 5), (None, 1), (None, 2)], "g string, m long")
    assert pairs(grain.sum_to_grain(df, ["g"], ["m"])) == [("a", 15), (None, 3)]
    assert pairs(grain.grain_violations(df, ["g"])) == [("a", 2), (None, 2)]


def test_conservation(spark):
    a = spark.createDataFrame([(1, 2), (3, 4)], "x long, y long")
    b = spark.createDataFrame([(4, 5)], "x long, z long")
    assert pairs(grain.conservation(a, b, {"x": "x", "y": "z"})) == [("x", 4, 4, 0), ("y", 6, 5, 1)]


def test_counts_by_category(spark):
    df = spark.createDataFrame([("b",), ("b",), ("zz",)], "c string")
    assert pairs(grain.counts_by_category(df, "c", ["a", "b"])) == [(0, "a", 0), (1, "b", 2)]


# Joins


def test_lookup_default_and_membership(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "code string")
    dim = spark.createDataFrame([("a", 7)], "code string, sk long")
    assert pairs(lookups.lookup_key(df, dim, ["code"], "sk")) == [("a", 7), ("z", -1), (None, -1)]
    assert pairs(lookups.flag_member(df, "code", dim, "code", "known")) == [("a", True), ("z", False), (None, False)]


def test_changed_rows_treats_null_as_blank(spark):
    old = spark.createDataFrame([(1, None, 5), (2, "a", 5), (3, "a", None)], "k int, t string, n int")
    new = spark.createDataFrame([(1, "", 5), (2, "b", 5), (3, "a", 1)], "k int, t string, n int")
    assert [r["k"] for r in lookups.changed_rows(old, new, ["k"], ["t", "n"]).orderBy("k").collect()] == [2, 3]


# Ranking


def test_ordered_keys_of_doubles(spark):
    """Bits of every kind of double, next to all powers of two, in the order of the values."""
    draw = random.Random(1)
    values = [0.0, -0.0, 1.0, -1.0, math.inf, -math.inf, math.nan, 1.7976931348623157e308, 0.1, -0.1]
    values += [math.nextafter(2.0**e, to) for e in range(-1060, 1023) for to in (0, math.inf)] + [-(2.0**e) for e in range(-1074, 1024)]
    values += [struct.unpack(">d", draw.getrandbits(64).to_bytes(8, "big"))[0] for _ in range(2000)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    pairs = [(r["v"], r["k"]) for r in profile.with_ordered_key(frame, "v", "k").collect()]
    assert all(v == profile.value_of_key(k) or (math.isnan(v) and math.isnan(profile.value_of_key(k))) for v, k in pairs)
    plain = sorted((k, v) for v, k in pairs if not math.isnan(v))
    assert [v for _, v in plain] == sorted(v for v, _ in pairs if not math.isnan(v))
    assert min(k for v, k in pairs if math.isnan(v)) > plain[-1][0]


@pytest.mark.parametrize("digit", [4, 16])
def test_ranks_by_radix_selection(spark, digit, monkeypatch):
    monkeypatch.setattr(profile, "DIGIT", digit)
    draw = random.Random(2)
    a = [draw.choice([draw.gauss(0, 1e-3), draw.gauss(0, 1e6), 5.0, -5.0, 1e300, 7.0]) for _ in range(3000)] + [None] * 5
    frame = spark.createDataFrame([(x, i % 3, None) for i, x in enumerate(a)], "a double, b int, c double")
    every = list(range(0, 3000, 37)) + [2999]
    found = profile.select_ranks(frame, {"a": lambda n: every, "b": lambda n: [0, n // 2, n - 1], "c": lambda n: [0]})
    wanted = sorted(x for x in a if x is not None)
    assert [found["a"][k] for k in every] == [wanted[k] for k in every]
    assert sorted(found["b"].values()) == [0.0, 1.0, 2.0] and found["c"] == {}
    assert "Sort" not in profile.profile_numbers(frame)._jdf.queryExecution().toString()
    assert profile.above_fence(frame.where("false"), "a").count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_spread_rank_is_the_plain_rank(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["g", "g", "h", None]), rng.choice([0, 1, 5, -3, None, rng.randrange(10**9)])) for _ in range(400)]
    df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(rows)], "g string, v long, i int")
    got = ranking.rank_spread(df, ["g"], "v", rank="r", dense_rank="d", group_total="t")
    from pyspark.sql import Window

    w = Window.partitionBy("g").orderBy(F.desc("v"))
    wanted = df.select("*", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"),
                       F.sum("v").over(Window.partitionBy("g")).alias("t"))
    assert pairs(got) == pairs(wanted)


@pytest.mark.parametrize("kind", ["double", "decimal(12,2)"])
def test_ranks_across_the_borders_of_tasks(spark, kind):
    """One group and one value with most of the rows, cut over 16 tasks."""
    from pyspark.sql import Window

    draw = random.Random(7)
    odd = [0.0, -0.0, None] + ([math.nan, math.inf, -math.inf] if kind == "double" else [])
    rows = [(draw.choice([1, 1, 1, 1, None, 2]), draw.choice(["x", None]), draw.choice([7.0, 7.0, 7.0, 7.0, *odd, draw.randrange(20)])) for _ in range(3000)]
    rows = [(g, h, v if v is None else float(v), i) for i, (g, h, v) in enumerate(rows)] + [(1, "x", 7.0, 5000)] * 300
    df = spark.createDataFrame(rows, "g int, h string, v double, i int").withColumn("v", F.col("v").cast(kind))
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = ranking.rank_spread(df, ["g", "h"], "v", rank="r", dense_rank="d")
        none = ranking.rank_spread(df.where("false"), ["g"], "v", rank="r", group_total="t")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    w = Window.partitionBy("g", "h").orderBy(F.desc("v"))
    wanted = df.select("*", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"))
    shown = F.col("v").cast("string")  # a value that is no number does not equal itself
    assert pairs(got.withColumn("v", shown)) == pairs(wanted.withColumn("v", shown))
    assert none.columns == ["g", "h", "v", "i", "r", "t"] and none.count() == 0
    assert "Window" not in got._jdf.queryExecution().toString()


def test_previous_loaded_period(spark):
    df = spark.createDataFrame([(202401, 1), (202404, 2)], "p int, v long")
    assert pairs(ranking.with_previous(df, "v", "p")) == [(202401, 1, None), (202404, 2, 1)]


def test_top_n_drops_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 9)], "k int, v int")
    assert pairs(ranking.top_n(df, 1, F.desc("v"), drop_null=["v"])) == [(3, 9)]


# Quality


def test_errors_reject_and_warnings_keep(spark, tmp_path):
    df = spark.createDataFrame([(10,), (-5,), (3,), (-1,)], "v int")
    error = Rule("neg", "below zero", ERROR, F.col("v") < 0)
    outcome = quality.validate(df, [error], str(tmp_path / "a"))
    assert (outcome.accepted_count, outcome.rejected_count) == (2, 2)
    assert outcome.accepted.count() == 2 and outcome.rejected.count() == 2
    warning = Rule("neg", "below zero", WARNING, F.col("v") < 0)
    kept = quality.validate(df.limit(2), [warning], str(tmp_path / "b"))
    assert kept.accepted_count == 2 and kept.counts.first()["violated"] == 1


def test_two_broken_rules_reject_once_and_name_the_first(spark):
    df = spark.createDataFrame([(-1,)], "v int")
    rules = [Rule("first", "f", ERROR, F.col("v") < 0), Rule("second", "s", ERROR, F.col("v") < 5)]
    flagged = quality.evaluate(df, rules)
    rejected = quality.rejected_rows(flagged).collect()
    assert [(r["rule"], r["record"]["v"]) for r in rejected] == [("first", -1)]
    assert [r["violated"] for r in quality.rule_counts(flagged, rules).collect()] == [1, 1]


def test_null_condition_does_not_violate(spark):
    df = spark.createDataFrame([(None,)], "v int")
    assert quality.accepted_rows(quality.evaluate(df, [Rule("r", "r", ERROR, F.col("v") < 0)])).count() == 1


def test_reference_rule_is_off_without_a_reference(spark):
    df = spark.createDataFrame([("a",)], "c string")
    empty = spark.createDataFrame([], "c string")
    for reference in (None, empty):
        mark = quality.not_in_reference("c", reference, "c")
        assert mark(df, "bad").first()["bad"] is False


def test_several_names_skips_unknown_state(spark):
    df = spark.createDataFrame(
        [("1", "a", "RR"), ("1", "b", "RR"), ("2", "a", "XX"), ("2", "b", "XX"), (None, "a", "RR"), (None, "b", "RR")],
        "code string, name string, state string",
    )
    mark = quality.several_names("code", "name", skip=F.col("state") == "XX")
    assert {(r["code"], r["bad"]) for r in mark(df, "bad").collect()} == {("1", True), ("2", False), (None, False)}


# Dimensions and facts


def test_keys_are_dense_and_repeatable(spark):
    df = spark.range(5000).selectExpr("cast(id as string) as k")
    a = {r["k"]: r["sk"] for r in dimensions.assign_keys(df, ["k"], "sk", 10).collect()}
    b = {r["k"]: r["sk"] for r in dimensions.assign_keys(df.repartition(7), ["k"], "sk", 10).collect()}
    assert a == b and sorted(a.values()) == list(range(11, 5011))


SCD = "sk long, code string, name string, kind string, note string, valid_from date, valid_to date, is_current boolean"


def test_type2_history(spark):
    empty = spark.createDataFrame([], SCD)
    first = spark.createDataFrame([("1", "A", None, "n"), ("2", "B", "x", "n")], "code string, name string, kind string, note string")

    def load(dim, rows, day, **more):
        return dimensions.upsert_type2(dim, rows, "code", ["name", "kind"], ["note"], "sk", day, **more)

    one = load(empty, first, "2024-01-01")
    same = load(one, first.withColumn("kind", F.coalesce("kind", F.lit(""))), "2024-02-01")
    assert pairs(same) == pairs(one)
    second = spark.createDataFrame([("1", "A2", None, "m"), ("3", "C", "y", "m")], first.schema)
    two = load(one, second, "2024-02-01")
    rows = {(r["code"], r["name"]): r for r in two.collect()}
    assert not rows["1", "A"]["is_current"] and str(rows["1", "A"]["valid_to"]) == "2024-02-01"
    assert rows["1", "A2"]["is_current"] and rows["3", "C"]["is_current"] and rows["2", "B"]["is_current"]
    assert len({r["sk"] for r in two.collect()}) == 4
    assert dimensions.current_violations(two, "code").isEmpty()
    closed = load(one, second, "2024-02-01", close_missing=True)
    assert [r["is_current"] for r in closed.where("code = '2'").collect()] == [False]
    again = load(two, second.withColumn("name", F.lit("Z")), "2024-02-01")
    assert {r["name"] for r in again.where("is_current and code <> '2'").collect()} == {"Z"}
    assert again.count() == two.count()
    fresh = load(one, first.withColumn("note", F.lit("new")), "2024-03-01", refresh_others=True)
    assert {r["note"] for r in fresh.collect()} == {"new"} and fresh.count() == 2


def test_fact_upsert_is_idempotent_and_blank_is_null(spark):
    fact = spark.createDataFrame([(1, None, 5), (2, "a", 7)], "k int, s string, v long")
    staged = spark.createDataFrame([(1, "", 6), (3, None, 1)], "k int, s string, v long")
    once = facts.upsert_fact(fact, staged, ["k", "s"], ["v"], ["s"])
    assert pairs(once) == [(1, None, 6, "UPDATE"), (2, "a", 7, "KEEP"), (3, None, 1, "INSERT")]
    twice = facts.upsert_fact(once.drop("_action"), staged, ["k", "s"], ["v"], ["s"])
    assert pairs(twice.drop("_action")) == pairs(once.drop("_action"))
    assert {r["action"]: r["rows"] for r in facts.action_counts(twice).collect()} == {"UPDATE": 2, "KEEP": 1}
    replaced = facts.upsert_fact(fact, staged, ["k", "s"], ["v"], ["s"], mode="replace")
    assert {r["k"] for r in replaced.collect()} == {1, 3}


# Profile


@pytest.mark.parametrize("seed", range(3))
def test_exact_quantiles_against_pandas(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([0.0, 1.0, None, rng.gauss(0, 50), 1e6]) for _ in range(rng.randrange(3, 400))]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "a double, b int")
    got = {r["column"]: r["quantiles"] for r in profile.exact_quantiles(df, ["a", "b"], (0.1, 0.25, 0.9)).collect()}
    frame = pd.DataFrame({"a": values, "b": range(len(values))})
    for c in ("a", "b"):
        assert got[c] == pytest.approx(frame[c].quantile([0.1, 0.25, 0.9]).tolist())


def test_profile_matches_describe(spark):
    frame = pd.DataFrame({"n": [1, 2, 3, 10], "t": ["x", "x", "y", None]})
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (10, None)], "n int, t string")
    row = profile.profile_numbers(df).first()
    wanted = frame["n"].describe()
    got = [row[c] for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")]
    assert got == pytest.approx(wanted.tolist())
    assert tuple(profile.profile_texts(df).first()) == ("t", 3, 2, "x", 2)
    assert pairs(profile.null_counts(df)) == [("n", 0), ("t", 1)]


def test_exported_marts_read_each_fact_once(spark, tmp_path):
    """The facts are counted while they are read: eight marts, one reading each, also with null keys and repeated rows."""
    from coverlens.plans import marts
    from coverlens.plans.star import Star

    enrolled = [(202401, 1, 1, 5), (202401, 1, 1, 5), (202401, 2, None, 7), (202402, None, 2, 1), (202402, 2, 2, None)]
    open_facilities = [(202401, "T", 1, 1), (202401, "T", 2, 1), (202402, None, 2, 1), (202402, "U", None, 1)]
    read = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def counted(rows, schema, seen):
        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return spark.createDataFrame(rows, schema).mapInArrow(count, schema)

    star = Star(
        enrolment=counted(enrolled, "period_key int, carrier_sk long, locality_sk long, active long", read[0]),
        network=counted(open_facilities, "period_key int, facility_type_sk string, locality_sk long, facilities long", read[1]),
        locality=spark.createDataFrame([(i, str(i), f"p{i}", "S", "State", "R") for i in (1, 2)], "locality_sk long, locality_code string, locality_name string, state string, state_name string, region string"),
        carrier=spark.createDataFrame([(i, f"c{i}", "n", "k") for i in (1, 2)], "carrier_sk long, carrier_code string, legal_name string, kind string"),
        facility_type=spark.createDataFrame([("T", "T", "t"), ("U", "U", "u")], "facility_type_sk string, type_code string, type_label string"),
    )
    stars = marts.exported_stars(star)
    names = [n for n in marts.EXPORTED if n != "run_history"]
    found = {n: sorted(map(str, marts.MARTS[n](stars[n]).collect())) for n in names}
    assert [a.value for a in read] == [len(enrolled), len(open_facilities)]
    assert found == {n: sorted(map(str, marts.MARTS[n](star).collect())) for n in names}
    assert set(stars) == set(marts.EXPORTED)
