"""Reports, versions, identifiers and scope."""

import pytest

from staygrid.operators import compare
from staygrid.plans import comparison, scope
from staygrid.plans.identifiers import StayIds, candidate_space, load_stay_crosswalk
from staygrid.plans.versions import DatasetVersion, VersionPair, relationship, version_key, versions_equal

WIDE = "stay_id long, time long, hr double"
V = lambda v, how="explicit": DatasetVersion("d", v, how)


def _pair(spark):
    a = spark.createDataFrame([(1, 0, 80.0), (1, 1, None), (2, 0, 70.0), (2, 1, 71.0), (4, 0, 90.0)], WIDE)
    b = spark.createDataFrame([(1, 0, 80.0), (1, 1, None), (2, 0, 70.0), (2, 2, 72.0), (3, 0, 60.0)], WIDE)
    return a, b


def test_reproduction_accuracy(spark):
    per_stay = compare.per_stay_reproduction(*_pair(spark))
    rows = {r["stay_id"]: r for r in per_stay.collect()}
    assert rows[1]["content_identical"] and not rows[2]["content_identical"]
    assert (rows[2]["n_common_rows"], rows[2]["n_only_candidate_rows"], rows[2]["n_only_reference_rows"]) == (1, 1, 1)
    row = compare.reproduction_accuracy(per_stay).first()
    assert row["exact_stay_match_rate"] == 0.5
    assert row["row_content_disagreement_rate"] == pytest.approx(4 / 7)


def test_reports_of_empty_tables(spark):
    a, b = (df.where("false") for df in _pair(spark))
    assert compare.key_overlap(a, b).first()["n_common_keys"] == 0
    assert compare.reproduction_accuracy(compare.per_stay_reproduction(a, b)).first()["row_content_disagreement_rate"] is None
    assert compare.value_differences(a, b).first()["n_both_non_null"] == 0
    assert compare.coverage(a.drop("hr"), b).count() == 0


def test_window_reports_are_symmetric(spark):
    a, b = _pair(spark)
    one = compare.key_overlap(a, b).first()
    two = compare.key_overlap(b, a).first()
    assert one["n_only_candidate_keys"] == two["n_only_reference_keys"]
    assert one["n_common_keys"] == two["n_common_keys"]


def test_versions():
    assert version_key("v2.2.0") == version_key("2.2") == ("2", "2")
    assert versions_equal("2.2", None) is None and versions_equal("02.2", "2.2") is True
    with pytest.raises(ValueError):
        DatasetVersion("d", None, "explicit")
    assert VersionPair(V("2.2"), V("2.2.0", "provenance_file")).level(True) == "full_same_version"
    assert VersionPair(V("2.2"), V("3.1")).level(True) == "shared_subset_cross_version"
    assert VersionPair(V("2.2"), V("2.2", "reference_config")).level(True) == "shared_subset_unverified_version"
    assert VersionPair(V("2.2"), V("2.2")).level(False) == "not_comparable"


@pytest.mark.parametrize(
    ("counts", "expected"), [((3, 3, 3), "equal"), ((4, 3, 3), "candidate_superset"), ((3, 4, 3), "reference_superset"), ((3, 3, 2), "partial_overlap"), ((3, 3, 0), "not_directly_comparable")]
)
def test_relationship(counts, expected):
    assert relationship(*counts) == expected


def test_identifiers(spark):
    assert candidate_space("aumc", "raw_table") is None and candidate_space("AUMC", "events").startswith("omop")
    assert StayIds("x", "x").basis == "direct_identifier_match" and StayIds(None, None).basis == "side_by_side_only"
    rows = spark.createDataFrame([(1, 5), (2, 5)], "reference_stay_id long, candidate_stay_id long")
    with pytest.raises(ValueError):
        load_stay_crosswalk(rows)
    ids = StayIds(None, None, load_stay_crosswalk(spark.createDataFrame([(1, 2), (2, 1)], "reference_stay_id long, candidate_stay_id long")))
    mapped, unmapped = ids.translate(spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "stay_id long, x long"))
    assert {tuple(r) for r in mapped.collect()} == {(2, 10), (1, 20)} and [r[0] for r in unmapped.collect()] == [3]


def _compare(spark, versions, ids):
    hours = range(3)
    a = spark.createDataFrame([(s, t, 99.0 if (s, t) == (2, 1) else 80.0 + t, 70.0, 37.0) for s in (1, 2, 4) for t in hours], "stay_id long, time long, hr double, map double, temp double")
    b = spark.createDataFrame([(s, t, 80.0 + t, 70.0, 16.0) for s in (1, 2, 3) for t in hours], "stay_id long, time long, hr double, map double, resp double")
    w = spark.createDataFrame([(s, 0.0, 2.0) for s in (1, 2, 3)], "stay_id long, start double, end double")
    return comparison.compare_tables(a, b, w, ["hr", "map", "temp", "resp"], versions=versions, stay_ids=ids)


def test_full_scope_scores_everything(spark):
    out = _compare(spark, VersionPair(V("2.2"), V("2.2")), StayIds("s", "s"))
    assert out.claims["validation_level"] == "full_same_version" and out.claims["stay_comparison_confidence"] == "high"
    row = out.reports["reproduction_accuracy"].first()
    assert (row["n_common_stays"], row["n_only_reference_stays"], row["n_value_mismatch_rows"]) == (2, 1, 1)


def test_all_reports_share_one_join_of_the_tables(spark):
    from staygrid.operators.paired import Paired

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = _compare(spark, VersionPair(V("2.2"), V("2.2")), StayIds("s", "s"))
        held = [df for df in out.held if "_a" in df.columns and "_b" in df.columns]
        assert len(held) == 1
        for name, df in out.reports.items():
            joins = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "+- Join " in line or ":- Join " in line or line.startswith("Join ")]
            assert not [line for line in joins if "time#" in line], name  # by (stay, time): the one that is held
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        out.release()
    a, b = _pair(spark)
    odd = spark.createDataFrame([(None, 1, 2.0), (1, None, 3.0), (9, 9, 9.0), (9, 9, 8.0)], "stay_id long, time long, hr double")
    a, b = a.select("stay_id", "time", "hr").unionByName(odd), b.select("stay_id", "time", "hr").unionByName(odd.where("time is null or hr > 8"))
    pairs = Paired.of(a, b)
    same = lambda x, y: sorted(map(repr, x.collect())) == sorted(map(repr, y.select(*x.columns).collect()))
    assert same(pairs.key_overlap(), compare.key_overlap(a, b)) and same(pairs.stay_overlap(), compare.stay_overlap(a, b))
    assert same(pairs.common(), compare.on_common_keys(a, b)) and same(pairs.missingness(), compare.missingness(a, b))
    assert same(pairs.per_stay(), compare.per_stay_reproduction(a, b)) and same(pairs.value_differences(), compare.value_differences(a, b))
    some = a.where("stay_id = 1").select("stay_id")
    assert same(pairs.within(some).per_stay(), compare.per_stay_reproduction(a.where("stay_id = 1"), b.where("stay_id = 1")))


def test_cross_version_scores_what_is_shared(spark):
    out = _compare(spark, VersionPair(V("3.1"), V("2.2")), StayIds("s", "s"))
    assert out.claims["validation_level"] == "shared_subset_cross_version" and out.claims["comparison_scope"] == "shared_subset"
    row = out.reports["reproduction_accuracy"].first()
    assert (row["n_common_stays"], row["n_only_reference_stays"]) == (2, 0)
    listed = {tuple(r) for r in out.reports["scope_differences"].collect()}
    assert listed == {("stay", "4", "candidate_only"), ("stay", "3", "reference_only"), ("concept", "temp", "candidate_only"), ("concept", "resp", "reference_only")}


def test_other_spaces_are_not_comparable(spark):
    out = _compare(spark, VersionPair(V("2.2"), V("2.2")), StayIds("s", "t"))
    assert out.claims["validation_level"] == "not_comparable" and "window_summary" not in out.reports
    assert out.reports["scope_overlap"].where("dimension = 'stays'").first()["n_shared"] is None
    assert {r["side"] for r in out.reports["scope_differences"].where("dimension = 'stay'").collect()} == {"candidate", "reference"}


def test_crosswalk_is_a_shared_subset(spark):
    walk = load_stay_crosswalk(spark.createDataFrame([(1, 2), (2, 1)], "reference_stay_id long, candidate_stay_id long"))
    out = _compare(spark, VersionPair(V("2.2"), V("2.2")), StayIds("s", "t", walk))
    assert out.claims["validation_level"] == "shared_subset_stay_crosswalk"
    assert out.claims["n_scope_reference_stays_without_crosswalk"] == 1
    assert scope.full_scope(VersionPair(V("2.2"), V("2.2")), StayIds("s", "t", walk)) is False


def test_medians_equal_exact_ones(spark):
    import math
    import random
    import statistics

    from staygrid.operators.selection import medians

    r = random.Random(4)
    groups = {"one": [3.0], "two": [1.0, 2.0], "ties": [5.0] * 1000 + [7.0] * 999, "even": [float(i) for i in range(40_000)], "odd": [r.random() for _ in range(30_001)], "halves": [1.0] * 500 + [2.0] * 500}
    groups["skewed"] = [r.expovariate(1) ** 8 for _ in range(20_000)]
    rows = [(k, v) for k, values in groups.items() for v in values]
    r.shuffle(rows)
    rows += [("nan", math.nan)] * 3 + [("nan", 1.0)] * 2 + [("some", math.nan)] * 2 + [("some", 1.0)] * 3
    got = dict(medians(spark.createDataFrame(rows, "k string, v double").repartition(5), "k", "v").collect())
    for k, values in groups.items():
        assert got[k] == statistics.median(values), k
    assert math.isnan(got["nan"]) and got["some"] == 1.0 and len(got) == len(groups) + 2
    assert medians(spark.createDataFrame([], "k string, v double"), "k", "v").count() == 0


def test_column_medians_in_several_rounds(spark):
    """A million different values, ties that hold a third of the rows, and bounds that force rounds."""
    from pyspark.sql import functions as F

    from staygrid.operators.selection import column_medians

    n = 1_000_000
    rows = spark.range(n, numPartitions=8).select(
        F.pmod(F.col("id") * 7919 + 13, F.lit(n)).cast("double").alias("different"),
        F.when(F.col("id") % 3 == 0, 5e5).otherwise(F.pmod(F.col("id") * 104_729, F.lit(n)).cast("double")).alias("tied"),
        F.when(F.col("id") % 2 == 0, -1.0).otherwise(1.0).alias("halves"),
        F.when(F.col("id") % 5 == 0, F.pow(F.col("id").cast("double"), 9)).alias("skewed"),
        F.when(F.col("id") % 2 == 0, float("inf")).otherwise(F.col("id").cast("double")).alias("infinite"),
        F.lit(None).cast("double").alias("unknown"), F.when(F.col("id") > 3, float("nan")).otherwise(1.0).alias("numberless"),
    ).persist()
    want = rows.select(*[F.median(c).alias(c) for c in rows.columns]).first().asDict()
    for bound in (50, 1000, 100_000):
        totals, found = column_medians(rows, {c: F.col(c) for c in rows.columns}, [F.max("different").alias("most")], bound)
        got = dict(found.collect())
        assert totals["most"] == n - 1 and "unknown" not in got and got.pop("numberless") != 0
        assert got == {c: want[c] for c in got} and len(got) == 5, bound
    rows.unpersist()


def test_value_differences_read_the_join_once_a_pass(spark):
    from staygrid.operators import compare

    a, b = (spark.range(100).selectExpr("id stay_id", "id % 24 time", f"id * {k}D x", "cast(null as double) y") for k in (1, 3))
    out = compare.value_differences(a, b)
    assert out._jdf.queryExecution().sparkPlan().toString().count("Join") <= 3
    got = {r["concept"]: r.asDict() for r in out.collect()}
    assert (got["x"]["n_both_non_null"], got["x"]["median_abs_diff"], got["y"]["n_both_non_null"], got["y"]["median_abs_diff"]) == (100, 99.0, 0, None)


def test_window_against_stays(spark):
    from datetime import datetime, timedelta

    from staygrid.operators.validate import against_stays

    t0 = datetime(2150, 1, 1)
    stays = spark.createDataFrame([(1, 10, 100, t0, t0 + timedelta(hours=2, minutes=30)), (2, 20, 200, t0, None)], "subject_id long, hadm_id long, stay_id long, intime timestamp_ntz, outtime timestamp_ntz")
    wide = spark.createDataFrame([(100, t) for t in range(3)], "stay_id long, time long")
    for rounding, end in (("floor", 2), ("ceil", 3)):
        got = {r["stay_id"]: r for r in against_stays(wide, stays, rounding).collect()}
        assert list(got[100].asDict()) == ["subject_id", "hadm_id", "stay_id", "intime", "outtime", "los_hours", "expected_start", "expected_end", "dyn_start", "dyn_end", "dyn_n_timepoints", "diff_start", "diff_end"]
        assert (got[100]["los_hours"], got[100]["expected_end"], got[100]["dyn_n_timepoints"], got[100]["diff_start"], got[100]["diff_end"]) == (2.5, end, 3, 0, 2 - end)
        assert (got[200]["los_hours"], got[200]["expected_end"], got[200]["dyn_end"], got[200]["diff_end"]) == (None, None, None, None)


def test_an_inventory_of_pairs_follows_the_same_rules(spark):
    """Every combination, against the rules for one pair."""
    from itertools import product

    from staygrid import registry
    from staygrid.plans import inventory
    from staygrid.plans.versions import STATED, resolve_reference

    texts = [None, "v2.2", " 2.2.0", "02.2", "3.1", "3.1-demo", "0", "0.0"]
    sources = ["explicit", "manual_default", "unknown", None]
    sizes = [(3, 3, 3), (4, 3, 3), (3, 4, 3), (3, 3, 2), (3, 3, 0), (None, None, None)]
    spaces = [("mimic-iv", "raw_table", "miiv"), ("AUMC", "events", "aumc"), ("nothing", "raw_table", "none"), (None, None, None)]
    rows = [(*space[:2], a, sa, space[2], b, sb, walk, *size) for a, b, sa, sb, size, space, walk in product(texts[:5], texts, sources, sources[:2], sizes[::2], spaces, (True, False, None))]
    rows += [("mimic-iv", "raw_table", "2.2", "explicit", "miiv", "2.2", "explicit", False, *size) for size in sizes]
    types = ["string"] * 7 + ["boolean"] + ["long"] * 3
    pairs = spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(inventory.PAIR, types, strict=True)))
    for r in inventory.assess(pairs).collect():
        a, b = r["candidate_version"], r["reference_version"]
        same = versions_equal(a, b)
        assert r["same_version"] is same
        known = [v is not None and s in STATED for v, s in ((a, r["candidate_version_source"]), (b, r["reference_version_source"]))]
        assert r["versions_verified"] == all(known)
        mine = candidate_space(r["candidate_dataset"] or "", r["candidate_stay_source"] or "")
        ids = StayIds(mine, registry.REFERENCE_STAY_SPACES.get(r["reference_source"]), pairs if r["has_crosswalk"] else None)
        assert r["candidate_stay_id_space"] == mine and r["stay_comparison_basis"] == ids.basis
        pair = VersionPair(*(V(v or "1", "explicit" if k else "manual_default") for v, k in zip((a, b), known, strict=True)))
        comparable, full = ids.matchable and bool(r["n_shared"]), all(known) and same is True and ids.basis == "direct_identifier_match"
        both = all(known) and same is True
        want = "shared_subset_stay_crosswalk" if comparable and both and not full else pair.level(comparable) if all(known) or not comparable else "shared_subset_unverified_version"
        assert r["validation_level"] == want, r
        assert r["comparison_scope"] == ("full" if full else "shared_subset")
        sizes_of = (r["n_candidate"], r["n_reference"], r["n_shared"])
        assert r["stay_relationship"] == relationship(*sizes_of, ids.matchable)
    from pyspark.sql import functions as F

    given = spark.createDataFrame([("1", "2", "3", "miiv"), (None, "2", "3", "miiv"), ("", None, "3", "miiv"), (None, None, None, "miiv"), (None, None, None, "nowhere")], "explicit string, declared string, address string, source string")
    version, how = inventory.reference_evidence(*[F.col(c) for c in given.columns])
    got = [tuple(r) for r in given.select(version, how).collect()]
    supposed = resolve_reference("miiv")
    assert got == [("1", "explicit"), ("2", "provenance_file"), ("3", "reference_config"), (supposed.version, supposed.source), (None, "unknown")]
