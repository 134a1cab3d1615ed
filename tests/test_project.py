"""Builds on a synthetic project tree: layout, versions, provenance, review, command line."""

from datetime import datetime, timedelta

import pytest

from staygrid import cli, registry
from staygrid.operators import items
from staygrid.plans import build, review
from staygrid.plans.versions import DatasetVersion, VersionPair, resolve_candidate, resolve_reference
from staygrid.sources import layout, sinks
from staygrid.sources.concept_dict import ConceptDict
from staygrid.sources.config import BuildConfig, load_config
from staygrid.streaming.hourly import hourly_stream

T0 = datetime(2150, 1, 1)
EVENT = "subject_id long, time timestamp_ntz, numeric_value float, dataset_version string"


def _write(spark, path, rows, schema):
    path.parent.mkdir(parents=True, exist_ok=True)
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(path))


@pytest.fixture(scope="module")
def project(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("project")
    (root / "datasets").mkdir()
    ws = root / "workspace"
    _write(spark, ws / "concept/heart_rate/1.0.0/hirid.parquet", [(7, T0 + timedelta(hours=2, minutes=30), 80.0, "1.1.1"), (7, T0 + timedelta(hours=99), 1.0, "1.1.1")], EVENT)
    _write(spark, ws / "concept/nested/text/1.0.0/hirid.parquet", [(7, T0 + timedelta(hours=1), None, "1.1.1")], EVENT)
    _write(spark, ws / "extraction/hirid/1.1.1/general/ICU_ADMISSION.parquet", [(7, T0)], "subject_id long, time timestamp_ntz")
    _write(spark, ws / "extraction/hirid/1.1.1/observations/OBSERVATION.parquet", [(7, T0 + timedelta(hours=9, minutes=30))], "subject_id long, time timestamp_ntz")
    return root


def test_layout(spark, project, tmp_path):
    ws = project / "workspace"
    assert layout.workspace_of(project) == ws.resolve() and layout.workspace_of(ws / "concept") == ws.resolve()
    assert [c.name for c in layout.discover_concepts(ws / "concept", "hirid")] == ["heart_rate", "nested/text"]
    assert layout.find_concept(ws / "concept", "heart_rate", "hirid", "1.0.0").name == "hirid.parquet"
    assert layout.extracted_versions(ws, "hirid") == ["1.1.1"]
    assert layout.path_version("/x/mimiciv/2.2/icu/icustays.csv.gz") == "2.2"
    assert layout.path_version("/x/mimic-iv-3.1/icu/icustays.csv.gz", "mimic-iv") == "3.1"
    assert layout.path_version("/srv/1.0/data/miiv/icustays.csv.gz", "mimic-iv") is None
    with pytest.raises(FileNotFoundError):
        layout.find_step_file(ws, "hirid", "NOTHING.parquet")


def test_stay_tables_are_never_mixed(spark, tmp_path):
    for v in ("2.2", "3.1"):
        path = tmp_path / "mimiciv" / v / "icu" / "icustays.csv.gz"
        path.parent.mkdir(parents=True)
        path.write_bytes(b"")
    env = {"STAYGRID_DATA_ROOT": str(tmp_path)}
    assert "3.1" in str(layout.resolve_stay_table("mimic-iv", wanted="3.1", environment=env).path)
    with pytest.raises(ValueError):
        layout.resolve_stay_table("mimic-iv", environment=env)
    with pytest.raises(ValueError):
        layout.resolve_stay_table("mimic-iv", explicit=tmp_path / "mimiciv/2.2/icu/icustays.csv.gz", wanted="3.1")
    for name in ("aumc", "sic"):
        with pytest.raises(ValueError):
            layout.require_raw_table(name)
    for name in ("hirid", "sicdb"):
        with pytest.raises(ValueError):
            layout.require_event_stays(name)


def test_build_variables_and_provenance(spark, project):
    ws = project / "workspace"
    config = BuildConfig(concept_root=ws / "concept", dataset="hirid", variables=["hr", "temp"], grid=True, output=project / "out/wide.parquet", missing="ignore")
    export = build.write_variables(spark, config)
    rows = {r["time"]: r["hr"] for r in spark.read.parquet(str(export.path)).collect()}
    assert rows[2] == 80.0 and len(rows) == 10
    notes = sinks.read_provenance(spark, export.path)
    assert notes["version"] == "1.1.1" and notes["stay_id_space"] == "hirid:general.patientid"
    spark.createDataFrame([(1, 0)], "stay_id long, time long").write.mode("overwrite").parquet(str(export.path))
    with pytest.raises(sinks.StaleProvenanceError):
        sinks.read_provenance(spark, export.path)
    sinks.attach_provenance(spark, export.path, {"dataset": "hirid"})
    assert sinks.read_provenance(spark, export.path)["dataset"] == "hirid"
    sinks.write_table(spark.range(1), export.path, None)
    assert sinks.read_provenance(spark, export.path) is None
    with pytest.raises(FileNotFoundError):
        build.write_variables(spark, BuildConfig(concept_root=ws / "concept", dataset="hirid", variables=["temp"], output=project / "x", missing="fail"))


def test_build_all_keeps_empty_concepts(spark, project):
    export = build.write_all(spark, "hirid", project, max_hours=168)
    table = spark.read.parquet(str(export.path))
    assert table.columns == ["stay_id", "time", "heart_rate", "nested/text"] and table.count() == 10
    assert export.manifest.read_text().count("\n") == 3


def test_one_version_is_selected(spark, project, tmp_path):
    rows = [(1, T0, 80.0, "1.5.0"), (1, T0, 81.0, "1.6.0")]
    table = spark.createDataFrame(rows, EVENT)
    with pytest.raises(ValueError):
        resolve_candidate("hirid", [table], tmp_path)
    assert resolve_candidate("hirid", [table], tmp_path, "v1.6").version == "1.6.0"
    with pytest.raises(ValueError):
        resolve_candidate("hirid", [table], tmp_path, "9")
    assert resolve_candidate("hirid", [table.drop("dataset_version")], project / "workspace").source == "extraction_dirs"
    assert resolve_reference("aumc").source == "manual_default" and resolve_reference("nothing").version is None
    stays = spark.createDataFrame([(1, 1, T0, T0 + timedelta(hours=2))], "subject_id long, stay_id long, intime timestamp_ntz, outtime timestamp_ntz")
    out = build.build_variables({"hr": table}, build.Stays(stays), "mimic-iv", version="1.6.0").first()
    assert out["hr"] == 81.0


def test_metadata_and_config(spark, tmp_path):
    meta = ConceptDict({"hr": {"sources": {"x": [{"min": True, "max": 5}]}, "min": 0, "aggregate": "max"}, "bad": 3})
    assert meta.bounds("hr") == (0.0, 5.0) and meta.aggregate("hr") == "max" and meta.aggregate("bad", "median") == "median"
    (tmp_path / "vars.yml").write_text("dynamic_vars: [hr, temp]\n")
    (tmp_path / "c.yml").write_text("concepts: {path: data, version: 1.0, dataset: hirid}\nwide: {dynamic_vars: vars.yml}\ngrid: {include: true, max_hours: -1}\noutput: {path: out.parquet}\n")
    config = load_config(tmp_path / "c.yml")
    assert config.variables == ["hr", "temp"] and config.max_hours is None and config.version == "1.0" and config.output == tmp_path / "out.parquet"
    (tmp_path / "d.yml").write_text("concepts: {}\n")
    with pytest.raises(ValueError):
        load_config(tmp_path / "d.yml")


def test_registry():
    assert len(registry.DYNAMIC_CONCEPTS) == 48
    assert registry.reference_source("eicu") == "eicu" and registry.known_dataset("mimic-demo") == "mimic-iii-demo"
    for bad in ("mimic-iv-demo", "what"):
        with pytest.raises(ValueError):
            registry.reference_source(bad)


def test_item_review(spark, tmp_path):
    code = "subject_id long, time long, numeric_value double, table string, source_code string"
    rows = [(1, 0, 1.0, "chart", "CHART//220045//Heart Rate//bpm"), (1, 1, 1.0, "chart", "CHART//220045//Heart Rate//bpm"), (1, 2, 1.0, None, "CHART//999//New//bpm"), (1, 3, 1.0, None, "free text")]
    meta = ConceptDict({"hr": {"sources": {"miiv": [{"ids": [220045, 1], "table": "t", "sub_var": "itemid"}, {"class": "fun_itm", "table": "t"}]}}})
    versions = VersionPair(DatasetVersion("mimic-iv", "2.2", "explicit"), DatasetVersion("reference:miiv", "2.2", "explicit"))
    seen = spark.createDataFrame([("hr", "220045", 10)], "concept string, item_id string, n_rows long")
    out = review.build_review(spark, "mimic-iv", {"hr": spark.createDataFrame(rows, code)}, meta, versions, ["hr", "temp"], seen=seen)
    got = {(r["item_id"], r["side"]): r for r in out.items.collect()}
    assert got["220045", "both"]["item_status"] == "shared" and got["220045", "both"]["candidate_n_rows"] == 2 and got["220045", "both"]["item_label"] == "Heart Rate//bpm"
    assert got["220045", "both"]["reference_observed"] and got["1", "reference"]["reference_observed"] is False
    assert got["999", "candidate"]["item_status"] == "candidate_only" and got["free text", "candidate"]["item_status"] == "not_directly_comparable"
    assert got["fun_itm:t", "reference"]["item_status"] == "reference_only"
    summary = {r["concept"]: r for r in out.summary.collect()}
    assert summary["hr"]["n_shared"] == 1 and summary["hr"]["relationship"] == "partial_overlap" and not summary["temp"]["candidate_concept_found"]
    path, _ = review.write_review(spark, out, tmp_path)
    assert path.is_dir() and "reviewer_verdict" in spark.read.csv(str(path), header=True).columns
    old = spark.createDataFrame([("hr", "both", "220045", "accept", "fine", "me")], "concept string, side string, item_id string, reviewer_verdict string, reviewer_comment string, reviewer_name string")
    kept = items.carry_over(out.items, old, ["concept", "side", "item_id"]).where("item_id = '220045'").first()
    assert kept["reviewer_verdict"] == "accept" and kept["reviewer_comment"] == "fine"
    judged = spark.read.csv(str(path), header=True, multiLine=True, escape='"').toPandas().assign(reviewer_verdict="accept", reviewer_comment='a "b",\nc')
    path.rename(path.with_name("put_aside"))
    judged.to_csv(tmp_path / "item_review.csv", index=False)  # an expert's single file
    again, _ = review.write_review(spark, out, tmp_path)
    assert again == path and path.is_dir()
    third, _ = review.write_review(spark, out, tmp_path)
    rows = spark.read.csv(str(third), header=True, multiLine=True, escape='"').collect()
    assert len(rows) == len(judged) and {(r["reviewer_verdict"], r["reviewer_comment"]) for r in rows} == {("accept", 'a "b",\nc')}
    path.rename(path.with_name("_item_review.csv.kept"))  # a run that died while it replaced the rows
    review.write_review(spark, out, tmp_path)
    assert {r["reviewer_verdict"] for r in spark.read.csv(str(path), header=True, multiLine=True, escape='"').collect()} == {"accept"}
    with pytest.raises(ValueError):
        review.build_review(spark, "mimic-iv", {"hr": spark.createDataFrame(rows, code).drop("source_code")}, meta, versions, ["hr"])


def test_stream_equals_batch(spark, tmp_path):
    schema = "subject_id long, time timestamp, numeric_value double, concept string"
    rows = [(1, T0 + timedelta(minutes=20 * i), float(i), "hr") for i in range(9)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stays = spark.createDataFrame([(1, 5, T0, None)], "subject_id long, stay_id long, intime timestamp, outtime timestamp")
    stream = hourly_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), stays)
    query = stream.writeStream.outputMode("complete").format("memory").queryName("hourly_test").start()
    query.processAllAvailable()
    query.stop()
    got = {(r["hour"]["start"].hour, r["n"], r["mean"]) for r in spark.sql("select * from hourly_test").collect()}
    assert got == {(0, 3, 1.0), (1, 3, 4.0), (2, 3, 7.0)}


def test_command_line_needs_paths():
    assert cli.parser().parse_args(["--max-hours", "-1"]).max_hours == -1
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["--aggregation-mode", "mode"])


def test_default_paths(spark, tmp_path):
    from staygrid.plans.paths import default_paths

    env = {"STAYGRID_OUTPUT_ROOT": str(tmp_path), "STAYGRID_MIMIC_IV_STAYS": str(tmp_path / "x.csv")}
    paths = default_paths("mimic-iv", concept_root=tmp_path, environment=env)
    assert paths.output_root == tmp_path and paths.stay_table == tmp_path / "x.csv" and paths.reference.name == "reference_dynamic_vars_miiv.parquet"
    with pytest.raises(ValueError):
        default_paths("mimic-iv", environment=env)


def test_plain_reports(spark, tmp_path):
    from staygrid.plans.comparison import write_plain_reports

    a = spark.createDataFrame([(1, 0, 1.0)], "stay_id long, time long, hr double")
    assert len(write_plain_reports(a, a, tmp_path)) == 6 and (tmp_path / "value_diff.csv").is_file()


def test_public_names():
    import staygrid

    assert {"wide_table", "compare_tables", "build_review", "StayIds", "hourly_stream"} <= set(staygrid.__all__) and len(staygrid.__all__) >= 50


def test_csv_stay_table(spark, tmp_path):
    import gzip

    path = tmp_path / "mimiciv" / "2.2" / "icu" / "icustays.csv.gz"
    path.parent.mkdir(parents=True)
    with gzip.open(path, "wt") as f:
        f.write("subject_id,hadm_id,stay_id,intime,outtime\n1,10,100,2150-01-01 00:00:00,2150-01-01 10:00:00\n")
    table = spark.createDataFrame([(1, T0 + timedelta(hours=3, minutes=59), 70.0, "2.2"), (1, T0 + timedelta(hours=11), 1.0, "2.2")], EVENT)
    stays = build.resolve_stays(spark, "mimic-iv", tmp_path, path, "2.2", [table])
    assert stays.source == "raw_table" and stays.notes["stay_table_version"] == "2.2"
    out = build.build_variables({"hr": table}, stays, "mimic-iv", grid=True)
    rows = {r["time"]: r["hr"] for r in out.collect()}
    assert len(rows) == 11 and rows[3] == 70.0 and sum(v is not None for v in rows.values()) == 1


def test_visits_choose_the_stay(spark, tmp_path):
    ws = tmp_path / "workspace"
    visit = "subject_id long, time timestamp_ntz, visit_occurrence_id long"
    _write(spark, ws / "extraction/aumc/1.5.0/visit/VISIT_START.parquet", [(1, T0, 10), (1, T0 + timedelta(hours=24), 11)], visit)
    _write(spark, ws / "extraction/aumc/1.5.0/visit/VISIT_END.parquet", [(1, T0 + timedelta(hours=5), 10), (1, T0 + timedelta(hours=27, minutes=30), 11)], visit)
    rows = [(1, T0 + timedelta(hours=1, minutes=30), 80.0, "10"), (1, T0 + timedelta(hours=25, minutes=10), 90.0, "11"), (1, T0 + timedelta(hours=25, minutes=20), 999.0, "10")]
    table = spark.createDataFrame(rows, "subject_id long, time timestamp_ntz, numeric_value float, visit_occurrence_id string")
    stays = build.resolve_stays(spark, "aumc", ws, None, None, [table])
    out = build.build_variables({"hr": table}, stays, "aumc", grid=True).collect()
    assert {(r["stay_id"], r["time"]): r["hr"] for r in out if r["hr"] is not None} == {(10, 1): 80.0, (11, 1): 90.0}
    assert [sum(r["stay_id"] == s for r in out) for s in (10, 11)] == [6, 4]


def test_cases_choose_the_stay(spark, tmp_path):
    ws = tmp_path / "workspace"
    case = "subject_id long, time timestamp_ntz, case_id long"
    starts = [(7, T0, 7), (7, T0 + timedelta(days=40), 8), (8, T0, 20)]
    ends = [(7, T0 + timedelta(hours=5), 7), (7, T0 + timedelta(days=40, hours=200), 8), (8, T0 + timedelta(hours=3), 20)]
    _write(spark, ws / "extraction/sic/1.0.6/cases/ICU_ADMISSION.parquet", starts, case)
    _write(spark, ws / "extraction/sic/1.0.6/cases/OBSERVATION.parquet", ends, case)
    rows = [(7, T0 + timedelta(minutes=30), 80.0, "7"), (7, T0 + timedelta(hours=2, minutes=10), 82.0, "7"), (7, T0 + timedelta(days=40, hours=1), 90.0, "8"), (7, T0 + timedelta(days=40, hours=170), 91.0, "8"), (8, T0 + timedelta(hours=1), 70.0, "20")]
    table = spark.createDataFrame(rows, "subject_id long, time timestamp_ntz, numeric_value float, case_id string")
    stays = build.resolve_stays(spark, "sicdb", ws, None, None, [table])
    out = build.build_variables({"hr": table}, stays, "sicdb", grid=True).collect()
    assert {(r["stay_id"], r["time"], r["hr"]) for r in out if r["hr"] is not None} == {(7, 0, 80.0), (7, 2, 82.0), (8, 1, 90.0), (20, 1, 70.0)}
    assert [sum(r["stay_id"] == s for r in out) for s in (7, 8, 20)] == [6, 169, 4]
    with pytest.raises(ValueError):
        build.resolve_stays(spark, "sic", ws, None, None, [table.drop("case_id")])


def test_reference_times(spark):
    from staygrid.sources.reference import reference_wide, reference_windows

    hours = spark.createDataFrame([(1, 0.0, 59.0), (2, 0.0, 200.0), (3, 0.0, None)], "patientunitstayid long, start double, end double")
    got = {r["stay_id"]: (r["reference_end"], r["reference_expected_n_timepoints"]) for r in reference_windows(hours).collect()}
    assert got == {1: (59, 60), 2: (168, 169), 3: (None, None)}
    millis = spark.createDataFrame([(1, 0, 604_800_000)], "admissionid long, start long, end long")
    assert reference_windows(millis).first()["reference_end"] == 168
    seconds = spark.createDataFrame([(1, 0, 604_800)], "admissionid long, start long, end long")
    assert reference_windows(seconds, None, unit="s").first()["reference_end"] == 168
    wide = spark.createDataFrame([(1, 0.0, 80.0), (1, 1.0, 81.0), (1, 60.0, 9.0), (9, 0.0, 1.0)], "PatientUnitStayID long, labresultoffset double, hr double")
    rows = reference_wide(wide, reference_windows(hours), ["hr", "temp"])
    assert rows.columns == ["stay_id", "time", "hr"] and {tuple(r) for r in rows.collect()} == {(1, 0, 80.0), (1, 1, 81.0)}


def test_comparison_of_files(spark, tmp_path):
    from staygrid.plans.comparison import compare_files

    table = spark.createDataFrame([(1, t, 80.0 + t) for t in range(3)], "stay_id long, time long, hr double")
    sinks.write_table(table, tmp_path / "wide.parquet", {"dataset": "mimic-iv", "version": "2.2", "source": "explicit", "representation": None, "stay_id_space": "mimic-iv:icustays.stay_id"})
    table.write.parquet(str(tmp_path / "ref.parquet"))
    spark.createDataFrame([(1, 0.0, 2.0)], "stay_id long, start double, end double").write.parquet(str(tmp_path / "win.parquet"))
    out, folder = compare_files(spark, "miiv", tmp_path / "wide.parquet", tmp_path / "ref.parquet", tmp_path / "win.parquet", output_root=tmp_path, reference_version="2.2", concepts=["hr"])
    assert out.claims["validation_level"] == "full_same_version" and (folder / "value_diff.csv").is_file() and folder.name == "candidate-2.2__reference-miiv-2.2"
    assert out.reports["reproduction_accuracy"].first()["exact_stay_match_rate"] == 1.0
    with pytest.raises(ValueError):
        compare_files(spark, "miiv", tmp_path / "wide.parquet", tmp_path / "ref.parquet", tmp_path / "win.parquet", candidate_version="3.1")
    with pytest.raises(ValueError):
        compare_files(spark, "hirid", tmp_path / "wide.parquet", tmp_path / "ref.parquet", tmp_path / "win.parquet")


def test_reports_of_stays_bypass_the_driver(spark, tmp_path, monkeypatch):
    from staygrid.plans import comparison

    large = []
    monkeypatch.setattr(comparison.sinks, "write_report", lambda df, folder, name: large.append(name) if "stay_id" in df.columns else None)
    table = spark.createDataFrame([(s, t, 80.0 + t) for s in range(30) for t in range(3)], "stay_id long, time long, hr double")
    sinks.write_table(table, tmp_path / "wide.parquet", {"dataset": "mimic-iv", "version": "2.2", "source": "explicit", "representation": None, "stay_id_space": "mimic-iv:icustays.stay_id"})
    table.write.parquet(str(tmp_path / "ref.parquet"))
    spark.createDataFrame([(s, 0.0, 2.0) for s in range(29)], "stay_id long, start double, end double").write.parquet(str(tmp_path / "win.parquet"))
    for _ in range(2):  # written again over the first
        out, folder = comparison.compare_files(spark, "miiv", tmp_path / "wide.parquet", tmp_path / "ref.parquet", tmp_path / "win.parquet", output_root=tmp_path, reference_version="2.2", concepts=["hr"])
    assert not large
    for name in comparison.PER_STAY & set(out.reports):
        back = spark.read.csv(str(folder / f"{name}.csv"), header=True, escape='"')
        assert (folder / f"{name}.csv").is_dir() and back.columns == out.reports[name].columns and back.count() == out.reports[name].count()
    assert "per_stay_reproduction" in out.reports and out.reports["per_stay_reproduction"].count() >= 29


def test_places(spark, tmp_path):
    from staygrid.sources.place import Place

    for root in (Place(tmp_path), Place(f"file://{tmp_path}"), Place(f"file:{tmp_path}")):
        file = root / "a" / "b" / "x.txt"
        file.write_text("é\n1")
        file.write_text("é\n2")
        assert file.read_text() == "é\n2" and file.is_file() and file.parent.is_dir() and file.parent == str(file)[: -len("/x.txt")]
        assert [p.name for p in (root / "a" / "b").find("*")] == ["x.txt"] and root.find("x.txt") == [file] and file.below(root) == ("a", "b", "x.txt")
        (root / "t.parquet" / "x.txt").write_text("")
        assert root.find("x.txt") == [file] and root.find("*.parquet") == [root / "t.parquet"] and root.folders() == [root / "a", root / "t.parquet"]
        file.rename(file.with_name("y.txt"))
        assert not file.exists() and file.with_name("y.txt").exists()
        (root / "a").delete()
        assert not (root / "a").exists() and (root / "a").find("y.txt") == [] and (root / "a").folders() == []
    assert str(Place("hdfs://host:8020/a//b/../c")) == "hdfs://host:8020/a/c" and str(Place("s3a://bucket")) == "s3a://bucket/"
    assert Place("s3a://bucket/x/wide.parquet").with_suffix(".provenance.json") == "s3a://bucket/x/wide.provenance.json"
    assert sinks.provenance_path("hdfs://h/t/w.parquet") == "hdfs://h/t/w.provenance.json"


def test_build_with_a_scheme(spark, project):
    ws = f"file://{project}/workspace"
    config = BuildConfig(concept_root=sinks.Place(ws) / "concept", dataset="hirid", variables=["hr"], grid=True, output=f"file://{project}/remote/wide.parquet", missing="ignore")
    export = build.write_variables(spark, config)
    assert str(export.path).startswith("file:///") and spark.read.parquet(str(export.path)).count() == 10
    assert sinks.read_provenance(spark, export.path)["version"] == "1.1.1"


def test_discovery_rules(spark, tmp_path):
    for path in ("hr/1.0.0/a-b", "hr/draft/a-b", "temp/a-b", "nested/x/latest/a-b", "only/1.0.0/a_b"):
        (tmp_path / f"{path}.parquet").mkdir(parents=True)
    found = {c.name: (c.version, c.path.parent.name) for c in layout.discover_concepts(tmp_path, "a-b")}
    assert found == {"hr": ("draft", "draft"), "temp": (None, "temp"), "nested/x": ("latest", "latest")}
    assert [c.name for c in layout.discover_concepts(tmp_path / "only", "a-b")] == ["1.0.0"]
    assert layout.discover_concepts(tmp_path, "zz") == []


@pytest.mark.parametrize(("path", "dataset", "version"), [
    ("/d/eicu-collaborative-research-database-2.0/patient.csv.gz", "eicu", "2.0"), ("/d/MIMIC_IV/v2.2/x", "miiv", "2.2"), ("/d/mimic-iv-2.2/mimic-iv-3.1/x", None, "3.1"),
    ("/d/mimiciv/2.2/old/1.0/x", "mimic-iv", "2.2"), ("/d/1.0/miiv/x", "mimic-iv", None), ("/d/sicdb-1.0.6/x", "sic", "1.0.6"), ("/d/mimiciv/files/2.2/x", "mimic-iv", None),
    ("/d/mimiciii/1.4/x", "mimic-iv", None), ("/d/aumc/1.0.2", "aumc", "1.0.2"), ("/d/hirid1/1.1.1/x", "hirid", "1.1.1"), ("/d/mimic-iv-2/x", "mimic-iv", None),
])
def test_version_of_a_path(path, dataset, version):
    assert layout.path_version(path, dataset) == version


def test_stay_table_is_ranked(spark, tmp_path):
    for path in ("full/mimiciv/2.2/icu", "full/mimiciv/2.2/deep/er/icu", "full/mimic-iv-2.2/icu", "full/other/icu", "demo/mimic-iv-demo/2.2/icu"):
        (tmp_path / path).mkdir(parents=True)
        (tmp_path / path / "icustays.csv.gz").write_bytes(b"")
    env = {"STAYGRID_DATA_ROOT": str(tmp_path / "full"), "REFERENCE_DATA_PATH": str(tmp_path)}
    found = layout.resolve_stay_table("mimic-iv", environment=env)
    assert found.path == tmp_path / "full/mimic-iv-2.2/icu/icustays.csv.gz" and found.version == "2.2" and found.selection == "discovered"
    assert "demo" in str(layout.resolve_stay_table("mimic-iv-demo", environment=env).path)
    assert layout.resolve_stay_table("nwicu", environment=env) is None
    with pytest.raises(ValueError):
        layout.resolve_stay_table("mimic-iv", wanted="3.1", environment=env)
    named = {"STAYGRID_MIMIC_IV_STAYS": str(tmp_path / "full/other/icu/icustays.csv.gz")}
    assert layout.resolve_stay_table("mimic-iv", wanted="3.1", environment=named).selection == "environment"


def test_versions_and_what_they_allow():
    from staygrid.plans.versions import relationship, version_key, versions_equal

    assert version_key("v02.0.0") == ("2",) and version_key("0.0") == ("0",) and version_key("1.b.0") == ("1", "b") and versions_equal("2.2", "v2.2.0") and versions_equal(None, "1") is None
    for version, source in (("1", "unknown"), (None, "explicit")):
        with pytest.raises(ValueError):
            DatasetVersion("x", version, source)
    known, other, guess = DatasetVersion("x", "1.0", "explicit"), DatasetVersion("x", "2", "provenance_file"), DatasetVersion("x", "1", "manual_default")
    assert VersionPair(known, known).level(True) == "full_same_version" and VersionPair(known, other).level(True) == "shared_subset_cross_version"
    assert VersionPair(known, guess).level(True) == "shared_subset_unverified_version" and VersionPair(known, known).level(False) == "not_comparable" and not VersionPair(known, guess).full
    assert [relationship(*n) for n in ((2, 2, 2), (3, 2, 2), (2, 3, 2), (3, 3, 2), (3, 3, 0))] == ["equal", "candidate_superset", "reference_superset", "partial_overlap", "not_directly_comparable"]


def test_aggregation_policy(spark):
    rows = [(1, T0 + timedelta(minutes=m), v, "1") for m, v in ((1, 1.0), (2, 2.0), (3, 9.0))]
    stays = build.Stays(spark.createDataFrame([(1, 1, T0, T0 + timedelta(hours=2))], "subject_id long, stay_id long, intime timestamp_ntz, outtime timestamp_ntz"))
    meta, table = ConceptDict({"alb": {"aggregate": "max"}, "dobu_dur": {"aggregate": "max"}}), spark.createDataFrame(rows, EVENT)
    for name, want in (("nwicu", 9.0), ("mimic-iv-demo", 9.0), ("mimic-iv", 9.0), ("mimic_demo", 9.0), ("unheard-of", 4.0)):
        assert registry.uses_metadata(name) == (want == 9.0)
        out = build.build_all({"albumin": table, "dobutamine_duration": table, "dobu_dur": table}, stays, name, meta, grid=False).first()
        assert (out["albumin"], out["dobutamine_duration"], out["dobu_dur"]) == (want, want, 4.0)


def test_one_join_whatever_the_number_of_concepts(spark):
    import io
    from contextlib import redirect_stdout

    table = spark.createDataFrame([(1, T0, 1.0, "1")], EVENT)
    stays = build.Stays(spark.createDataFrame([(1, 1, T0, T0 + timedelta(hours=2))], "subject_id long, stay_id long, intime timestamp_ntz, outtime timestamp_ntz"))
    out = io.StringIO()
    with redirect_stdout(out):
        build.build_variables({f"c{i}": table for i in range(9)}, stays, "mimic-iv", sort=False).explain("formatted")
    assert sum("Join" in line and line.lstrip(" +-:*(").startswith(("Broadcast", "SortMerge", "ShuffledHash")) and "(" in line and ") " not in line.split("Join")[0][-3:] for line in out.getvalue().splitlines()) <= 2


def test_timestamps_through_a_configuration(spark, project, tmp_path):
    table = spark.createDataFrame([(1, T0 + timedelta(hours=2, minutes=10), 70.0, "1.1.1"), (2, T0, 60.0, "1.1.1"), (2, T0 + timedelta(hours=1), 61.0, "1.1.1")], EVENT)
    table.write.parquet(str(tmp_path / "concept/heart_rate/1.0.0/mimic-iv.parquet"))
    stays = [(1, 1, 100, T0, T0 + timedelta(hours=2, minutes=30)), (2, 2, 200, T0, None)]
    spark.createDataFrame(stays, "subject_id long, hadm_id long, stay_id long, intime timestamp_ntz, outtime timestamp_ntz").write.parquet(str(tmp_path / "stays.parquet"))
    (tmp_path / "vars.yml").write_text("dynamic_vars: [hr]\n")
    for rounding, last in (("ceil", 3), ("floor", 2)):
        (tmp_path / "c.yml").write_text(f"concepts: {{path: concept}}\nwide: {{dynamic_vars: vars.yml}}\nstay_table: stays.parquet\ngrid: {{include: true, max_hours: 5, end_rounding: {rounding}}}\noutput: {{path: {rounding}.parquet}}\n")
        got = [tuple(r) for r in spark.read.parquet(str(build.run_config(spark, tmp_path / "c.yml").path)).orderBy("stay_id", "time").collect()]
        assert got == [(100, t, 70.0 if t == 2 else None) for t in range(last + 1)] + [(200, 0, 60.0)]
    traced = build.debug_concept(spark, "hr", tmp_path / "floor.parquet", tmp_path / "concept", tmp_path / "stays.parquet")
    assert traced["raw_summary"].first()["rows"] == 3 and traced["mapped_summary"].first()["stays"] == 2 and traced["comparison_summary"].first()["max_abs_diff"] == 0
    assert traced["concept_folder"] == "heart_rate" and traced["largest_differences"].count() == 2
    with pytest.raises(KeyError):
        build.debug_concept(spark, "what", tmp_path / "floor.parquet", tmp_path / "concept", tmp_path / "stays.parquet")
    with pytest.raises(FileNotFoundError):
        build.debug_concept(spark, "temp", tmp_path / "floor.parquet", tmp_path / "concept", tmp_path / "stays.parquet")


def test_command_line_writes_a_table(spark, project, capsys):
    out = project / "cli" / "wide.parquet"
    assert cli.main(["--concept-root", str(project / "workspace/concept"), "--dataset", "hirid", "--output", str(out), "--missing-concepts", "ignore", "--max-hours", "5", "--no-sort"]) == 0
    assert capsys.readouterr().out.strip().endswith("cli/wide.parquet")
    assert sorted(r["time"] for r in spark.read.parquet(str(out)).collect()) == list(range(6))
    assert cli.main(["--all-concepts", str(project), "--dataset", "hirid", "--max-hours", "3"]) == 0
    assert spark.read.parquet(capsys.readouterr().out.strip().splitlines()[-1]).count() == 4


def test_unit_stay_timeline(spark):
    from staygrid.sources.stays import normalized_stays

    rows = [(141179, 128927, 2015, "08:56:00", -22, 2042), (141194, 128941, 2014, "23:59:30", 0, 59), (141196, 128927, 2015, "00:00:00", 1440, -5)]
    table = spark.createDataFrame(rows, "patientunitstayid long, patienthealthsystemstayid long, hospitaldischargeyear int, hospitaladmittime24 string, hospitaladmitoffset long, unitdischargeoffset long")
    got = {r["stay_id"]: r for r in normalized_stays(table, registry.stay_spec("eicu")).collect()}
    begin = (datetime(2015, 1, 1, 9, 18) - datetime(1970, 1, 1)).total_seconds() / 3600
    assert got[141179]["intime_hours"] == pytest.approx(begin) and got[141179]["outtime_hours"] - got[141179]["intime_hours"] == pytest.approx(2042 / 60)
    assert got[141196]["intime_hours"] == pytest.approx((datetime(2014, 12, 31) - datetime(1970, 1, 1)).total_seconds() / 3600)


def test_review_counts_what_is_observed(spark):
    code = "subject_id long, time long, numeric_value double, table string, source_code string"
    table = spark.createDataFrame([(1, 0, 1.0, "chart", "CHART//220045//Heart Rate//bpm")] * 2 + [(1, 2, 1.0, None, "CHART//999//New//bpm")], code)
    meta = ConceptDict({"hr": {"sources": {"miiv": [{"ids": [220045, 220046], "table": "t", "sub_var": "itemid"}]}}})
    versions = VersionPair(DatasetVersion("mimic-iv", "3.1", "explicit"), DatasetVersion("reference:miiv", "2.2", "provenance_file"))
    out = review.build_review(spark, "mimic-iv", {"hr": table}, meta, versions, ["hr"])
    row = out.summary.first()
    assert (row["n_candidate_observed_items"], row["n_candidate_observed_rows"], row["n_reference_configured_items"]) == (2, 3, 2)
    assert row["n_candidate_configured_items"] is row["n_reference_observed_items"] is row["n_reference_configured_not_observed"] is None and row["reference_observation_available"] is False
    assert {r["candidate_configured"] for r in out.items.collect()} == {None} and {r["item_set_basis"] for r in out.items.collect()} == {"candidate_observed_vs_reference_configured"}
    seen = spark.createDataFrame([("hr", 220045, 10)], "concept string, item_id long, n_rows long")
    row = review.build_review(spark, "mimic-iv", {"hr": table}, meta, versions, ["hr", "temp"], seen=seen).summary.where("concept = 'hr'").first()
    assert (row["n_reference_observed_items"], row["n_reference_configured_not_observed"]) == (1, 1)
