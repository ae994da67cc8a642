"""Raw exports: one read, headers as data, ordinals that don't depend on splits."""

import pytest
from test_operators import export, write

from stayflow.plans import layers
from stayflow.sources import raw, staging


def test_an_export_is_read_once(spark, tmp_path, monkeypatch):
    export(tmp_path)
    plans = []
    for module in (raw, staging):
        write_ = module.stage
        monkeypatch.setattr(module, "stage", lambda df, tag, f=write_: plans.append(df._jdf.queryExecution().executedPlan().toString()) or f(df, tag))
    rows = raw.load_all(spark, str(tmp_path), "dynamic")
    plans.append(rows._jdf.queryExecution().executedPlan().toString())
    assert sum(p.count("FileScan text") for p in plans) == 1 and not any("Scan csv" in p or "Python" in p or "CartesianProduct" in p for p in plans)
    assert rows.count() == 56


def test_headers_of_one_folder_may_differ(spark, tmp_path):
    write(tmp_path / "UK_00/dynamic_filtered/1.csv", "Zeit_ab_Aufnahme,HF,SAP\n15,80,120\n30,81,121\n")
    write(tmp_path / "UK_00/dynamic_filtered/2.csv", 'SAP,"HF",Time\r\n122,82,0 days 01:00:00\r\n\r\n"1,5",83\r\n')
    write(tmp_path / "UK_00/dynamic_filtered/3.csv", "HF,Pseudo-ID,Time,Zeit_ab_Aufnahme,unknown\n84,99,,60,x\n")
    rows = raw.load_all(spark, str(tmp_path), "dynamic").orderBy("row_ord").select("row_ord", "stay_id_local", "time", "minutes_since_admit", "heart_rate", "sbp")
    assert [tuple(r) for r in rows.collect()] == [
        (0, "1", "0 days 00:15:00", "15", "80", "120"), (1, "1", "0 days 00:30:00", "30", "81", "121"),
        (2, "2", "0 days 01:00:00", None, "82", "122"), (3, "2", None, None, "83", "1,5"), (4, "3", None, "60", "84", None),
    ]
    named = raw.load_dynamic(spark, raw.site_folders(spark, str(tmp_path))[0])
    assert {"HF", "SAP", "unknown", "Pseudo-ID", "PseudoID", "Time", "hospital_id", "row_ord"} <= set(named.columns)
    assert {r["Pseudo-ID"] for r in named.collect()} == {"1", "2", "3"}
    assert {tuple(r) for r in raw.values_of(raw.load_sites(spark, str(tmp_path), "dynamic")).where("column = 'SAP'").collect()} == {("asic_UK00", "SAP", "sbp", v) for v in ("120", "121", "122", "1,5")}


def ordinals(spark, root, size):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        return [tuple(r) for r in raw.load_all(spark, root, "dynamic").select("row_ord", "stay_id_local", "heart_rate").orderBy("row_ord").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_ordinals_do_not_depend_on_splits(spark, tmp_path):
    for site, layout, prefix, stay, n in (("UK_00", "dynamic_filtered", "", 5, 4000), ("UK_00", "dynamic_filtered", "", 6, 3), ("UK_02", "dynamic", "dynamische_variablen_kds_patient_", 7, 900)):
        sep = "," if layout == "dynamic_filtered" else ";"
        write(tmp_path / site / layout / f"{prefix}{stay}.csv", f"HF{sep}Zeit_ab_Aufnahme\n" + "".join(f"{i}{sep}{i * 15}\n" for i in range(n)))
    whole, cut = (ordinals(spark, str(tmp_path), size) for size in ("128m", "1k"))
    assert whole == cut == [(i, *row) for i, row in enumerate([(stay, str(v)) for stay, n in (("5", 4000), ("6", 3), ("7", 900)) for v in range(n)])]


def test_running_total_equals_a_plain_one(spark):
    df = staging.stage(spark.createDataFrame([(f"k{i:03}", i % 7) for i in range(200)], "k string, n long").repartition(7), "t")
    got = {r["k"]: r["to"] for r in staging.running_total(df, ["k"], "n", "to").collect()}
    assert got == {f"k{i:03}": sum(j % 7 for j in range(i)) for i in range(200)}


def test_errors_of_an_export(spark, tmp_path):
    write(tmp_path / "a/UK_00/dynamic/other_1.csv", "HF;Time\n80;1 day\n")
    with pytest.raises(ValueError, match="file names without a stay id"):
        raw.load_all(spark, str(tmp_path / "a"), "dynamic")
    write(tmp_path / "b/UK_00/static/andere_variablen_kds_patienten.csv", "Alter;BMI\n1;2\n")
    with pytest.raises(KeyError, match="no stay id column"):
        raw.load_all(spark, str(tmp_path / "b"), "static")
    write(tmp_path / "c/UK_00/static/andere_variablen_kds_patienten.csv", "PseudoID;Pseudo-ID\n1;2\n")
    with pytest.raises(ValueError, match="stay ids conflict"):
        raw.load_all(spark, str(tmp_path / "c"), "static")
    write(tmp_path / "d/UK_00/dynamic_filtered/1.csv", "HF,HF\n1,2\n")
    with pytest.raises(ValueError, match="column names twice"):
        raw.load_all(spark, str(tmp_path / "d"), "dynamic")
    (tmp_path / "e/UK_00/dynamic").mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        raw.load_all(spark, str(tmp_path / "e"), "dynamic")
    assert raw.load_dynamic(spark, str(tmp_path / "e/UK_00")) is None


def test_another_translation_reaches_every_report(spark, tmp_path):
    export(tmp_path / "raw")
    write(tmp_path / "raw/UK_00/dynamic_filtered/13.csv", "Zeit_ab_Aufnahme,HF\n15,many\n")
    with open(tmp_path / "raw/UK_00/static/andere_variablen_kds_patienten.csv", "a") as f:
        f.write("13;W;0;0\n")
    write(tmp_path / "names.json", '{"dynamic": {"HF": "sbp", "Zeit_ab_Aufnahme": "minutes_since_admit", "Time": "time", "PseudoID": "stay_id"}}')
    tables = layers.harmonized(spark, str(tmp_path / "raw"), translation=str(tmp_path / "names.json"))
    issues = tables["non_numeric_issues"].collect()
    assert [(r["column"], r["canonical_name"], r["examples"]) for r in issues] == [("HF", "sbp", "many")]
    assert {r["raw_columns"] for r in tables["dynamic_source_map"].where("canonical_name = 'sbp'").collect()} == {"HF"}
