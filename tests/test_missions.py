"""The mission ETL end to end on a small generated CSV (temporary directory)."""

import csv
import os

import pytest

from tessera.plans import missions
from tessera.sources import io

HEADER = [
    "Mission ID", "Mission Name", "Program Type", "Mission Category", "Sub Category", "Destination", "Status",
    "Mission Phase", "Crew Type", "Data Returned", "Failure Reason", "Cost USD Million", "Duration", "Agency",
    "Country Region", "Agency Type", "Launch Vehicle", "Launch Site", "Launch Date", "End Date", "Objective",
    "Key Achievement", "Mission Outcome Detail", "Reference URL", "Crew Members", "Partner Agencies",
]


def row(mid, agency, launch, end="", status="Success", cost="1500", duration="2 years", crew="", partners="",
        vehicle="Falcon 9", site="KSC", country="USA", atype="Government", name=None, returned="Yes"):
    return [mid, name or f"Mission {mid}", "Robotic", "Mars", "Orbiter", " Mars ", status, "Past", "Uncrewed",
            returned, "N/A", cost, duration, agency, country, atype, vehicle, site, launch, end, "Study",
            "unknown", "", "https://example.org", crew, partners]


ROWS = [
    row("M1", "NASA", "1958-01-01", "1960-05-01", crew="A,  B,,C", partners="ESA, JAXA"),
    row("M2", "NASA", "1957-12-31"),                      # before founding: dropped
    row("M3", "Unknown Agency", "2000-01-01"),            # unknown agency: dropped
    row("M4", "ESA", "", status="Failed"),                # no launch date: dropped
    row("M5", "ESA", "1980-03-04", "1979-01-01", status="Lost", cost="bad", duration="~1,200 Days",
        vehicle="N/A", site="N/A", country="Europe", returned="n/a"),
    row("M6", "JAXA", "2021-01-03", duration="12 hours", crew="A, A", vehicle="N/A", site="N/A", country="Japan",
        name="Mission M1"),
    row("M7", "SpaceX", "2010-06-04", duration="0 days", cost=" 12 ", atype="Private", partners=" , "),
]


@pytest.fixture()
def csv_path(scratch):
    p = os.path.join(scratch, "raw")
    os.makedirs(p)
    with open(os.path.join(p, "missions.csv"), "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(HEADER)
        w.writerows(ROWS)
    return p


def test_clean(spark, csv_path):
    raw = io.read_raw_csv(spark, csv_path)
    assert len(raw.columns) == 26
    c = missions.clean(raw)
    kept = {r.mission_id: r for r in c.frame.collect()}
    assert sorted(kept) == ["M1", "M5", "M6", "M7"]
    assert kept["M1"].destination == "Mars" and kept["M1"].failure_reason is None
    assert kept["M1"].duration_days == 730.5 and kept["M5"].duration_days == 1200.0
    assert kept["M6"].duration_days == 0.5 and kept["M7"].duration_days is None
    assert kept["M1"].cost_usd_billion == 1.5 and kept["M5"].cost_usd_billion is None
    assert kept["M7"].cost_usd_billion == pytest.approx(0.012)
    assert kept["M5"].data_returned is None and kept["M5"].launch_vehicle is None
    rej = {r.mission_id: r.reject_reason for r in c.rejects.collect()}
    assert rej == {"M2": "before_reference", "M3": "unknown_key", "M4": "null_date"}
    dom = {(r.column_name, r.value): r.n_rows for r in c.domain_report.collect()}
    assert dom == {("status", "Lost"): 1}
    cnt = c.counters.collect()[0]
    assert (cnt.rows_kept, cnt.duration_parsed, cnt.duration_failed, cnt.cost_missing) == (4, 3, 1, 1)
    assert (cnt.rows_before, cnt.rows_dropped, cnt.crewed_missions, cnt.collaborative_missions) == (7, 3, 2, 1)
    assert set(c.rejects.columns) - {"reject_reason"} == set(c.frame.columns) - {"duration_days", "cost_usd_billion"}


def test_tables_and_constraints(spark, csv_path):
    c = missions.clean(io.read_raw_csv(spark, csv_path))
    t = missions.build_tables(c.frame)
    fact = {r.mission_id: r for r in t["fact_missions"].collect()}
    assert len(fact) == 4
    dates = {r.full_date.isoformat(): r.date_id for r in t["dim_date"].collect()}
    assert sorted(dates.values()) == list(range(1, len(dates) + 1))
    assert fact["M1"].launch_date_id == dates["1958-01-01"] and fact["M1"].end_date_id == dates["1960-05-01"]
    assert fact["M6"].launch_id == fact["M5"].launch_id  # (NULL, NULL) resolves to one id
    assert str(fact["M1"].cost_usd_billion) == "1.50" and str(fact["M1"].duration_days) == "730.50"
    crew = sorted((r.mission_id, r.crew_member) for r in t["bridge_crew"].collect())
    assert crew == [("M1", "A"), ("M1", "B"), ("M1", "C"), ("M6", "A"), ("M6", "A")]
    assert sorted(r.partner_agency for r in t["bridge_partners"].collect()) == ["ESA", "JAXA"]
    rep = missions.constraint_report(t).where("n_violations > 0").collect()
    assert rep == []
    un = missions.unresolved(t["fact_missions"]).collect()[0]
    assert (un.unresolved_agency_id, un.unresolved_launch_id, un.unresolved_launch_date_id) == (0, 0, 0)
    for name, df in t.items():
        assert df.schema == missions.schema.SCHEMAS[name] or [f.dataType for f in df.schema] == [
            f.dataType for f in missions.schema.SCHEMAS[name]
        ]


def test_run_refreshes(spark, csv_path, scratch):
    out = os.path.join(scratch, "warehouse")
    rep = missions.run(spark, csv_path, out)
    health = {r.table_name: (r.n_rows, r.status) for r in rep["health"].collect()}
    assert health["fact_missions"] == (4, "ok") and health["bridge_crew"] == (5, "ok")
    # a second run replaces, not appends
    rep2 = missions.run(spark, csv_path, out)
    assert {r.table_name: r.n_rows for r in rep2["health"].collect()} == {k: v[0] for k, v in health.items()}
    assert rep2["healthy"].collect()[0].healthy
    # The catalog views are seen by another session, and agree with the marts.
    names = missions.create_views(spark, out)
    other = spark.newSession()
    tables = missions.sink.read_tables(spark, out, missions.schema.LOAD_ORDER)
    marts = [missions.agency_summary_view(tables), missions.yearly_trend_view(tables), missions.destination_summary_view(tables)]
    for name, mart in zip(names, marts):
        view = other.sql(f"SELECT * FROM {name}")
        assert sorted(view.columns) == sorted(mart.columns)
        assert sorted(map(str, view.select(*mart.columns).collect())) == sorted(map(str, mart.collect()))
        spark.sql(f"DROP VIEW {name}")


def test_missing_csv_raises(spark, scratch):
    with pytest.raises(FileNotFoundError):
        io.read_raw_csv(spark, os.path.join(scratch, "nope.csv"))


@pytest.fixture()
def bigger_csv(scratch):
    """A few dozen valid rows over four agencies, two types, three categories."""
    rows = []
    agencies = [("NASA", "USA", "Government", 1960), ("ESA", "Europe", "Government", 1980),
                ("SpaceX", "USA", "Private", 2005), ("JAXA", "Japan", "Government", 2004)]
    statuses = ["Success", "Failed", "Ongoing", "Success", "Partial Success", "Upcoming"]
    cats = ["Mars", "Earth Orbit", "Moon"]
    for i in range(48):
        name, country, atype, year = agencies[i % 4]
        r = row(f"X{i:03d}", name, f"{year + i % 9}-0{1 + i % 9}-1{i % 9}", f"{year + 10}-01-01",
                status=statuses[i % 6], cost=str(100 + 37 * i), duration=f"{1 + i % 5} years",
                crew="A, B" if i % 3 == 0 else "", country=country, atype=atype)
        r[3] = cats[i % 3]
        rows.append(r)
    p = os.path.join(scratch, "raw2")
    os.makedirs(p)
    with open(os.path.join(p, "m.csv"), "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(HEADER)
        w.writerows(rows)
    return p


def _tables(spark, path):
    return missions.build_tables(missions.clean(io.read_raw_csv(spark, path)).frame)


def test_views_and_wide(spark, bigger_csv):
    t = _tables(spark, bigger_csv)
    assert set(missions.register_views(t)) == {"vw_agency_summary", "vw_yearly_trend", "vw_destination_summary"}
    agency = {r.agency_name: r for r in spark.sql("SELECT * FROM vw_agency_summary").collect()}
    assert agency["NASA"].total_missions == 12 and agency["NASA"].successful_missions == 4
    years = spark.sql("SELECT year, total_launches FROM vw_yearly_trend").collect()
    assert sum(r.total_launches for r in years) == 48
    full = missions.missions_full(t)
    assert full.count() == 48 and "launch_decade" in full.columns and "objective" not in full.columns
    meta = missions.missions_with_meta(t)
    assert meta.count() == 48 and "objective" in meta.columns
    dates = [r.launch_date for r in full.select("launch_date").collect()]
    assert dates == sorted(dates)


def test_eda_and_cleaning_reports(spark, bigger_csv):
    from tessera.plans import eda
    t = _tables(spark, bigger_csv)
    rep = eda.eda_report(t)
    prof = {r.agency_name: r for r in rep["agency_profile"].collect()}
    assert set(prof) == {"NASA", "ESA", "SpaceX", "JAXA"} and prof["NASA"].success_rate == "33.33%"
    chi = rep["country_status_test"].collect()[0]
    assert chi.dof == (3 - 1) * (5 - 1) and 0 <= chi.p_value <= 1
    kf = rep["key_findings"].collect()[0]
    assert kf.key_share_pct == pytest.approx(25.0)
    for name, df in rep.items():
        df.count()
    for name, df in eda.cleaning_report(t).items():
        df.count()


def test_failed_gate_keeps_old_tables(spark, scratch):
    from tessera.sources import sink

    root = os.path.join(scratch, "wh")
    first = {"t": spark.range(3)}
    sink.refresh_tables(first, root, order=["t"])

    def reject(staged):
        raise ValueError("gate says no")

    with pytest.raises(ValueError):
        sink.refresh_tables({"t": spark.range(10)}, root, order=["t"], gate=reject)
    assert sink.read_tables(spark, root, ["t"])["t"].count() == 3


def test_cli(spark, csv_path, scratch, capsys):
    missions.main([csv_path, os.path.join(scratch, "cli_wh")])
    out = capsys.readouterr().out
    assert "== health" in out and "fact_missions" in out


def test_cluster_conf():
    from tessera.session import cluster_conf

    c = cluster_conf(100 * (1 << 40), 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert cluster_conf(1 << 30, 64)["spark.sql.shuffle.partitions"] == "128"
    assert c["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "256m"


def test_csv_multiline_and_quotes(spark, scratch):
    p = os.path.join(scratch, "ml")
    os.makedirs(p)
    r = row("Q1", "NASA", "1990-01-01")
    r[HEADER.index("Objective")] = 'Line one,\nline "two"'
    with open(os.path.join(p, "q.csv"), "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(HEADER)
        w.writerow(r)
    got = io.read_raw_csv(spark, p).collect()
    assert len(got) == 1 and got[0]["Objective"] == 'Line one,\nline "two"'


def test_bucketed_fact_and_meta_join_without_shuffle(spark, bigger_csv):
    """Fact and meta written bucketed by mission_id join with no exchange (co-located)."""
    import contextlib
    import io as _io

    from tessera.sources import sink

    t = _tables(spark, bigger_csv)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the fact-sized join path
    try:
        fact = sink.write_bucketed(t["fact_missions"], "tessera_test_fact", ["mission_id"], 4)
        meta = sink.write_bucketed(t["dim_mission_meta"], "tessera_test_meta", ["mission_id"], 4)
        joined = fact.join(meta, "mission_id")
        buf = _io.StringIO()
        with contextlib.redirect_stdout(buf):
            joined.explain()
        plan = buf.getvalue()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 48
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        spark.sql("DROP TABLE IF EXISTS tessera_test_fact")
        spark.sql("DROP TABLE IF EXISTS tessera_test_meta")


@pytest.mark.parametrize("change, rule", [({"cost": "100000000000000"}, "precision")])
def test_broken_constraints_refuse_the_load(spark, csv_path, scratch, change, rule):
    """The old tables stay when a row breaks a declared constraint."""
    out = os.path.join(scratch, "warehouse")
    missions.run(spark, csv_path, out)
    args = {"mid": "M8", "agency": "NASA", "launch": "1990-01-01"} | change
    with open(os.path.join(csv_path, "missions.csv"), "a", newline="") as f:
        csv.writer(f).writerow(row(**args))
    with pytest.raises(ValueError, match=rule):
        missions.run(spark, csv_path, out)
    assert missions.sink.read_tables(spark, out, ["fact_missions"])["fact_missions"].count() == 4


def test_unique_and_conform(spark):
    dates = spark.sql("""SELECT id AS date_id, DATE'2000-01-01' AS full_date, 2000 AS year, 1 AS quarter, 1 AS month,
                         'January' AS month_name, 52 AS week, 1 AS day, '2000s' AS decade FROM range(1, 3)""")
    bad = missions.constraint_report({"dim_date": dates}).where("n_violations > 0").collect()
    assert [(r.rule, r.column_name, r.n_violations) for r in bad] == [("unique", "full_date", 1)]
    with pytest.raises(Exception, match="does not fit"):
        missions.schema.conform(dates.withColumn("year", missions.F.lit(70000)), missions.schema.DIM_DATE).collect()


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
        f.write(text)


def test_csv_is_split_where_quotes_allow(spark, scratch):
    plain = "a,b\n" + "".join(f'{i},"say ""{i}"", twice"\n' for i in range(2000))
    lines = 'a,b\r\n1,"two\r\nlines"\r\n2,"odd"" quote"\r\n\r\n3,é\r\n'
    folder = os.path.join(scratch, "mixed")
    _write(folder, "plain.csv", plain)
    _write(folder, "lines.csv", lines)
    _write(folder, "blank.csv", 'a,b\n1,x\n  \n2,"""y"""\n')
    split, whole = io.csv_files_to_read_whole(spark, folder)
    assert [os.path.basename(f) for f in split] == ["plain.csv"]
    assert [os.path.basename(f) for f in whole] == ["blank.csv", "lines.csv"]
    rows = lambda df: sorted((r.a, r.b) for r in df.collect())
    found = rows(io.read_raw_csv(spark, folder))
    assert found == rows(io.read_raw_csv(spark, folder, splittable=False)) and ("1", "two\nlines") in found and ("7", 'say "7", twice') in found
    one = os.path.join(folder, "plain.csv")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        big = io.read_raw_csv(spark, one)
        assert big.rdd.getNumPartitions() > 4
        assert rows(big) == rows(io.read_raw_csv(spark, one, splittable=False)) == rows(io.read_raw_csv(spark, one, splittable=True))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("other", ["b,a\n1,2\n", "a,c\n1,2\n", "a\n1\n"])
def test_csv_headers_of_all_files_are_compared(spark, scratch, other):
    folder = os.path.join(scratch, "two")
    _write(folder, "1.csv", "a,b\n1,2\n")
    _write(folder, "2.csv", other)
    for splittable in (None, True, False):
        with pytest.raises(Exception):
            io.read_raw_csv(spark, folder, columns=["a", "b"], splittable=splittable).collect()


def test_csv_random_rows_read_alike(spark, scratch):
    import random

    rng = random.Random(9)
    cells = ["", "x", "two words", 'q"q', '""', '"', "comma, here", "line\nbreak", "é", "N/A", " pad "]
    for k in range(4):
        folder = os.path.join(scratch, f"r{k}")
        use = [c for c in cells if k % 2 or "\n" not in c]
        rows = [[rng.choice(use) or "-" for _ in range(3)] for _ in range(60)]
        os.makedirs(folder)
        with open(os.path.join(folder, "f.csv"), "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f, lineterminator="\n")
            w.writerow(["a", "b", "c"])
            w.writerows(rows)
        got = sorted(map(tuple, io.read_raw_csv(spark, folder).collect()))
        assert got == sorted(map(tuple, io.read_raw_csv(spark, folder, splittable=False).collect())) == sorted(map(tuple, rows))
