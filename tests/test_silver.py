import datetime
import json

import pytest
from pyspark.sql import functions as F

from sluice.operators import clean, snapshot
from sluice.schemas import ENTITIES
from sluice.sources import bronze, rest

INVOICES = ENTITIES["invoices"]


def _document(entry, value=10.0, lines=2, **more):
    return {"DocEntry": entry, "DocNum": entry, "DocDate": "2024-01-05T00:00:00Z", "CardCode": "C1", "CardName": " A\r\n\r\nB ", "SalesPersonCode": -1, "Cancelled": "tNO", "DocTotal": value,
            "DocumentLines": [{"LineNum": i, "ItemCode": f"I{i}", "Quantity": 1.0, "Price": value, "LineTotal": value, "ShipDate": "31/31/2024"} for i in range(lines)]} | more


def _put(base, load, docs, day="2024/01/05", name="a.json"):
    y, m, d = day.split("/")
    p = base / load / f"year={y}" / f"month={m}" / f"day={d}"
    p.mkdir(parents=True, exist_ok=True)
    (p / name).write_text(docs if isinstance(docs, str) else json.dumps(docs))


@pytest.fixture
def base(tmp_path):
    full = [_document(1), _document(2, DocumentAdditionalExpenses=[{"LineTotal": None}, {"LineTotal": 10}]), _document(3, lines=0), {**_document(4), "DocumentLines": None}, _document(-5)]
    full[0]["DocumentLines"].append({"LineNum": -1, "ItemCode": "bad"})
    full[0]["DocumentLines"].append({"LineNum": None, "ItemCode": "bad"})
    _put(tmp_path, "full", full)
    return tmp_path


def test_full_incremental_and_all(spark, base):
    read = lambda load, day=None: bronze.read(spark, str(base), load, day, INVOICES.source_schema)
    assert read("full").count() == 5
    assert read("incremental", datetime.date(2024, 1, 6)) is None
    _put(base, "incremental", [_document(1, 20.0), _document(9)], "2024/01/06")
    assert read("incremental", datetime.date(2024, 1, 6)).count() == 2
    assert read("all").count() == 7
    with pytest.raises(FileNotFoundError):
        bronze.read(spark, str(base / "nowhere"), "all")
    with pytest.raises(ValueError):
        read("some")


def test_full_leads_the_columns(spark, base):
    _put(base, "incremental", [{"DocEntry": 9, "New": 1}], "2024/01/06")
    df = bronze.read(spark, str(base), "all")
    assert "New" not in df.columns and df.where("DocEntry = 9").first().CardCode is None


def test_corrupt_files_are_kept_apart(spark, base):
    _put(base, "full", '[{"DocEntry": 7, "DocNum"', name="b.json")
    df = bronze.read(spark, str(base), "full", schema=INVOICES.source_schema).cache()
    assert bronze.corrupt(df).count() == 1


def test_silver_invoices(spark, base):
    _put(base, "incremental", [_document(1, 20.0, lines=1)], "2024/01/06")
    df = bronze.read(spark, str(base), "all", schema=INVOICES.source_schema)
    out = clean.silver(df, INVOICES, F.lit(datetime.datetime(2024, 2, 1))).orderBy("doc_entry", "line_num").collect()
    assert [(r.doc_entry, r.line_num, r.line_total) for r in out] == [(1, 0, 20.0), (1, 1, 10.0), (2, 0, 10.0), (2, 1, 10.0)]
    r = out[2]
    assert (r.card_name, r.doc_date, r.line_ship_date, r.document_additional_expenses) == ("A B", datetime.date(2024, 1, 5), None, 10.0)
    assert (r.year, r.month, r.day, r.sales_person_code, out[0].document_additional_expenses) == (2024, 1, 5, -1, 0.0)


def test_whole_document_replacement_drops_removed_lines(spark):
    old = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c")], "d int, l int, v string")
    new = spark.createDataFrame([(1, 0, "A")], "d int, l int, v string")
    by_line = snapshot.upserted(old, new, ["d", "l"])
    by_document = snapshot.upserted(old, new, ["d", "l"], ["d"])
    assert sorted(r.v for r in by_line.collect()) == ["A", "b", "c"] and sorted(r.v for r in by_document.collect()) == ["A", "c"]


@pytest.mark.parametrize("text", ['[{"a": 1}, {"a": 2}]', '{"a": 1}', '{"a": 1}\n{"a": 2}\nnot json\n{"a": 3}\n'])
def test_array_object_or_lines(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    got = bronze.read_any(spark, str(tmp_path), spark.createDataFrame([], "a int").schema)
    assert sorted(r.a for r in got.collect()) == sorted(json.loads(x)["a"] for x in text.replace("[", "").replace("]", "").replace("}, {", "}\n{").split("\n") if x.startswith("{"))


def test_chunks_and_audit(spark, tmp_path, base):
    df = bronze.read(spark, str(base), "full", schema=INVOICES.source_schema).coalesce(1)
    bronze.write_chunks(df.select("DocEntry"), str(tmp_path / "c"), 2)
    assert len([f for f in (tmp_path / "c").iterdir() if f.suffix == ".json"]) == 3
    bronze.audit_csv(df.drop("_corrupt_record"), str(tmp_path / "csv"))
    assert "LineNum" in spark.read.option("header", True).option("multiLine", True).option("escape", "\"").csv(str(tmp_path / "csv")).where("DocEntry = 2").first().DocumentLines


def test_partner_masking(spark):
    rows = [("1", "T1", "p"), ("2", "", "p"), ("3", None, None)]
    df = spark.createDataFrame([{"CardCode": c, "FederalTaxID": t, "Phone1": p, "FreeText": "a\nb"} for c, t, p in rows], "CardCode string, FederalTaxID string, Phone1 string, FreeText string")
    got = {r.card_code: r for r in clean.silver(df, ENTITIES["business_partners"]).collect()}
    assert len(got["1"].phone1) == 64 and got["2"].phone1 == "p" and got["3"].phone1 is None and got["1"].free_text == "a\nb"
    assert got["1"]._sk and got["1"].email_address is None


# REST
ROWS = [{"id": i, "name": f"n{i}"} for i in range(2500)]


def fake(url):
    import urllib.parse

    q = dict(urllib.parse.parse_qsl(urllib.parse.urlparse(url).query))
    return {"value": ROWS[int(q["$skip"]) : int(q["$skip"]) + int(q["$top"])]}


def test_pages_and_resume():
    assert [len(r) for _, r in rest.pages(fake, "http://x", "E", top=1000)] == [1000, 1000, 500]
    clock = iter([0, 400]).__next__
    got, at = rest.resumable(fake, "http://x", "E", clock, budget=300, top=1000)
    assert (len(got), at) == (1000, 1000)
    got, at = rest.resumable(fake, "http://x", "E", iter(range(99)).__next__, top=1000, skip=1000)
    assert (len(got), at) == (1500, None)
    today = datetime.date(2024, 3, 1)
    assert rest.changed_since("Invoices", today) == "UpdateDate ge '2024-02-29'"
    assert rest.changed_since("ItemGroups", today) is None and rest.changed_since("InventoryGenEntries", today).startswith("DocDate")


# snapshot tables
def test_versions_rollback_and_upkeep(spark, tmp_path):
    t = snapshot.SnapshotTable(spark, str(tmp_path / "t"), ["p"])
    one = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, p int")
    assert not t.exists()
    t.upsert(one, ["k"], at=datetime.datetime(2024, 1, 1))
    t.upsert(spark.createDataFrame([(2, "B", 2, 5)], "k int, v string, p int, new int"), ["k"], at=datetime.datetime(2024, 1, 2))
    assert sorted((r.k, r.v, r.new) for r in t.read().collect()) == [(1, "a", None), (2, "B", 5)]
    assert [h["operation"] for h in t.history()] == ["create", "upsert"]
    t.rollback(1)
    assert sorted(r.v for r in t.read().collect()) == ["a", "b"]
    t.rollback(2)
    for i in range(3, 6):
        t.write(t.read(), at=datetime.datetime(2024, 1, i))
    (tmp_path / "t" / "v=99").mkdir()
    assert t.remove_orphans() == ["v=99"]
    assert t.expire(datetime.datetime(2024, 1, 4), keep=2) == [1, 2, 3]
    assert t.read().count() == 2
    t.compact()
    t.delete_insert(spark.createDataFrame([(1, "z", 1)], "k int, v string, p int"), ["k"])
    assert sorted(r.v for r in t.read().collect()) == ["B", "z"]
    with pytest.raises(ValueError):
        t.read(77)


def test_of_two_writers_one_is_told(spark, tmp_path):
    t = snapshot.SnapshotTable(spark, str(tmp_path / "c"))
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    t.write(one)
    seen = t._manifest()
    t.upsert(spark.createDataFrame([(2, "b")], "k int, v string"), ["k"])
    with pytest.raises(snapshot.ConcurrentCommit):
        t.write(one, based_on=seen)
    assert sorted(r.k for r in t.read().collect()) == [1, 2]
    assert len(t.remove_orphans()) == 1


def test_compaction_of_a_partitioned_table(spark, tmp_path):
    t = snapshot.SnapshotTable(spark, str(tmp_path / "p"), ["p"])
    rows = spark.range(2000).selectExpr("id AS k", "cast(id % 2 AS int) AS p")
    files = lambda: len([f for f in (tmp_path / "p").glob(f"v={t._manifest()['current']}-*/p=*/*.parquet")])
    t.write(rows)
    assert files() == 2
    t.compact(target_bytes=1000)
    assert files() >= 4
    t.compact()
    assert files() == 2 and t.read().count() == 2000


def test_sequences_without_a_global_window(spark):
    from sluice.operators import quality

    values = [1, 2, 3, 7, 8, 8, 900, 901, 5000, None]
    got = quality.sequential_values(spark.createDataFrame([(v,) for v in values], "v int"), "v").collect()
    assert sorted((r.v, r.previous) for r in got) == [(7, 3), (8, 8), (900, 8), (5000, 901)]
    assert quality.sequential_values(spark.createDataFrame([(4,)], "v int"), "v").count() == 0
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "g int"), spark.createDataFrame([(1,), (1,), (3,)], "g int")
    assert sorted(r.g for r in quality.equal_rowcount(a, b, ["g"]).collect()) == [2, 3]
    assert sorted(r.g for r in quality.fewer_rows_than(a, b, ["g"]).collect()) == [1, 2]
    assert quality.equal_rowcount(a, b).count() == 0


def test_extract_to_bronze(spark, tmp_path):
    from sluice.sources import bronze

    day = datetime.date(2024, 3, 1)
    for load in ("full", "incremental"):
        rest.extract(spark, "http://x", "Invoices", "id long", len(ROWS), str(tmp_path / "b"), day, load=load, since=day, fetcher="tests.test_silver:fake")
    assert bronze.read(spark, str(tmp_path / "b"), "incremental", day).count() == len(ROWS)
    assert bronze.read(spark, str(tmp_path / "b"), "all").count() == 2 * len(ROWS)


def test_gate_of_the_forecast(tmp_path, monkeypatch):
    from sluice.plans import forecast

    saved = []
    monkeypatch.setattr(forecast, "save_model", lambda *args: saved.append(args) or "path")
    at = datetime.datetime(2024, 1, 1)
    assert forecast.register(None, 3.0, 2.9, "root", "quantity", at) is None and not saved
    assert forecast.register(None, float("nan"), 2.9, "root", "quantity", at) is None
    assert forecast.register(None, 2.9, 2.9, "root", "quantity", at) == "path"


def test_trained_behind_the_gate(spark, tmp_path):
    from sluice.plans import forecast

    rows = [(datetime.date(2024, 1, 1) + datetime.timedelta(days=i), float(i % 7), float(i % 7)) for i in range(120)]
    df = spark.createDataFrame(rows, "date date, x double, quantity double")
    run = lambda limit: forecast.pipeline(df, "quantity", ["x"], datetime.date(2024, 4, 1), limit, str(tmp_path / "m"), datetime.datetime(2024, 5, 1), maxIter=3, maxDepth=3)
    assert run(0.0)["status"] == "rejected" and not (tmp_path / "m").exists()
    out = run(5.0)
    assert out["status"] == "registered" and out["rmse"] < 5
    again = forecast.predict(forecast.latest_model(spark, str(tmp_path / "m"), "quantity"), df)
    assert again.count() == 120


def test_smoothed_means_equal_the_recursion():
    import numpy as np

    from sluice.operators import series

    x = np.random.default_rng(0).gamma(1, 5, 400)
    for a in (0.05, 0.25, 1.0):
        y, want = None, []
        for v in x:
            want.append(0.0 if y is None else y)
            y = v if y is None else (1 - a) * y + a * v
        assert np.allclose(series._ewm(x, a), want)
    assert len(series._ewm(x[:0], 0.5)) == 0


def test_small_results(spark):
    from sluice.operators import relational

    with pytest.raises(ValueError):
        relational.as_dict(spark.range(5).toDF("a"), most=4)
    assert relational.as_dict(spark.range(3).toDF("a")) == {"a": [0, 1, 2]}


def test_void_columns(spark):
    assert snapshot.without_void(spark.sql("SELECT NULL AS a, 1 AS b")).dtypes == [("a", "string"), ("b", "int")]


def test_scd2_sequence(spark):
    day = lambda n: datetime.datetime(2024, 1, n)
    load = lambda *rows: spark.createDataFrame(rows, "k string, v int")
    state, sizes = None, []
    for n, rows in enumerate([[("A", 1), ("B", 1)], [("A", 1), ("B", 1)], [("A", 2), ("B", 1), ("C", 1)], [("A", 1)], [("A", 1)]], 1):
        state = snapshot.scd2(state, load(*rows), ["k"], day(n)).checkpoint()
        sizes.append((state.count(), snapshot.current_rows(state).count()))
    assert sizes == [(2, 2), (2, 2), (4, 3), (5, 3), (5, 3)]
    a = state.where("k = 'A'").orderBy("_valid_from").collect()
    assert [(r.v, r._valid_from, r._valid_to) for r in a] == [(1, day(1), day(3)), (2, day(3), day(4)), (1, day(4), None)]
    assert a[0]._row_hash == a[2]._row_hash
    from sluice.operators.quality import mutually_exclusive_ranges, one_current

    assert one_current(state, ["k"]).count() == 0
    assert mutually_exclusive_ranges(state.withColumn("to", F.col("_valid_to")), "_valid_from", "to", ["k"], gaps="not_allowed").count() == 0
