import datetime
import json

from pyspark.sql import functions as F

from cadastra.sources import readers, sinks
from cadastra.streaming.edits import current_state, edit_stream, event_windows, merge_batch, run_upserts, whole_versions


def test_register(spark, tmp_path):
    head = "kucni_broj_id,kucni_broj,retired,ulica_maticni_broj,ulica_ime,ulica_ime_lat,naselje_maticni_broj,naselje_ime,naselje_ime_lat,opstina_maticni_broj,opstina_ime,opstina_ime_lat,wkt\n"
    rows = ['01,12 А,,007,Улица Прва,Prva,S1,Ада,Ada,M1,АДА,Ada,"POINT (457000.5 4962000.25)"', "02,бб, ,007,Улица Прва,Prva,S1,Ада,Ada,M1,АДА,Ada,POINT (1 2)", "03,5,2020,007,x,x,S1,x,x,M1,x,x,POINT (1 2)", "04,5,,008,y,y,S1,x,x,M1,x,x,EMPTY"]
    (tmp_path / "r.csv").write_text(head + "\n".join(rows))
    reg = readers.csv_strings(spark, str(tmp_path / "r.csv"), head.strip().split(","))
    got = {r.id: r for r in readers.addresses(spark, reg).collect()}
    assert set(got) == {"01", "02"} and (got["01"].house_num, got["01"].house_suffix, got["02"].house_num, got["02"].house_suffix) == (12, "А", None, "ББ")
    assert got["01"].street_id == "007" and abs(got["01"].lat - 44.81) < 0.1 and abs(got["01"].lon - 20.456) < 0.1
    assert [r.name_norm for r in readers.streets(reg.where("kucni_broj_id = '01'")).collect()] == ["1"]
    munis, setts = readers.places(reg)
    assert munis.count() == 1 and setts.count() == 1
    assert readers.csv_optional(spark, str(tmp_path / "none.csv"), "a string, b string").count() == 0


def test_logs_and_features(spark, tmp_path):
    (tmp_path / "log.json").write_text('{"station_id": 1, "raw_coverage_text": "x"}\nnot json\n')
    assert [r.station_id for r in readers.json_log(spark, str(tmp_path / "log.json"), "station_text_overrides").collect()] == [1]
    assert readers.json_log(spark, str(tmp_path / "absent.json"), "removed_stations").count() == 0
    fc = {"features": [{"properties": {"b": "7"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}, {"properties": {"a": "5", "b": "6"}, "geometry": {"type": "Point", "coordinates": [3, 4]}}, {"properties": {}, "geometry": None}]}
    (tmp_path / "f.geojson").write_text(json.dumps(fc))
    f = readers.geojson_features(spark, str(tmp_path / "f.geojson"), ["a", "b"])
    assert sorted((r.key, r.coordinates) for r in f.collect()) == [("5", "[3,4]"), ("7", "[1,2]")]
    assert readers.precedence(f.where("key = '5'"), f, "key").count() == 2
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "Ada.txt").write_text("уместо: x")
    (tmp_path / "d" / "~$Ada.txt").write_text("y")
    d = readers.documents(spark, str(tmp_path / "d")).withColumn("kind", readers.classify_document(F.col("file"), F.col("text")))
    assert [(r.file, r.kind) for r in d.collect()] == [("Ada.txt", "amendment")]


def test_html_rows():
    html = "<table><tr><td>НАЗИВ ГЛАСАЧКОГ МЕСТА</td><td>a</td><td>b</td><td>c</td></tr><tr><td>3.</td><td>Школа</td><td>Прва<br>1</td><td>А</td><td>Б</td></tr><tr><td></td><td>Дом</td><td>x</td><td>y</td></tr><tr><td>1</td><td></td><td>x</td><td>y</td></tr></table>"
    assert readers.table_rows(html) == [{"number": 3, "name": "Школа", "address": "Прва 1", "coverage": "А Б"}, {"number": 2, "name": "Дом", "address": "x", "coverage": "y"}]
    loose = "<table><tr><td>5<td>Дом<td>Трг<td>А<tr><td>6<td>Школа<td>Трг 2<td><table><tr><td>у<td>нутра</table>Б"
    assert [(r["number"], r["name"], r["coverage"]) for r in readers.table_rows(loose)] == [(5, "Дом", "А"), (6, "Школа", "унутраБ")]
    assert readers.table_rows(None) == []


def test_cache(spark):
    cache = spark.createDataFrame([("street|1|A", [("building", "yes"), ("highway", "residential")]), ("street|1|B", [])], "key string, rows array<struct<class:string,type:string>>")
    asked = spark.createDataFrame([("street", "1", x) for x in "ABC"], "kind string, muni_id string, norm string")
    got = {r.norm: (r.known, r.hit and r.hit["class"]) for r in readers.cached_lookup(asked, cache).collect()}
    assert got == {"A": (True, "highway"), "B": (True, None), "C": (False, None)}


def test_statements(spark):
    df = spark.range(1300).select("id", F.lit("O'Hara").alias("name"), F.lit(None).cast("double").alias("x"))
    got = sinks.insert_statements(df, "t", "id", lanes=2).collect()
    assert sum(r.statement.count("(") - 1 for r in got) == 1300 and all(len(r.statement.encode()) <= 50_000 and r.statement.count("(") <= 501 for r in got)
    assert "'O''Hara',NULL)" in got[0].statement
    assert sinks.delete_statements(df.limit(1).select("id"), "t", "id").first().statement == "DELETE FROM t WHERE id=0;"


def test_delta_converges(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, v string")
    b = spark.createDataFrame([(1, "x2"), (3, None)], "id long, v string")
    none = spark.createDataFrame([], "key string, sig string")
    first, m = sinks.delta_with_manifest(a, none, "id")
    assert {(r.key, r.action) for r in first.collect()} == {("1", "U"), ("2", "U")}
    changes, m2 = sinks.delta_with_manifest(b, m, "id")
    assert {(r.key, r.action) for r in changes.collect()} == {("1", "U"), ("2", "D"), ("3", "U")}
    assert {(r.key, r.action) for r in sinks.delta_with_manifest(b, m, "id")[0].collect()} == {("1", "U"), ("2", "D"), ("3", "U")}
    assert sinks.delta_with_manifest(b, m2, "id")[0].count() == 0


def test_exports(spark):
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]
    df = spark.createDataFrame([(1, 2, "<b>", [ring]), (1, 1, "a", [ring])], "m long, n long, name string, rings array<array<struct<x:double,y:double>>>")
    fc = sinks.feature_collection(df.withColumn("g", sinks.ring_geojson(F.get("rings", F.lit(0)))), ["m"], "g", ["n", "name"], "n").first().geojson
    parsed = json.loads(fc)
    assert [f["properties"]["n"] for f in parsed["features"]] == [1, 2] and parsed["features"][0]["geometry"]["coordinates"][0][-1] == [0.0, 0.0]
    out = sinks.kml(df, ["m"], "name", "n", "rings", "n").first().kml
    assert "&lt;b&gt;" in out and out.index(">a<") < out.index("&lt;b") and out.count("<Placemark>") == 2


def test_scoped_write(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "scope long, v string"), path, "scope")
    sinks.write_scoped(spark.createDataFrame([(2, "c")], "scope long, v string"), path, "scope")
    assert sorted((r.scope, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "c")]


def test_edit_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    schema = "edit_id string, segment_id long, reviewed int, updated_at timestamp"
    row = lambda e, s, r, t: json.dumps({"edit_id": e, "segment_id": s, "reviewed": r, "updated_at": f"2024-01-01T00:00:{t:02}"})
    (src / "a.json").write_text("\n".join([row("e1", 1, 0, 1), row("e2", 2, 0, 2), row("e1", 1, 0, 1), row("e3", 1, 1, 3)]))
    q = run_upserts(edit_stream(spark, str(src), schema), str(tmp_path / "state"), str(tmp_path / "cp"), "segment_id")
    q.awaitTermination(120)
    got = current_state(spark, str(tmp_path / "state"))
    assert sorted((r.segment_id, r.reviewed) for r in got.collect()) == [(1, 1), (2, 0)]
    late = spark.createDataFrame([("e9", 1, 0, datetime.datetime(2023, 1, 1)), ("e8", 3, 1, datetime.datetime(2024, 2, 1))], schema)
    merged = merge_batch(got, late, "segment_id")
    assert sorted((r.segment_id, r.reviewed) for r in merged.collect()) == [(1, 1), (2, 0), (3, 1)]
    assert sorted(map(str, merge_batch(merged, late, "segment_id").collect())) == sorted(map(str, merged.collect()))
    for n in (1, 2):
        (src / f"b{n}.json").write_text(row(f"n{n}", 10 + n, 0, 10 + n))
        run_upserts(edit_stream(spark, str(src), schema), str(tmp_path / "state"), str(tmp_path / "cp"), "segment_id").awaitTermination(120)
    assert whole_versions(spark, str(tmp_path / "state")) [-1] >= 2 and len(whole_versions(spark, str(tmp_path / "state"))) == 2
    assert sorted(r.segment_id for r in current_state(spark, str(tmp_path / "state")).collect()) == [1, 2, 11, 12]


def test_event_windows_stream_equals_batch(spark):
    d = "/root/testdata/sf0.001/events.parquet"
    batch = spark.read.parquet(d)
    stream = spark.readStream.schema(batch.schema).option("pathGlobFilter", "events.parquet").parquet("/root/testdata/sf0.001/")
    q = event_windows(stream).writeStream.outputMode("complete").format("memory").queryName("ev").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(map(str, spark.table("ev").collect())) == sorted(map(str, event_windows(batch).collect()))
