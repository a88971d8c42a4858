"""Clocks, names, summaries, imaging rules, readers, sinks and streams."""

import datetime

from pyspark.sql import functions as F

from fieldgeo.functions import clock, text
from fieldgeo.operators import imaging, relational, summary
from fieldgeo.sources import readers, sinks
from fieldgeo.streaming import live


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_clocks(spark):
    assert one(spark, clock.roll_clock(F.lit("105960.5"))) == "110000.5" and one(spark, clock.roll_clock(F.lit("235960"))) == "000000"
    assert one(spark, clock.gps_to_utc(F.lit(0), F.lit(16))) == datetime.datetime(1980, 1, 6)
    assert one(spark, clock.cut_time(F.lit(3723.5))) == "01:02:03.500" and one(spark, clock.clock_ms(F.lit("100000.25"))) == 36_000_250
    assert one(spark, clock.parse_date(F.lit("0000/00/00"))) is None and one(spark, clock.parse_date(F.lit("2018/04/05"))) == datetime.date(2018, 4, 5)
    stamp = clock.exif_timestamp(F.lit("2018:04:05"), F.lit("[7, 8, 905/100]"), F.lit(None).cast("string"))
    assert one(spark, stamp) == datetime.datetime(2018, 4, 5, 7, 8, 9)
    assert one(spark, clock.exif_timestamp(F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit("2018:01:02 03:04:05"))) == datetime.datetime(2018, 1, 2, 3, 4, 5)
    assert one(spark, clock.iso_date(F.lit("20180405"))) == "2018-04-05" and one(spark, clock.iso_time(F.lit("070809.5"))) == "07:08:09.5"
    assert one(spark, clock.roll_end_date(F.lit("2018-04-05").cast("date"), F.lit("23"), F.lit("01"))) == datetime.date(2018, 4, 6)
    ms = clock.capture_ms(F.lit("2018-04-05 12:00:00").cast("timestamp"), F.lit("Etc/GMT+5"), F.lit(30), F.lit(24.0))
    assert one(spark, ms) == int(datetime.datetime(2018, 4, 5, 17, tzinfo=datetime.UTC).timestamp() * 1000) + 1250


def test_names(spark):
    x = one(spark, text.dataset_fields(F.lit("20180404_18ASH_BYD0BYD2_Rededge_20m_-90_Still_Flight1")))
    assert x["is_valid"] and (x["camera"], x["elevation"], x["angle"], x["type"], x["flight"]) == ("MRE", 20, 90, "Still", 1)
    assert one(spark, text.dataset_fields(F.lit("20180404_18ASH_x_Rededge_20m_-190_Still_Flight1"))["error"]) == "angle"
    assert one(spark, text.dataset_fields(F.lit("nothing"))["error"]) == "fields"
    a = one(spark, text.archived_fields(F.lit("20180404_120000_20m_RE_-90_STILL_0")))
    assert (a["experiment"], a["elevation"], a["seq"]) == (None, 20.0, 0)
    assert one(spark, text.set_stem(F.lit("IMG_0001_5"))) == "IMG_0001" and one(spark, text.ext(F.lit("/a/b.c/IMG.TIF"))) == "tif" and one(spark, text.stem(F.lit("/a/b.c/IMG.TIF"))) == "IMG"
    assert one(spark, text.clean_id(F.lit(" a_b "))) == "a-b" and one(spark, text.zfill(F.lit(12345), 3)) == "12345" and one(spark, text.band_name(F.lit("thermal"))) is None


def test_image_sets_and_altitudes(spark):
    big, small = 3_000_000, 5
    data = [("a", big)] * 5 + [("b", big)] * 4 + [("c", big)] * 4 + [("c", small)] + [("d", big)] * 3 + [("d", small)]
    got = {r["stem"]: r["reason"] for r in imaging.validate_sets(spark.createDataFrame(data, "stem string, size long")).collect()}
    assert got == {"a": None, "b": "missing", "c": "truncated", "d": "truncated"}
    df = spark.createDataFrame([("f", float(a)) for a in (0, 10, 20, 30)], "flight string, altitude double")
    assert imaging.altitude_threshold(df, "flight").first()[1:] == (10.0, 20.0, 15.0)


def test_run_tables(spark):
    runs = spark.createDataFrame([("a",), ("b",), ("b",)], "run_id string")
    assert [r[0] for r in summary.append_new(runs, spark.createDataFrame([("a",)], "run_id string"), "run_id").collect()] == ["b"]
    trig = spark.createDataFrame([(1, "x", "y", "z"), (2, "p", "q", "r")], "t int, cam1 string, cam2 string, cam3 string")
    pos = spark.createDataFrame([(1, 7, 0.5), (1, 3, 0.25)], "t int, seq int, x double")
    assert sorted((r["camera"], r["image"], r["x"]) for r in relational.match_rover(trig, pos).collect()) == [(1, "x", 0.25), (2, "y", 0.25), (3, "z", 0.25)]


def test_readers_and_sinks(spark, tmp_path):
    fields = ["0"] * 44
    line = lambda **kw: ",".join(kw.get(f"f{i}", v) for i, v in enumerate(fields))
    (tmp_path / "flight1.csv").write_text("\n".join([",".join(f"h{i}" for i in range(44)), line(f0="39.1", f1="-96.6", f2="100", f37="1", f43="1500000000123"), line(f0="39.2", f1="-96.5", f37="0", f43="bad")]))
    r = readers.read_flight_log(spark, str(tmp_path / "flight1.csv")).collect()
    assert len(r) == 1 and (r[0]["flight_id"], r[0]["recording"], r[0]["ts_ms"], round(r[0]["alt"], 2)) == ("flight1", True, 1500000000123, 30.48)
    (tmp_path / "auto.log").write_text("FMT, x\nCAM, 1000, 1900, 39.1, -96.6, 0, 50\nGPS, 1, 2000, 1900, 0, 0, 39.3, -96.7, 60\n")
    cam, gps = readers.read_tagged_log(spark, str(tmp_path / "auto.log"))
    assert (cam.first()["week"], gps.first()["lat"]) == (1900, 39.3)
    (tmp_path / "plan.csv").write_text("lat,lon\n1,2\n3,4\n")
    assert [(r["seq"], r["lat"]) for r in readers.read_plan(spark, str(tmp_path / "plan.csv")).orderBy("seq").collect()] == [(1, 1.0), (2, 3.0)]
    (tmp_path / "img").mkdir()
    (tmp_path / "img" / "a.tif").write_bytes(b"abc")
    (tmp_path / "img" / "b.txt").write_bytes(b"abc")
    assert [(r["name"], r["size"], r["md5sum"]) for r in readers.list_images(spark, str(tmp_path / "img"), "tif", md5=True).collect()] == [("a.tif", 3, "900150983cd24fb0d6963f7d28e17f72")]
    df = spark.createDataFrame([("a.tif", "f1", 1.0)], "image_file_name string, flight_id string, altitude double")
    sinks.write_metadata(df, str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).first()["image_file_name"] == "a.tif"
    sinks.append_table(df, str(tmp_path / "t"))
    sinks.append_new(df.unionAll(spark.createDataFrame([("b.tif", "f1", 2.0)], df.schema)), str(tmp_path / "t"), "image_file_name")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_streams(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    data = [(1, start + datetime.timedelta(seconds=s), rec) for s, rec in ((0, True), (5, True), (100, True), (101, False), (500, True))]
    src = str(tmp_path / "in")
    spark.createDataFrame(data, "flight_id long, ts timestamp, recording boolean").write.parquet(src)
    log = spark.readStream.schema("flight_id long, ts timestamp, recording boolean").parquet(src)
    q = live.recording_sessions(log).writeStream.format("memory").queryName("sessions").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["n"] for r in spark.table("sessions").collect()) == [1, 2]
    src = str(tmp_path / "gaps")
    spark.createDataFrame([(1, 1000, 0.0, 0.0, True), (1, 1030, 3.0, 3.0, True)], "flight_id long, ts_ms long, lat double, lon double, recording boolean").write.parquet(src)
    log = spark.readStream.schema("flight_id long, ts_ms long, lat double, lon double, recording boolean").parquet(src)
    q = live.fill_gaps(log).writeStream.format("memory").queryName("gaps").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r["ts_ms"], round(r["lat"], 6), r["interpolated"]) for r in spark.table("gaps").collect()) == [(1000, 0.0, False), (1010, 1.0, True), (1020, 2.0, True), (1030, 3.0, False)]
