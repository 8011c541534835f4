import json
import os

import pytest
from pyspark.sql import types as T

from cumulus.schemas import COUNTY_RECORD, ELIGIBILITY, FIPS, POPULATION
from cumulus.sources.files import (OutputIsInput, read_csv_typed, read_json_envelope,
                                   refuse_overlap, write_csv)


def test_json_envelope_second_field_missing_fields_are_null(spark, tmp_path):
    doc = {"runid": 1, "vaccination_county_condensed_data": [
        {"Date": "2021-07-21", "FIPS": "25001", "StateAbbr": "MA  ", "Series_Complete_Pop_Pct": 60.1},
        {"Date": "2021-07-21", "FIPS": "UNK", "StateAbbr": "MA", "Series_Complete_Pop_Pct": None},
        {"FIPS": "25003"}]}
    p = tmp_path / "county.json"
    p.write_text(json.dumps(doc, indent=2))
    df = read_json_envelope(spark, str(p), COUNTY_RECORD, "vaccination_county_condensed_data",
                            head_field="runid", multi_line=True)
    rows = {r.FIPS: r for r in df.collect()}
    assert rows["25001"].Series_Complete_Pop_Pct == 60.1
    assert rows["UNK"].Series_Complete_Pop_Pct is None
    assert rows["25003"].Date is None and rows["25003"].County is None


def test_json_malformed_fails(spark, tmp_path):
    p = tmp_path / "bad.json"
    p.write_text('{"meta": 1, "records": [ {"FIPS": ')
    with pytest.raises(Exception):
        read_json_envelope(spark, str(p), COUNTY_RECORD, "records", multi_line=True).collect()


def test_typed_csv_na_and_empty_are_null(spark, tmp_path):
    p = tmp_path / "pop.csv"
    p.write_text("Geographic_Area_Name,Census2019_2,Census2019_18PlusPop_2,postal_code,fips_code\n"
                 "Alabama,4903185,3814879,AL,1\nGuam,NA,,GU,\n")
    rows = {r.postal_code: r for r in read_csv_typed(spark, str(p), POPULATION).collect()}
    assert rows["AL"].Census2019_2 == 4903185 and rows["AL"].fips_code == 1
    assert rows["GU"].Census2019_2 is None and rows["GU"].Census2019_18PlusPop_2 is None


def test_csv_sink_keeps_padding_and_nulls(spark, scratch):
    df = spark.createDataFrame([("  5,219", None), ("61,657", 1.5)], "d string, x double")
    path = scratch("sink")
    write_csv(df, path, single_file=True)
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(files) == 1
    text = open(os.path.join(path, files[0])).read()
    assert '"  5,219",NA' in text
    back = read_csv_typed(spark, path, T.StructType([T.StructField("d", T.StringType()),
                                                     T.StructField("x", T.DoubleType())]))
    assert sorted(r.d for r in back.collect()) == ["  5,219", "61,657"]


@pytest.mark.parametrize("text,error", [
    ("Geographic_Area_Name,Census2019_18PlusPop_2,Census2019_2,postal_code,fips_code\nA,1,2,AL,1\n",
     "header"),                                                        # two columns swapped
    ("Geographic_Area_Name,Census2019_2,Census2019_18PlusPop_2,postal_code,fips_code,x\nA,1,2,AL,1,9\n",
     "header"),                                                        # a surplus column
    ("Geographic_Area_Name,Census2019_2,Census2019_18PlusPop_2,postal_code,fips_code\nA,1,2,AL,1,9\n",
     "MALFORMED"),                                                     # a surplus value
    ("Geographic_Area_Name,Census2019_2,Census2019_18PlusPop_2,postal_code,fips_code\n"
     "A,\"1,234\",2,AL,1\n", "MALFORMED")])                           # not a number
def test_typed_csv_is_strict(spark, tmp_path, text, error):
    p = tmp_path / "pop.csv"
    p.write_text(text)
    with pytest.raises(Exception, match=f"(?i){error}"):
        read_csv_typed(spark, str(p), POPULATION).collect()


def test_population_eligibility_and_fips_scans(spark, tmp_path):
    p = tmp_path / "pop.csv"
    p.write_text(",".join(POPULATION.fieldNames()) + "\nAlabama,4903185,3814879,AL,1\n"
                 "Alaska,731545,551562,AK,2\n")
    assert [tuple(r) for r in read_csv_typed(spark, str(p), POPULATION).orderBy("fips_code").collect()] \
        == [("Alabama", 4903185, 3814879, "AL", 1), ("Alaska", 731545, 551562, "AK", 2)]
    e = tmp_path / "eligibility.csv"
    e.write_text(",".join(ELIGIBILITY.fieldNames()) + "\nAlabama," + ",".join(map(str, range(14)))
                 + ",AL,1\n")
    r = read_csv_typed(spark, str(e), ELIGIBILITY).first()
    assert r["State"] == "Alabama" and r["Total_people_to_vaccinate"] == 13 and r["fips_code"] == 1
    f = tmp_path / "fips.csv"
    f.write_text("name,postal_code,fips_code\nAlabama,AL,1\nGuam,GU,NA\n")
    assert [tuple(r) for r in read_csv_typed(spark, str(f), FIPS).orderBy("name").collect()] == [
        ("Alabama", "AL", 1), ("Guam", "GU", None)]


def test_sink_refuses_to_overwrite_its_own_input(spark, scratch):
    df = spark.createDataFrame([(1,), (2,)], "x long")
    base = scratch("own")
    write_csv(df, f"{base}/a", single_file=True)
    back = read_csv_typed(spark, f"{base}/a", df.schema)
    for path in (f"{base}/a", base):
        with pytest.raises(OutputIsInput):
            write_csv(back, path)
    with pytest.raises(OutputIsInput):
        refuse_overlap(spark, f"{base}/a/deeper", [f"{base}/a"])
    assert back.count() == 2
    write_csv(back, f"{base}/ab")


def test_dated_sink_and_csv_history(spark, scratch):
    import datetime as dt
    from cumulus.sources.history import read_history
    df = spark.createDataFrame([(dt.date(2021, 7, 21), "MA", 3)], "Date date, Location string, x long")
    base = scratch("dated")
    p1 = write_csv(df, base, single_file=True, run_date=dt.date(2021, 7, 21))
    p2 = write_csv(df, base, single_file=True, run_date=dt.date(2021, 7, 22))
    assert p1.endswith("run_date=2021-07-21") and p2 != p1
    back = read_history(spark, p1, df.schema, fmt="csv")
    assert back.collect() == df.collect()


class _Conf(dict):
    def get(self, k, default=None):
        return dict.get(self, k, default)


class _Ctx:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt = master, ckpt

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, d):
        self._ckpt = d


class _Session:
    def __init__(self, master, conf=None):
        self.conf, self.sparkContext = _Conf(conf or {}), _Ctx(master)


def test_shared_dir_reads_session_setting_and_refuses_local_folder_on_cluster():
    import pytest
    from cumulus.session import shared_dir
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"})
    assert shared_dir(s) == "hdfs://nn/shared/ckpt"
    assert s.sparkContext.getCheckpointDir() == "hdfs://nn/shared/ckpt/"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session("spark://master:7077"))
    local = _Session("local[2]")
    assert shared_dir(local) == local.sparkContext.getCheckpointDir().rstrip("/")
