"""Mixed spellings of one moment."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from noticeloom.functions.timestamps import with_utc
from noticeloom.plans.instants import instants

SP, BX = "America/Sao_Paulo", "Europe/Brussels"
CASES = [
    ("2024-03-05", SP, "2024-03-05T03:00:00.000000Z"), ("05/03/2024", "UTC", "2024-03-05T00:00:00.000000Z"), ("5.3.24", "UTC", "2024-03-05T00:00:00.000000Z"),
    ("26/set/2017", "UTC", "2017-09-26T00:00:00.000000Z"), ("1º de abril de 2019", "UTC", "2019-04-01T00:00:00.000000Z"), ("10 MARÇO 2024", "UTC", "2024-03-10T00:00:00.000000Z"),
    ("quarta-feira, 23 de agosto de 2017", "UTC", "2017-08-23T00:00:00.000000Z"), ("até as 22h31 de 06/03/2015", SP, "2015-03-07T01:31:00.000000Z"),
    ("22h43 do dia 17 de Outubro de 2015", "UTC", "2015-10-17T22:43:00.000000Z"), ("19/09/2022 24h", "UTC", "2022-09-20T00:00:00.000000Z"), ("19/09/2022 24h01", "UTC", None),
    ("18/08/2020 06h37min", "UTC", "2020-08-18T06:37:00.000000Z"), ("  18/08/2020 às 06:37\t", "UTC", "2020-08-18T06:37:00.000000Z"),
    ("11/07/2014 06h25 (horário de Bruxelas)", SP, "2014-07-11T04:25:00.000000Z"), ("09/07/2019 23:59 CET", SP, "2019-07-09T22:59:00.000000Z"), ("31/10/2019 23:59 BRT", "UTC", "2019-11-01T02:59:00.000000Z"),
    ("20/08/2022 22:39 GMT-3", "UTC", "2022-08-21T01:39:00.000000Z"), ("22/06/2012 23:59 GMT-03:00", "UTC", "2012-06-23T02:59:00.000000Z"), ("2027-05-17T12:00:00+05:30", "UTC", "2027-05-17T06:30:00.000000Z"),
    ("2012-11-02T08:00:00-04", "UTC", "2012-11-02T12:00:00.000000Z"), ("2025-09-11T01:07:00[Europe/Brussels]", "UTC", "2025-09-10T23:07:00.000000Z"), ("2021-01-09T08:00:00 America/Manaus", "UTC", "2021-01-09T12:00:00.000000Z"),
    ("20261003T165500Z", SP, "2026-10-03T16:55:00.000000Z"), ("2023-03-12T00:00:00,369746Z", SP, "2023-03-12T00:00:00.369746Z"), ("20120115", "UTC", "2012-01-15T00:00:00.000000Z"),
    ("1358933800", SP, "2013-01-23T09:36:40.000000Z"), ("1587115320651", SP, "2020-04-17T09:22:00.651000Z"), ("1691249752389060", SP, "2023-08-05T15:35:52.389060Z"),
    ("Mon, 11 Jan 2021 04:27:25 +0100", SP, "2021-01-11T03:27:25.000000Z"), ("Mar 13, 2014 12:05 AM UTC", SP, "2014-03-13T00:05:00.000000Z"), ("Jan 16, 2024 2:30 PM BRT", "UTC", "2024-01-16T17:30:00.000000Z"),
    # wall times that do not exist move forward, those that occur twice are the earlier
    ("2018-11-04 00:30", SP, "2018-11-04T03:30:00.000000Z"), ("2018-02-17 23:30", SP, "2018-02-18T01:30:00.000000Z"), ("2024-03-31 02:30", BX, "2024-03-31T01:30:00.000000Z"), ("2024-10-27 02:30", BX, "2024-10-27T00:30:00.000000Z"),
    *((v, "UTC", None) for v in (None, "", " ", "-", "25:70", "em breve", "31/02/2024", "2023-02-29", "2024-13-01", "outubro de 2024", "10/08/2022 a 22/09/2022", "15 dias após o resultado final", "a definir", "12/12/2024 25:00", "2024-01-01T00:60:00", "x" * 100_000)),
    ("2024-03-05", "Nowhere/City", None), ("2024-03-05T10:00:00 Nowhere/City", "UTC", None), ("2024-03-05", None, None), ("2024-03-05T10:00:00Z", None, "2024-03-05T10:00:00.000000Z"),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_cases(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(i, v, z) for i, (v, z, _) in enumerate(CASES)], "i int, valor string, zona string")
        got = {r.i: r.utc for r in with_utc(df, "valor", "zona").collect()}
        assert {i: got[i] for i in got if got[i] != CASES[i][2]} == {}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_against_zone_database(spark):
    """Hours around every clock change of some years, by an independent library."""
    rows = []
    for name in (SP, BX, "America/Manaus"):
        zone = ZoneInfo(name)
        for day in (datetime(2018, 2, 17), datetime(2018, 11, 4), datetime(2024, 3, 31), datetime(2024, 10, 27)):
            for minutes in range(0, 26 * 60, 37):
                wall = day + timedelta(minutes=minutes)
                utc = wall.replace(tzinfo=zone, fold=0).astimezone(timezone.utc)
                rows.append((wall.strftime("%d/%m/%Y %Hh%M"), name, utc.strftime("%Y-%m-%dT%H:%M:%S.000000Z")))
    df = spark.createDataFrame(rows, "valor string, zona string, want string")
    assert with_utc(df, "valor", "zona").where("not (utc <=> want)").count() == 0


def test_other_columns_and_empty(spark):
    df = spark.createDataFrame([(1, "2024-01-01", "UTC", "kept", "kept")], "i int, `v.x` string, z string, key string, region string")
    assert with_utc(df, "v.x", "z").first().asDict() == {"i": 1, "v.x": "2024-01-01", "z": "UTC", "key": "kept", "region": "kept", "utc": "2024-01-01T00:00:00.000000Z"}
    assert with_utc(df.limit(0), "v.x", "z").count() == 0


def test_tables(spark):
    ed = spark.createDataFrame([(1, "2024-01-01", None, "a"), (2, "x", "02/01/2024", None)], "edital_id bigint, data_abertura string, data_encerramento string, source string")
    raw = spark.createDataFrame([(9, "a", [("e", None), ("e", "2024-01-01")])] * 2 + [(8, "zz", None)], "raw_id bigint, source string, raw_cronograma array<struct<evento:string,data:string>>")
    src = spark.createDataFrame([("a", "UTC")], "source string, fuso string")
    got = sorted(map(tuple, instants(ed, raw, src).collect()))
    assert got == [("edital", 1, "data_abertura", 0, "2024-01-01T00:00:00.000000Z"), ("raw_edital", 9, "raw_cronograma", 1, "2024-01-01T00:00:00.000000Z")]
    assert instants(ed.limit(0), raw.limit(0), src.limit(0)).count() == 0
