"""Band series and soil chemistry jobs."""

import datetime as dt

from pyspark.sql import functions as F

from pradera import schemas
from pradera.plans import series_jobs as S

from .fixtures import paddock_log




def test_band_series(spark):
    d0 = dt.datetime(2024, 1, 1)
    rows = [(1, "RC01", "ndvi", d0, 0.5), (1, "RC01", "ndvi", d0 + dt.timedelta(days=2), 0.7),
            (1, "RC01", "evi", d0 + dt.timedelta(days=1), 0.2), (2, "RC02", "ndvi", d0 + dt.timedelta(days=33), 0.9)]
    data = spark.createDataFrame(rows, schemas.BANDS)
    filtered, full, docs = S.band_series(data, ["ndvi"], start="no")
    assert full.count() == 3 * 34
    assert filtered.filter("mean_value IS NOT NULL").count() == 3
    doc = {r.key: r.json for r in docs.collect()}
    assert doc["1/2024-01"].startswith('{"2024-01":["2024-01-01","2024-01-02"')
    assert '"ndvi":["0.5",null,"0.7",null' in doc["1/2024-01"]


def test_soil_chemistry(spark):
    rows = [(0, "RECODO", "LOTE 1,2:3", "01/01/2024", 1.0, 2.0, 3.0, 4.0, 5.0),
            (1, "ISLA", "JUNCAL 4", "01/03/2024", 9.0, None, None, None, None),
            (2, "RECODO", "LOTE 1", "12/30/2023", 7.0, 7.0, 7.0, 7.0, 7.0)]
    props = spark.createDataFrame(rows, schemas.SOIL)
    names = sorted(r.name_c for r in S.soil_paddocks(props).collect())
    # "LOTE 1,2:3": the number after the colon wins per position, the head fills the rest
    assert names == ["Juncalito-Lote_04", "RC01", "RC02", "RC03"]
    kept, changes, elements, cal, p, stats = S.soil_chemistry(props, ["N", "P", "K", "CA", "MG"], "20240101", thresh=6)
    got = {(r.name_c, str(r.date)): r.N for r in kept.collect()}
    assert got[("RC03", "2024-01-03")] == 1.0 and got[("RC02", "2024-01-02")] == 1.0
    # RC01 only has a value dated before the start: it is not carried in
    assert not any(k[0] == "RC01" for k in got)
    kept2 = S.soil_chemistry(props, ["N"], "20240101", thresh=6, carry_in=True)[0]
    assert kept2.filter("name_c = 'RC01'").select(F.min("N")).first()[0] == 7.0
    assert sorted(str(r.FECHA) for r in changes.collect()) == ["2024-01-01", "2024-01-03"]
    s = stats.first()
    assert s.total_cells > 0 and 0 <= s.na_ratio <= 1


