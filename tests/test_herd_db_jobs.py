"""Herd-database detail loads: recodes, audit, ids after the stored maximum, id maps."""

import datetime as dt

from pradera import schemas
from pradera.plans import herd_db_jobs as H


def _ops(spark):
    d = dt.datetime(2024, 1, 1)
    rows = [(10, 1, 92, 3, 7, d, "ok", 1), (11, 2, 101, None, 99, d, None, 1), (12, 3, 106, 5, 3, d, "x", 1),
            (13, 1, 92, 3, 7, d, "ok", 0),                      # not done
            (20, 1, 15, 1, 1, d, "M.MUERT", 1), (21, 2, 15, 1, 1, d, None, 1), (22, 2, 90, 1, 1, d, "H", 1),
            (30, 1, 17, 1, 13, d, "toro bravo", 1), (31, 2, 56, 1, 13, d, "insemi", 1)]
    return spark.createDataFrame(rows, schemas.OPERATIONS)


def _cows(spark):
    return spark.createDataFrame([(1, "LUNA"), (2, "SOL")], "ID_VACA long, Nombre_Vaca string")


def _stored(spark):
    return spark.createDataFrame([(500, 1, 3, 1, 35, 1, dt.datetime(2023, 1, 1), None)], schemas.ACTIVIDADES_VACAS)


def test_diagnosis_load(spark):
    diag = spark.createDataFrame([(1, 1, 3, 40, 7, 10), (2, 2, 9, 35, 8, 11), (2, 2, 9, 35, 8, 11)], schemas.PREG_DIAGS)
    rmap = spark.createDataFrame([(3, 60)], "ID int, id_resultado_destino int")
    out = H.detail_load(_ops(spark), diag, _stored(spark), _cows(spark), H.DIAGNOSIS, result_map=rmap)
    acts = sorted((r.ID_Actividad, r.ID_VACA, r.ID_TipoOperacion, r.ID_Resultado, r.ID_OPERARIO, r.ID_Categoria)
                  for r in out["activities"].collect())
    assert acts == [(501, 1, 4, 60, 25, 18), (502, 2, 3, 34, 35, 18), (503, 3, 6, 34, 33, 18)]
    assert [r.ID_VACA for r in out["audit"].collect()] == [3]
    det = sorted((r.IDdiagpre, r.ID_ACTIVIDAD) for r in out["detail"].collect())
    assert det == [(1, 501), (2, 502)]                   # duplicate detail row removed
    assert sorted(tuple(r) for r in out["id_map"].select("ID_Actividad_x", "ID_Actividad_y").collect()) == [
        (10, 501), (11, 502), (12, 503)]


def test_calving_and_service_categories(spark):
    out = H.detail_load(_ops(spark), None, _stored(spark), _cows(spark), H.CALVINGS)
    cats = {r.Comentario: r.ID_Categoria for r in out["activities"].collect()}
    assert cats == {"M.MUERT": 4, None: 1, "H": 11}      # null comment -> 1; category 11 kept (not 1)
    out = H.detail_load(_ops(spark), None, _stored(spark), _cows(spark), H.SERVICES)
    got = sorted((r.ID_TipoOperacion, r.ID_Resultado, r.ID_Categoria, r.ID_OPERARIO) for r in out["activities"].collect())
    assert got == [(2, 2, 13, 9), (12, 1, 12, 9)]


def test_supplies_remap_and_balance(spark):
    e = spark.createDataFrame([], schemas.SUPPLIES)
    lots_orig = spark.createDataFrame([(1, 7, 0), (2, 7, 3)], schemas.SUPP_LOTS_ORIG)
    lots = spark.createDataFrame([(1, 10.0, 0.0, None, None, 10.0), (2, 5.0, 2.0, None, None, 5.0)], schemas.SUPP_LOTS)
    dest = spark.createDataFrame([(1, 1, 7, 4.0, 1, None, 1.0, 1, 10), (2, 1, 7, 1.0, 1, None, 1.0, 2, 99)],
                                 schemas.SUPP_LOTS_DEST)
    amap = spark.createDataFrame([(1, 10, 501)], "ID_VACA long, ID_Actividad_x long, ID_Actividad_y long")
    out = H.supplies_load(e, spark.createDataFrame([], schemas.SUPPLIERS), spark.createDataFrame([], schemas.SUPPLY_CLASSES),
                          spark.createDataFrame([], schemas.SUPP_SU_CL), lots_orig, lots, dest, [amap])
    d = sorted((r.ID, r.ID_ACTIVIDAD) for r in out["Suministros_destino"].collect())
    assert d == [(1, 501), (2, None)]
    o = sorted((r.ID, r.ID_proveedor, r.Costo_unitaro) for r in out["Suministros_origen"].collect())
    assert o == [(1, None, None), (2, 3, 2.0)]
    b = H.stock_balance(out["Suministros_origen"], out["Suministros_destino"]).first()
    assert b.balance == 10.0


def test_vet_activities_dedupes_map(spark):
    m = spark.createDataFrame([(3, 40, 2), (3, 40, 2), (34, 41, 3)], "ID_RESUL_IH int, id_resultado_destino int, id_categoria_destino int")
    r = sorted((x.ID_VACA, x.ID_TipoOperacion, x.ID_Resultado) for x in H.vet_activities(_ops(spark), m).collect())
    assert r == [(1, 4, 40), (1, 4, 40), (2, 3, 41), (3, 6, None)]
