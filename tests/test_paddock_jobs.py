"""Paddock jobs against a brute-force sequential reading of the same rules."""


from pyspark.sql import functions as F

from pradera.plans import paddock_jobs as J

from .fixtures import lotes, paddock_log


def brute_state(rows):
    """Sequential SURVEY 3.1 chain for one paddock; rows sorted by (date, row_id)."""
    out = []
    run_rest = run_graze = 0
    seen_graze = False
    ff = {"forage": None, "up": None, "ua": None, "de": None, "sin": None}
    prev_act = None
    for i, r in enumerate(rows):
        g = r["act"] == "PASTOREO"
        rest_flag = 0 if (i == 0 or g) else 1
        graze_flag = 1 if g else 0
        run_rest = run_rest + 1 if rest_flag else 0
        run_graze = run_graze + 1 if graze_flag else 0
        vals = {"forage": r["forage"], "up": r["date"] if g else None,
                "ua": (r["animals"] or None) if g else None,
                "de": run_graze or None, "sin": run_rest or None}
        for k, v in vals.items():
            if v is not None:
                ff[k] = v
        same = (r["act"] is not None and r["act"] == prev_act)
        out.append(dict(ff, same=same, first=(i == 0), g=g))
        prev_act = r["act"]
    return out


def test_daily_tracking_matches_brute_force(spark):
    clean = J.clean_log(paddock_log(spark), start=None)
    tracked = J.daily_tracking(clean, lotes(spark))
    rows = tracked.select("lote_id", "date", "row_id", "ACTIVIDAD", "TIPO DE FORRAJE", "NUMERO ANIMALES",
                          "ultimo_pastoreo", "ultimo_animales", "dias_de_pastoreo", "dias_sin_pastoreo",
                          "actividad_change", "lote_change", "dias_sin_fumigada", "dias_sin_abonada").collect()
    # grid: 4 paddocks x 7 days (Jan 1..7) + extra rows for the two activities on Jan 2 in RC09
    assert len(rows) == 4 * 7 + 1
    by = {}
    for r in rows:
        by.setdefault(r.lote_id, []).append(r)
    for lote, rs in by.items():
        rs.sort(key=lambda r: (r.date, -1 if r.row_id is None else r.row_id))
        exp = brute_state([{"act": r.ACTIVIDAD, "forage": r["TIPO DE FORRAJE"], "date": r.date,
                            "animals": r["NUMERO ANIMALES"]} for r in rs])
        for r, e in zip(rs, exp):
            assert r["TIPO DE FORRAJE"] == e["forage"]
            assert r.ultimo_pastoreo == e["up"] and r.ultimo_animales == e["ua"]
            assert r.dias_de_pastoreo == e["de"] and r.dias_sin_pastoreo == e["sin"], (lote, r)
            assert r.actividad_change == e["same"] and r.lote_change == e["first"]


def test_rc09_values(spark):
    clean = J.clean_log(paddock_log(spark), start=None)
    tracked = J.daily_tracking(clean, lotes(spark)).filter("lote_id = 101").orderBy("date", F.col("row_id").asc_nulls_first())
    r = tracked.select("dias_de_pastoreo", "dias_sin_pastoreo", "ultimo_animales", "dias_sin_fumigada").collect()
    # Jan1 graze, Jan2 graze, Jan2 fumigada, Jan3 graze(0 animals), Jan4 -, Jan5 null act, Jan6 -, Jan7 graze
    assert [x.dias_de_pastoreo for x in r] == [1, 2, 2, 1, 1, 1, 1, 1]
    assert [x.dias_sin_pastoreo for x in r] == [None, None, 1, 1, 1, 2, 3, 3]
    assert [x.ultimo_animales for x in r] == [40, 40, 40, 40, 40, 40, 40, 40]
    assert [x.dias_sin_fumigada for x in r] == [0, 1, 0, 1, 2, 3, 4, 5]
    out = J.paddock_output(tracked).orderBy("date", F.col("row_id").asc_nulls_first()).select("dias_sin_pastoreo").collect()
    assert [x[0] for x in out] == [0, 0, 1, 0, 1, 2, 3, 0]


def test_forage_current_and_legacy(spark):
    clean = J.clean_log(paddock_log(spark), start=None)
    changes, cur = J.forage_history(clean, lotes(spark))
    _, leg = J.forage_history(clean, lotes(spark), legacy=True)
    cur = {r.lote_id: r["TIPO DE FORRAJE"] for r in cur.collect()}
    leg = {r.lote_id: r["TIPO DE FORRAJE"] for r in leg.collect()}
    assert cur[101] == "KYKUYO" and leg[101] == "RAYGRAS"      # trap T6
    assert changes.count() == 4


def test_herd_milk_and_payloads(spark):
    clean = J.clean_log(paddock_log(spark), start=None)
    milk = {(r.ID_HATO, r.HATO_texto, str(r.FECHA_ACTIVIDAD)[:10]): (r.Numero_Animales, r.Leche_Total)
            for r in J.herd_milk(clean).collect()}
    assert milk[(1, None, "2024-01-01")] == (40, 300.0)
    assert milk[(4, None, "2024-01-04")] == (20, 90.0)
    assert (2, None, "2024-01-07") in milk and milk[(2, None, "2024-01-07")] == (0, 100.0)   # null animals -> 0
    _, cur = J.forage_history(clean, lotes(spark))
    body = {r.ID_LOTE: r.payload for r in J.forage_payload(cur).collect()}
    assert body[101] == '{"ID_LOTE":101,"ID_variedad":1}'
    otras = J.other_activities(clean, lotes(spark))
    coded = J.coded_activity_load(otras).collect()
    # the null-activity row stays (no id), the bad-date row keeps its activity id
    assert {(r.ID_LOTE, r.ID_Tipo_Actividad) for r in coded} == {(101, 1), (101, None), (102, 2), (201, 14)}
    raw = J.raw_activity_load(paddock_log(spark)).collect()
    assert len(raw) == 5          # null activity kept (trap T1)


def test_herd_path(spark):
    clean = J.clean_log(paddock_log(spark), start=None)
    tracked = J.daily_tracking(clean, lotes(spark))
    hatos, solo = J.herd_tracking(tracked)
    r1 = hatos.filter("HATO = 'RECODO 1'").orderBy("date", "lote_id").select("date", "lote_c", "lag_1", "lag_2").collect()
    seq = [(str(x.date), x.lote_c, x.lag_1, x.lag_2) for x in r1]
    assert seq[0] == ("2024-01-01", "RC09", None, None)
    assert seq[2] == ("2024-01-03", "RC09", None, None)
    assert seq[3] == ("2024-01-03", "RC10", "RC09", None)
    assert seq[-1][1] == "RC10" and seq[-1][2] == "Juncalito-Lote_03" and seq[-1][3] == "RC10"
    assert solo.filter("variable = 'lag_1'").select("HATO_C").distinct().count() >= 1
