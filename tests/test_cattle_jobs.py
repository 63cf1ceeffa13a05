"""Cow jobs on synthetic fixtures (invented names only)."""

import datetime as dt


from pradera import schemas
from pradera.plans import cattle_jobs as C

OPERATORS = {"ANA": 19, "LUIS": 28}


def _cows(spark):
    rows = [(1, 1, 0, None, "LUNA", 2, 1, None, None, None, 2, None, 2, None, None),
            (2, 1, 0, None, "SOL", 2, 1, None, None, None, 2, None, 1, None, None),
            (3, 1, 0, None, "SOL", 2, 1, None, None, None, 2, None, 2, None, None),     # duplicate name
            (4, 1, 0, None, "NUBE", 2, 1, None, None, None, 2, None, 3, None, None)]    # not active (3)
    return spark.createDataFrame(rows, schemas.VACAS)


def test_mastitis_incremental_load(spark):
    m = [(0, 1, "LUNA", "R1", "P", "0", "PI", None, "ANA", "ok", "2024-01-05", "85%", "90%", "70%", "si", "F", "1", 1),
         (1, 1, "LUNA", "R1", "p", "1", "2", "3", "PEDRO", "ok", "2024-01-05", "80%", "90%", "70%", "si", "F", "1", 1),
         (2, 2, "SOL", "R1", "1", "1", "1", "1", "LUIS", "x", "2024-01-06", "50%", "50%", "50%", "no", "F", "1", 1),
         (3, 9, "X", "R1", "1", "1", "1", "1", "LUIS", "x", "2024-01-06", "50%", "50%", "50%", "no", "F", "1", 1),
         (4, None, "Y", "R1", "1", "1", "1", "1", "LUIS", "x", "2024-01-06", "50%", "50%", "50%", "no", "F", "1", 1)]
    mast = spark.createDataFrame(m, schemas.MASTITIS)
    stored = spark.createDataFrame(
        [(100, 2, 9, 34, 28, 1, dt.datetime(2024, 1, 6), "x"), (101, 4, 9, 34, 28, 1, dt.datetime(2024, 1, 1), "y")],
        schemas.ACTIVIDADES_VACAS)
    new, detail, missing, existing, rejected = C.mastitis_load(mast, stored, _cows(spark), OPERATORS)
    n = sorted((r.ID_VACA, r.ID_OPERARIO, r.ID_Actividad) for r in new.collect())
    # cow 2 already stored that day; cow 9 unknown; null cow dropped; LUNA has two rows (two operators)
    assert n == [(1, 19, 102), (1, 35, 103)]
    assert missing.count() == 1 and existing.count() == 1
    d = {r.ID_Actividad: r for r in detail.collect()}
    assert d[102].AI == 5 and d[102].PI == 2 and abs(d[102].Ubre_sana - 0.80) < 1e-9   # keep-last file row


def test_mastitis_details_are_reduced_before_the_join_and_only_new_ones_are_numbered(spark, monkeypatch):
    m = [(i, 1, "LUNA", "R1", "1", "0", "0", None, "ANA", f"c{i % 10}", d, "85%", "90%", "70%", "si", "F", "1", 1)
         for i, d in enumerate(["2024-01-05", "01/05/2024", "2024/01/05", "05-01-2024", None] * 20)]
    mast = spark.createDataFrame(m, schemas.MASTITIS)
    stored = spark.createDataFrame([(100, 2, 9, 34, 28, 1, dt.datetime(2024, 1, 6), "x")], schemas.ACTIVIDADES_VACAS)
    sizes, keep_last, assign_ids = [], C.keep_last, C.assign_ids
    monkeypatch.setattr(C, "keep_last", lambda df, *a: sizes.append(df.count()) or keep_last(df, *a))
    new, detail, missing, existing, rejected = C.mastitis_load(mast, stored, _cows(spark), OPERATORS)
    assert sizes == [40]  # the file's rows with that date, not each with each of its activities
    last = {r.ID_Actividad: r.Ubre_sana for r in detail.collect()}
    dated = {r.ID_Actividad for r in new.where("Fecha is not null").collect()}
    assert len(last) == new.count() and {k for k, v in last.items() if v is not None} == dated
    assert rejected.count() == 40
    monkeypatch.setattr(C, "assign_ids", None)  # the other outputs have no new ids
    checks, rejected = C.mastitis_checks(mast, OPERATORS)
    r = C.mastitis_reconciled(checks, stored)
    assert rejected.count() == 40 and r.where("_merge = 'right_only'").count() == 1
    monkeypatch.setattr(C, "assign_ids", assign_ids)


def test_transfers_missing_and_duplicates(spark):
    t = [(0, "HEADER", "NI"), (1, " LUNA ", "R 1"), (2, "SOL", "CF"), (3, "ESTRELLA", "JCAL"), (4, "LUNA", "R 1"),
         (5, "NUBE", "R 2")]
    tf = spark.createDataFrame(t, schemas.TRANSFERS)
    ready, loc, matched = C.transfers(tf, _cows(spark))
    assert sorted((r.ID_VACA, r.ID_HATO) for r in ready.collect()) == [(1, 1)]
    assert {r.ID_LOTE for r in loc.collect()} == {9999}
    dup = C.duplicate_report(matched, _cows(spark))
    assert sorted(r.ID_VACA for r in dup.collect()) == [2, 3]
    assert "Nombre_Vaca_x" in dup.columns and "Nombre_Vaca_y" in dup.columns
    export = spark.createDataFrame(
        [(0, "ESTRELLA ", "HO", "He:Rp", "77", "SOL", None, "03/02/2020", None, "E1", None),
         (1, "NUBE", "AN", "He:Rp", None, None, None, "bad", "NUBE", None, None)], schemas.ANIMAL_EXPORT)
    new = C.register_missing_cows(matched, export, _cows(spark)).collect()
    got = {r.Nombre_Vaca: r for r in new}
    assert set(got) == {"ESTRELLA"}                      # NUBE exists in the cow table already
    e = got["ESTRELLA"]
    assert e.Raza == 2 and e.Sexo == 1 and e.FechaNacimiento == dt.date(2020, 2, 3) and e.Sire == 77


def test_registering_makes_no_row_for_each_mother_and_transfer(spark, monkeypatch):
    cows = [(i, 1, 0, None, "LUNA", 2, 1, None, None, None, 2, None, 2, None, None) for i in range(50)]
    cows = spark.createDataFrame(cows, schemas.VACAS)
    groups = list(C.GROUP_IDS)
    matched = C.transfers(spark.createDataFrame(
        [(i, "ESTRELLA", groups[i % len(groups)]) for i in range(1, 30)], schemas.TRANSFERS), cows)[2]
    export = spark.createDataFrame(
        [(i, "ESTRELLA", "HO", "He:Rp", str(i), "LUNA", None, "03/02/2020", None, None, None) for i in range(40)],
        schemas.ANIMAL_EXPORT)
    sizes, keep_last = [], C.keep_last
    monkeypatch.setattr(C, "keep_last", lambda df, *a: sizes.append(df.count()) or keep_last(df, *a))
    new = C.register_missing_cows(matched, export, cows).collect()
    assert [(r.Nombre_Vaca, r.Sire, r.VacaMadre) for r in new] == [("ESTRELLA", 39, 49)]
    assert sizes == [40]  # a row of the export each; was 9 transfer rows x 40 x 50 mothers


def test_animals_extract(spark):
    a = spark.createDataFrame([(5, "E", "LUNA", 103, 2, None, None, None, -1, None, 2, None, 9)], schemas.ANIMALS)
    r = C.animals_extract(a).first()
    assert r.Raza == 2 and r.IDTipoOrigen == 1 and r.IDTipoSalida == 3 and r.ID_CLIENTE == 1
