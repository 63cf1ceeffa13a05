"""Small synthetic fixtures (FIXTURES.md section 5 cases). All names invented."""

from pradera import schemas

# paddock log: (row_id, FINCA, POTRERO, ACTIVIDAD, FECHA ACTIVIDAD, HATO, TIPO DE FORRAJE, NUMERO ANIMALES, LECHE TOTAL, PRODUCTO)
LOG_ROWS = [
    (0, "EL RECODO", "9", "PASTOREO", "2024-01-01 00:00:00", "RECODO 1", "RAYGRAS", 40, 300.0, None),
    (1, "EL RECODO", "9", "PASTOREO", "2024-01-02 00:00:00", "RECODO 1", "RAYGRAS", 40, 310.0, None),
    (2, "EL RECODO", "9", "FUMIGADA", "2024-01-02 00:00:00", None, None, None, None, "GLIFO"),   # two on one day
    (3, "EL RECODO", "9", "PASTOREO", "2024-01-03 00:00:00", "RECODO 1", "KYKUYO", 0, 200.0, None),  # 0 animals
    (4, "EL RECODO", "9", None, "2024-01-05 00:00:00", None, None, None, None, None),              # null activity
    (5, "EL RECODO", "9", "PASTOREO", "2024-01-07 00:00:00", "RECODO 2", "KYKUYO", None, 100.0, None),  # herd 2
    (6, "EL RECODO", "10", "PASTOREO", "2024-01-03 00:00:00", "RECODO 1", "RAYGRAS", 35, 0.0, None),  # herd 1 moves
    (7, "EL RECODO", "10", "ABONADA", "2024-01-04 00:00:00", None, None, None, None, "UREA"),
    (8, "EL RECODO", "10", "PASTOREO", "2024-01-06 00:00:00", "RECODO 1", "RAYGRAS", 30, 250.0, None),
    (9, "JUNCAL", "3", "PASTOREO", "2024-01-04 00:00:00", "JUNCAL", "KYKUYO", 20, 90.0, None),
    (10, "JUNCAL", "3", "PASTOREO", "2024-01-05 00:00:00", "RECODO 1", "KYKUYO", 25, 95.0, None),
    (11, "JUNCAL", "3", "ROTOBO", "bad date", None, None, None, None, None),                        # bad date
    (12, "OTRA", "1", "SIEMBRA", "2024-01-02 00:00:00", None, None, None, None, "SEMILLA"),          # unknown farm
]
LOTES_ROWS = [(1, 101, "RC09"), (1, 102, "RC10"), (2, 201, "Juncalito-Lote_03"), (1, 103, "RC11")]


def paddock_log(spark):
    cols = [f.name for f in schemas.PADDOCK_LOG.fields]
    full = []
    for r in LOG_ROWS:
        row = dict.fromkeys(cols)
        (row["row_id"], row["FINCA"], row["POTRERO"], row["ACTIVIDAD"], row["FECHA ACTIVIDAD"], row["HATO"],
         row["TIPO DE FORRAJE"], row["NUMERO ANIMALES"], row["LECHE TOTAL"], row["PRODUCTO"]) = r
        full.append(tuple(row[c] for c in cols))
    return spark.createDataFrame(full, schemas.PADDOCK_LOG)


def lotes(spark):
    return spark.createDataFrame(LOTES_ROWS, "Finca int, lote_id long, nombre_lote string")
