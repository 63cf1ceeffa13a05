"""Declared schemas of the landed inputs (never inferred).

Every ordered landed file carries ``row_id`` (its position in the file),
written when the file is landed: it breaks ties and drives keep-last and
skip-first, since file order cannot be recovered after a parallel read.
"""

from __future__ import annotations

from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


L, I, S, D, TS, DT = LongType(), IntegerType(), StringType(), DoubleType(), TimestampType(), DateType()

# ---- operational extracts --------------------------------------------------
ANIMALS = _s(("ID", L), ("ElectronicID", S), ("Name", S), ("Breed", I), ("Sex", I), ("DamB", L), ("DamParity", L),
             ("OrigDate", DT), ("OrigType", I), ("BirthDate", DT), ("Fate", I), ("FateDate", DT), ("Sire", L))
OPERATIONS = _s(("ID", L), ("Animal", L), ("OperationType", I), ("Result", I), ("Officer", I), ("Date", TS),
                ("Remarks", S), ("Done", I))
PREG_DIAGS = _s(("ID", L), ("Animal", L), ("Result", I), ("Days", I), ("Service", L), ("OpID", L))
PARITIES = _s(("ID", L), ("Animal", L), ("Number", I), ("Sire", L), ("OpPar", L))
WEIGHTS = _s(("ID", L), ("Animal", L), ("Weight", D), ("OpID", L))
SERVICES = _s(("ID", L), ("Animal", L), ("Sire", L), ("EmbryoDonor", L), ("OpID", L))
SIRES = _s(("ID", L), ("Active", I), ("IDOfficial", S), ("AINumber", S), ("LongName", S), ("Registration", S),
           ("Breed", I), ("Discontinued", DT))
SUPPLIES = _s(("ID", L), ("Code", S), ("Name", S), ("Unit", S), ("DefaultValue", D), ("Sire", L), ("Supplier", L),
              ("Discontinued", DT))
SUPPLIERS = _s(("ID", L), ("Code", S), ("Name", S), ("Tel", S), ("Email", S), ("Contact", S), ("PostalCorr", S),
               ("Discontinued", DT))
SUPPLY_CLASSES = _s(("ID", L), ("Code", S), ("Name", S), ("Semen", I), ("InMEdReg", I), ("Feed", I), ("Discontinued", DT))
SUPP_SU_CL = _s(("ID", L), ("Supply", L), ("Class", L), ("Discontinued", DT))
SUPP_LOTS_ORIG = _s(("ID", L), ("Supply", L), ("Supplier", L))
SUPP_LOTS = _s(("OrigLot", L), ("Units", D), ("UnitCost", D), ("OrigDate", DT), ("Discontinued1", DT), ("WorkBal", D))
SUPP_LOTS_DEST = _s(("ID", L), ("Lot", L), ("Supply", L), ("Units", D), ("DestType", I), ("Date", DT), ("UnitCost", D),
                    ("Animal", L), ("Event", L))

# ---- files ------------------------------------------------------------------
PADDOCK_LOG = _s(("row_id", L), ("AÑO", I), ("MES", I), ("FINCA", S), ("POTRERO", S), ("AREA M2", D), ("ACTIVIDAD", S),
                 ("FECHA ACTIVIDAD", S), ("FECHA ENTRADA", S), ("FECHA SALIDA", S), ("FECHA PROYECTADA FUMIGACION", S),
                 ("ANO FUMIGACION", I), ("MES FUMIGACION", I), ("PRODUCTO", S), ("HATO", S), ("TIPO DE FORRAJE", S),
                 ("AFORO", D), ("NUMERO ANIMALES", I), ("LECHE TOTAL", D), ("LECHE POR DIA", D), ("LECHE POR VACA", D),
                 ("FORRAJE FRECIDO", D), ("DIAS ESTADIA", I), ("DIAS ANTIGUEDAD PASTOS", I))
MASTITIS = _s(("row_id", L), ("ID_VACA", L), ("NOMBRE", S), ("HATO", S), ("AI", S), ("AD", S), ("PI", S), ("PD", S),
              ("ORDEÑADOR", S), ("Comentario", S), ("Fecha", S), ("Ubre_sana", S), ("Calificacion", S), ("GAP", S),
              ("Chequeo_revision", S), ("FINCA", S), ("Potrero", S), ("Contador", I))
TRANSFERS = _s(("row_id", L), ("ID", S), ("Grupo", S))
ANIMAL_EXPORT = _s(("row_id", L), ("ID", S), ("Raza", S), ("Sexo/ tipo", S), ("Padre", S), ("Madre gen.", S),
                   ("Madre ", S), ("Nacimiento", S), ("Nombre", S), ("Id. Electr?ica", S), ("Toro ?t. parto", S))
BANDS = _s(("lote_id", L), ("name_c", S), ("band", S), ("date", TS), ("mean_value", D))
SOIL = _s(("row_id", L), ("FINCA", S), ("SECTOR", S), ("FECHA", S), ("N", D), ("P", D), ("K", D), ("CA", D), ("MG", D))

# ---- API dumps -----------------------------------------------------------------
CLIENTS = _s(("ID_CLIENTE", L))
LOTES = _s(("ID_FINCA", I), ("ID_LOTE", L), ("NOMBRE_LOTE", S), ("LATITUD", D), ("LONGITUD", D))
HATOS = _s(("ID_FINCA", I), ("ID_HATO", L), ("Nombre_Hato", S), ("TIPO_Hato", S))

# ---- stored target tables ---------------------------------------------------------
VACAS = _s(("ID_VACA", L), ("ID_CLIENTE", I), ("ID_FINCA", I), ("ElectronicID", S), ("Nombre_Vaca", S), ("Raza", I),
           ("Sexo", I), ("VacaMadre", L), ("IDparto", L), ("FechaRegistro", DT), ("IDTipoOrigen", I),
           ("FechaNacimiento", DT), ("IDTipoSalida", I), ("FechaSalida", DT), ("Sire", L))
ACTIVIDADES_VACAS = _s(("ID_Actividad", L), ("ID_VACA", L), ("ID_TipoOperacion", I), ("ID_Resultado", I),
                       ("ID_OPERARIO", I), ("ID_Categoria", I), ("Fecha", TS), ("Comentario", S))
