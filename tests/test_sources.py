"""Readers and writers on temporary folders."""

from pyspark.sql import types as T

from pradera import schemas
from pradera.operators.keys import key_update
from pradera.sources import files, sinks


def test_csv_and_sheet(spark, tmp_path):
    df = spark.createDataFrame([(0, "9", "NI"), (1, " LUNA ", "R 1")], schemas.TRANSFERS)
    sinks.export_csv(df, str(tmp_path / "t"), sep=";")
    back = files.read_csv(spark, str(tmp_path / "t"), schemas.TRANSFERS, sep=";")
    assert sorted(tuple(r) for r in back.collect()) == [(0, "9", "NI"), (1, " LUNA ", "R 1")]
    sheet = files.read_sheet(spark, str(tmp_path / "t"), schemas.TRANSFERS, n_cols=2)
    assert sheet.columns == ["row_id", "ID"]


def test_json_dumps_missing_key_reads_null(spark, tmp_path):
    p = tmp_path / "lotes.json"
    p.write_text('{"ID_FINCA": 1, "ID_LOTE": 7, "NOMBRE_LOTE": "RC07", "LATITUD": 4.5}\n'
                 '{"ID_FINCA": 1, "ID_LOTE": 8}\n')
    d = files.paddocks(spark, str(p), schemas.LOTES, coords=True).orderBy("lote_id").collect()
    assert (d[0].nombre_lote, d[0].x, d[0].y) == ("RC07", 4.5, None) and d[1].nombre_lote is None
    c = tmp_path / "clientes.json"
    c.write_text('{"ID_CLIENTE": 3}\n{"ID_CLIENTE": 5}\n')
    assert sorted(r.ID_CLIENTE for r in files.client_ids(spark, str(c), schemas.CLIENTS).collect()) == [3, 5]


def test_append_replace_and_documents(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    path = str(tmp_path / "tbl")
    sinks.replace(df, path)
    sinks.append(df, path)
    sinks.replace(df, path)
    assert spark.read.parquet(path).count() == 1
    docs = spark.createDataFrame([("1/2024-01", {"b": ["2"], "a": ["1", None]})],
                                 T.StructType([T.StructField("key", T.StringType()),
                                               T.StructField("doc", T.MapType(T.StringType(), T.ArrayType(T.StringType())))]))
    out = sinks.nested_documents(docs, "key").first().json
    assert out == '{"a":["1",null],"b":["2"]}'
    sinks.export_json_documents(docs, str(tmp_path / "docs"), "key")
    assert spark.read.json(str(tmp_path / "docs")).count() == 1


def test_key_update_sets_unmatched_to_null(spark):
    cows = spark.createDataFrame([(1, "LUNA", 5), (2, "SOL", 6)], "ID_VACA long, Nombre_Vaca string, IDparto long")
    upd = spark.createDataFrame([(1, 50)], "ID_VACA long, IDparto long")
    got = sorted(tuple(r) for r in key_update(cows, upd, "ID_VACA", "IDparto").collect())
    assert got == [(1, "LUNA", 50), (2, "SOL", None)]
    assert key_update(cows, upd, "ID_VACA", "IDparto").columns == cows.columns


def test_key_update_never_adds_rows(spark):
    cows = spark.createDataFrame([(1, "LUNA", 5), (2, "SOL", 6), (None, "X", 7)], "ID_VACA long, Nombre_Vaca string, IDparto long")
    upd = spark.createDataFrame([(1, 50, 2), (1, 60, 1), (1, None, 0), (None, 9, 1)], "ID_VACA long, IDparto long, at int")
    got = lambda **k: sorted((str(r.ID_VACA), r.IDparto) for r in key_update(cows, upd, "ID_VACA", "IDparto", **k).collect())
    assert got(order=["at"]) == [("1", 50), ("2", None), ("None", None)]
    assert got(order=["at"], unmatched_to_null=False) == [("1", 50), ("2", 6), ("None", 7)]
    assert got() == [("1", 60), ("2", None), ("None", None)]


def test_malformed_lines_are_not_lost(spark, tmp_path):
    import pytest
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    (tmp_path / "x.csv").write_text("a,b\n1,x\nno number,y\n")
    with pytest.raises(Exception):  # noqa: B017 - Spark's error class differs by reader
        files.read_csv(spark, str(tmp_path / "x.csv"), schema).collect()
    rows = files.read_csv(spark, str(tmp_path / "x.csv"), schema, corrupt="_bad").collect()
    assert [(r.a, r._bad) for r in rows] == [(1, None), (None, "no number,y")]
    (tmp_path / "y.json").write_text('{"a": 1}\n{"a": \n')
    with pytest.raises(Exception):  # noqa: B017
        files.read_json_list(spark, str(tmp_path / "y.json"), schema).collect()
    rows = files.read_json_list(spark, str(tmp_path / "y.json"), schema, corrupt="_bad").collect()
    assert [(r.a, r.b, r._bad) for r in rows] == [(1, None, None), (None, None, '{"a": ')]


def test_jdbc_reads_are_parallel_or_say_so():
    import pytest
    o = files.jdbc_options("jdbc:x", "t", "ID", 0, 100, 4, {"user": "u"})
    assert o == {"url": "jdbc:x", "dbtable": "t", "user": "u", "partitionColumn": "ID", "lowerBound": "0",
                 "upperBound": "100", "numPartitions": "4"}
    assert files.jdbc_options("jdbc:x", "t", one_task=True) == {"url": "jdbc:x", "dbtable": "t"}
    for bad in ({}, {"partition_column": "ID"}, {"partition_column": "ID", "lower": 5, "upper": 5}):
        with pytest.raises(ValueError):
            files.jdbc_options("jdbc:x", "t", **bad)


def test_json_array_dump(spark, tmp_path):
    p = tmp_path / "hatos.json"
    p.write_text('[{"ID_FINCA": 1, "ID_HATO": 2, "Nombre_Hato": "RECODO 2", "TIPO_Hato": "LECHE"},\n'
                 ' {"ID_FINCA": 1, "ID_HATO": 3, "Nombre_Hato": "JUNCAL"}]')
    h = files.herds(spark, str(p), schemas.HATOS, multi_line=True).orderBy("hato_id").collect()
    assert [(r.hato_id, r.nombre_hato, r.tipo_hato) for r in h] == [(2, "RECODO 2", "LECHE"), (3, "JUNCAL", None)]
