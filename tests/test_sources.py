"""Readers and writers over files made for the test."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
import pytest
from conftest import plan_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from areascore.plans.ingest import source_format
from areascore.settings import SOURCES
from areascore.sources import containers, fixtures, packing, storage, tabular


def test_delimited_scan_infers_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text('IRIS;LIB;V\n010010000;" a;""b""";1,5\n2A0040101;;\n', encoding="utf-8")
    df = tabular.scan_delimited(spark, str(tmp_path))
    assert {t for _, t in df.dtypes} == {"string"}
    assert sorted(map(tuple, df.collect())) == [("010010000", ' a;"b"', "1,5"), ("2A0040101", None, None)]


def test_delimited_scan_reads_only_the_asked_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;b;c\n1;2;3\n")
    plan = plan_of(tabular.scan_delimited(spark, str(tmp_path)).select("b"), "formatted")
    # The check of the number of cells needs the odd row and one named column besides.
    assert "ReadSchema: struct<a:string,b:string,_odd_row:string>" in plan


def test_delimited_scan_refuses_another_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;b\n1;2\n")
    with pytest.raises(Exception, match="header"):
        tabular.scan_delimited(spark, str(tmp_path), columns=["b", "a"]).collect()


@pytest.mark.parametrize("multiline", [False, True])
def test_written_blanks_and_quotes_come_back(spark, text_frame, tmp_path, multiline):
    rows = [(" x ", 'say "hi"'), ("a;b", "  "), ("z", None)]
    tabular.write_delimited(text_frame(["p", "q"], rows), str(tmp_path / "t"))
    back = tabular.scan_delimited(spark, str(tmp_path / "t"), columns=["p", "q"], multiline=multiline)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_encoding_falls_back_per_file(spark, tmp_path):
    header = "code;libellé\n"
    (tmp_path / "u.csv").write_bytes((header + "1;été €\n").encode("utf-8"))
    (tmp_path / "w.csv").write_bytes((header + "2;été € œ\n3;plain\n").encode("cp1252"))
    (tmp_path / "l.csv").write_bytes(header.encode("latin-1") + b"4;\xe9\x81x\n")
    found = tabular.file_encodings(spark, str(tmp_path)).collect()
    assert {r["path"][-5:]: r["encoding"] for r in found} == {
        "u.csv": "utf-8", "w.csv": "cp1252", "l.csv": "latin-1",
    }
    df = tabular.scan_encoding_fallback(spark, str(tmp_path))
    assert df.columns == ["code", "libellé"]
    assert {r[0]: r[1] for r in df.collect()} == {"1": "été €", "2": "été € œ", "3": "plain", "4": "é\x81x"}


def test_a_file_with_another_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("code;libellé\n1;été\n".encode())
    (tmp_path / "b.csv").write_bytes("code;libellé\n2;été\n".encode("cp1252"))
    assert tabular.scan_encoding_fallback(spark, str(tmp_path)).count() == 2
    (tmp_path / "c.csv").write_bytes("libellé;code\nété;3\n".encode("cp1252"))
    with pytest.raises(PySparkException, match="another header"):
        tabular.scan_encoding_fallback(spark, str(tmp_path)).collect()
    (tmp_path / "c.csv").write_bytes("code;libellé\n3;a;b\n".encode("cp1252"))
    with pytest.raises(PySparkException, match="beyond the 2"):
        tabular.scan_encoding_fallback(spark, str(tmp_path)).collect()


def test_rows_below_headers_of_cut_files(spark, tmp_path):
    body = "".join(f"{k};é {k};\n" if k % 3 else f'{k};"a;""b""";x\n' for k in range(3000))
    (tmp_path / "a.txt").write_text("Zone\n\nsource;2021\nDISTRICT;Nom de la Cité;taux\n" + body)
    (tmp_path / "b.txt").write_text("taux;more;district\n7;;900001\n")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "7000")
    try:
        found = tabular.rows_below_header(spark, str(tmp_path), ("district", "taux"), ["district", "nom_de_la_cite", "taux"])
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 3
        rows = {r["district"]: (r["nom_de_la_cite"], r["taux"]) for r in found.collect()}
    finally:
        spark.conf.set(key, before)
    assert len(rows) == 3001 and rows["1"] == ("é 1", None) and rows["3"] == ('a;"b"', "x") and rows["900001"] == (None, "7")
    (tmp_path / "c.txt").write_text("no;header\n1;2\n")
    with pytest.raises(PySparkException, match="no header with"):
        tabular.rows_below_header(spark, str(tmp_path), ("district",), ["district"]).collect()


def write_zip(path, entries):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in entries.items():
            archive.writestr(name, text)


def test_zip_members(spark, tmp_path):
    write_zip(tmp_path / "a.zip", {"notes.md": "x", "sample.csv": "IRIS;P22_POP\n010010000;859\n010020000;120\n"})
    write_zip(tmp_path / "b.zip", {"meta.csv": "no;thing\n", "data.csv": 'P22_POP;IRIS\n" 7";"03\n1"\n'})
    one = containers.scan_zip_members(containers.read_containers(spark, str(tmp_path / "a.zip")), ["iris", "p22_pop"])
    assert sorted((r["iris"], r["p22_pop"]) for r in one.collect()) == [("010010000", "859"), ("010020000", "120")]
    both = containers.scan_zip_members(
        containers.read_containers(spark, str(tmp_path)), ["iris", "p22_pop"], pattern="sample|DATA"
    )
    assert sorted((r["iris"], r["p22_pop"]) for r in both.collect())[-1] == ("03\n1", " 7")
    with pytest.raises(PySparkException, match="missing columns"):
        containers.scan_zip_members(containers.read_containers(spark, str(tmp_path)), ["iris"]).collect()


def test_text_members_are_never_comma_separated(spark, tmp_path):
    write_zip(tmp_path / "a.zip", {"t.txt": "a;b\n1,5;2\n"})
    files = containers.read_containers(spark, str(tmp_path))
    assert containers.scan_zip_members(files, ["a", "b"], sep=",").first()["a"] == "1,5"


def test_layer_attributes_leave_geometry_behind(spark, tmp_path):
    rows = pd.DataFrame({"district": ["010010000"], "nombre": ["10.5"], "taux": ["12.3"], "city": ["01001"]})
    (tmp_path / "a.gpkg").write_bytes(packing.layer_bytes(rows, "districts_with_result_final"))
    files = containers.read_containers(spark, str(tmp_path))
    for layer in ("districts_with_result_final", None):
        df = containers.scan_layer_attributes(files, list(rows.columns), layer)
        assert tuple(df.drop("source_file").first()) == ("010010000", "10.5", "12.3", "01001")
    for absent in (["geom"], ["fid"]):
        with pytest.raises(PySparkException, match="missing columns"):
            containers.scan_layer_attributes(files, absent).collect()
    with pytest.raises(PySparkException, match="no layer"):
        containers.scan_layer_attributes(files, ["district"], "other").collect()


def test_formats(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(packing.layer_bytes(pd.DataFrame({"x": ["1"]}), "l"))
    (tmp_path / "b.csv").write_bytes(bytes.fromhex(containers.OLE_MAGIC) + b"...")
    write_zip(tmp_path / "c.csv", {"xl/a.xml": "", "[Content_Types].xml": ""})
    write_zip(tmp_path / "d.zip", {"z.SHP": "", "z.csv": ""})
    write_zip(tmp_path / "e.zip", {"z.TXT": ""})
    write_zip(tmp_path / "f.zip", {"z.bin": ""})
    for name in ("g.csv", "h.XLSX", "i.xls", "j.geojson", "k.dat", "l.gpkg"):
        (tmp_path / name).write_bytes(b"a;b\n")
    files = containers.read_containers(spark, str(tmp_path))
    found = {r["path"][-5:-4] if r["path"][-4] == "." else r["path"].rsplit("/", 1)[1][0]: r["detected_format"]
             for r in containers.detect_format(files, hint="CSV").collect()}
    assert found == {
        "a": "gpkg", "b": "xls", "c": "xlsx", "d": "zip_shp", "e": "zip_csv", "f": "csv", "g": "csv",
        "h": "xlsx", "i": "xls", "j": "geojson", "k": "csv", "l": "gpkg",
    }


def test_header_below_a_preamble(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Zonage\n\nsource;2021\nCODGEO;Libellé géo\n01001;x\n")
    (tmp_path / "b.csv").write_text('"CodGéo";"y"\n01002;z\nCODGEO;again\n')
    (tmp_path / "c.csv").write_text("\n" * 12 + "CODGEO;x\n")
    found = {r["path"][-5:]: r for r in tabular.discover_header(spark, str(tmp_path), ["CODGEO"]).collect()}
    assert {k: r["header_row"] for k, r in found.items()} == {"a.csv": 3, "b.csv": 0}
    assert found["a.csv"]["columns"] == ["codgeo", "libelle_geo"]
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv")]
    rows = containers.scan_below_header(containers.read_containers(spark, paths), ["CODGEO"], ["codgeo"])
    assert sorted(r["codgeo"] for r in rows.collect()) == ["01001", "01002", "CODGEO"]
    with pytest.raises(PySparkException, match="no header"):
        only = containers.read_containers(spark, str(tmp_path / "c.csv"))
        containers.scan_below_header(only, ["CODGEO"], ["codgeo"]).collect()


def test_bronze_headers_are_folded(text_frame):
    df = text_frame(["Code commune", "Libellé commune", "Value"], [("01001", "Test", "42")])
    assert tabular.normalize_headers(df).columns == ["code_commune", "libelle_commune", "value"]


def test_catchment_columns(text_frame):
    df = text_frame([" IRIS", "Code Bassin de Vie", "Lib IRIS"], [("1", "2", "3")])
    assert tabular.map_columns(df).columns == ["code_iris", "code_bv", "lib_iris"]
    with pytest.raises(ValueError, match="code_bv"):
        tabular.map_columns(text_frame(["IRIS", "x"], [("1", "2")]))


def test_bronze_replace_is_idempotent_and_append_adds(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3).withColumn("x", F.lit("007"))
    tabular.load_bronze(df, path)
    assert tabular.load_bronze(df, path).count() == 3
    assert tabular.load_bronze(df, path, "append").count() == 6
    assert {t for _, t in tabular.read_bronze(spark, path).dtypes} == {"string"}


def test_landed_runs_are_pruned(spark, text_frame, tmp_path):
    root = str(tmp_path / "landing")
    for source, run in (("S01", "1"), ("S01", "2"), ("S02", "1")):
        tabular.land(text_frame(["iris"], [(source + run,)]), root, source, "2021", run)
    got = tabular.landed(spark, root, ["iris"], "S01", "2")
    assert [r["iris"] for r in got.collect()] == ["S012"]
    assert "PartitionFilters: [isnotnull(source_id" in plan_of(got, "formatted")


def test_export_is_in_key_order(spark, tmp_path):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("k"), F.lit(" é ").alias("t"))
    tabular.export_sorted(df, str(tmp_path / "e"), "k")
    keys = []
    for part in sorted((tmp_path / "e").glob("part-*.csv")):
        lines = part.read_text(encoding="utf-8").splitlines()
        assert lines[0] == "k,t"
        keys += [int(line.split(",")[0]) for line in lines[1:]]
    assert keys == list(range(500))


def test_fingerprint_ignores_order_but_not_content(spark):
    df = spark.range(100).withColumn("x", F.when(F.col("id") % 3 == 0, F.lit("a")))
    mark = lambda d: d.agg(containers.table_fingerprint(d)).first()[0]
    assert mark(df) == mark(df.orderBy(F.col("id").desc()).repartition(7))
    assert mark(df) != mark(df.union(df.limit(1))) and mark(df) != mark(df.withColumn("x", F.lit("a")))


def test_checksum(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"abc")
    row = containers.content_checksum(containers.read_containers(spark, str(tmp_path))).first()
    assert (row["checksum_md5"], row["file_size_bytes"]) == ("900150983cd24fb0d6963f7d28e17f72", 3)


def test_packed_rows_come_back_from_many_containers(spark):
    df = spark.range(0, 25_000, 1, 3).select(F.col("id").cast("string").alias("a"), F.lit("é").alias("b"))
    packed = packing.pack_zip(df)
    assert packed.count() >= 3
    assert containers.scan_zip_members(packed, ["a", "b"]).drop("source_file").exceptAll(df).count() == 0


def test_staged_tables_live_in_the_shared_folder(spark):
    staged = storage.stage(spark.range(10), "ten")
    assert staged.count() == 10
    assert storage.shared_folder(spark) in staged.inputFiles()[0]


def test_a_repeated_run_replaces_itself(spark, tmp_path):
    root = str(tmp_path / "landing")
    rows = spark.createDataFrame([("1",), ("2",)], "a string")
    for run, frame in (("r1", rows), ("r2", rows), ("r2", rows.limit(1))):
        tabular.land(frame, root, "S1", "2021", run)
    assert tabular.landed(spark, root, ["a"], "S1", "r1").count() == 2
    assert tabular.landed(spark, root, ["a"], "S1", "r2").count() == 1


def test_rows_that_do_not_fit_the_header_are_never_cut(spark, tmp_path):
    path = tmp_path / "ragged.csv"
    path.write_text('a;b\n1;2\n3\n"x;y";4\n')
    assert [tuple(r) for r in tabular.scan_delimited(spark, str(path)).collect()] == [("1", "2"), ("3", None), ("x;y", "4")]
    assert [r.b for r in tabular.scan_delimited(spark, str(path)).select("b").collect()] == ["2", None, "4"]
    for text in ("a;b\n1;2\n1;2;3\n", 'a;b\n1;"x\ny"\n'):
        other = tmp_path / f"bad{len(text)}.csv"
        other.write_text(text)
        for use in (lambda df: df.count(), lambda df: df.select("a").collect()):
            with pytest.raises(PySparkException, match="beyond"):
                use(tabular.scan_delimited(spark, str(other)))
    whole = tabular.scan_delimited(spark, str(other), multiline=True)
    assert [tuple(r) for r in whole.collect()] == [("1", "x\ny")]


def test_every_file_of_a_source_is_judged(spark, tmp_path):
    spec = SOURCES["S01"]
    (tmp_path / "a.csv").write_text("a;b\n")
    assert source_format(spark, spec, str(tmp_path)) == "csv"
    with zipfile.ZipFile(tmp_path / "b.csv", "w") as archive:
        archive.writestr("x.csv", "a;b\n" * 500)
    with pytest.raises(ValueError, match="different formats"):
        source_format(spark, spec, str(tmp_path))


def test_no_customer_is_lost_when_areas_share_a_code(spark):
    many = spark.range(3_000_000).selectExpr("id AS c_custkey", "id % 25 AS c_nationkey")
    views = fixtures.VIEWS
    area = spark.sql(f"WITH owner AS ({views['owner']}), terr AS ({views['terr']}) SELECT sum(customers), sum(k) FROM terr", customer=many)
    assert tuple(area.first()) == (3_000_000, 3_000_000 * 2_999_999 // 2)
