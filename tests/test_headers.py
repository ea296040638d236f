"""Files of one folder with different headers, in batch and in streams."""

import gzip
import os

import pytest

from stockyard.plans import bronze, silver
from stockyard.session import scratch_path
from stockyard.sources.files import CORRUPT_RECORD, bound_by_header, csv_files, csv_scan_permissive, file_headers
from stockyard.streaming.ingest import (
    read_refreshed,
    refresh_bronze,
    refresh_silver,
    refresh_silver_from_bronze,
)
from pyspark.sql.types import StructType

FILES = {
    "a.csv": "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,13023,Campinas,SP\ns9,99,x,SP\n",
    "b b.csv": "seller_state,seller_city,seller_id,seller_zip_code_prefix\nRJ,Rio,s2,20031\n",
    "c.csv": "Seller_City,note, seller_zip_code_prefix ,seller_state,seller_id\n\"Ilha, Bela\",new,01037,sp,s3\n",
    "d.csv": "seller_id,seller_state\ns4,SP\ns5,SP,stray\n",
    "e.csv": "",
    "f.csv": "seller_id,seller_zip_code_prefix,seller_city,seller_state\n",
}
WANT = {"s1": ("13023", "campinas", "SP", "valid"), "s9": ("99", "x", "SP", "invalid_zipcode"),
        "s2": ("20031", "rio", "RJ", "valid"), "s3": ("01037", "ilha, bela", "SP", "invalid_state"),
        "s4": (None, None, "SP", "valid"), "s5": (None, None, "SP", "malformed_record")}


def folder(spark, files, name="mixed"):
    d = scratch_path(spark, name)
    os.makedirs(d)
    add(d, files)
    return d


def add(d, files):
    for name, text in files.items():
        with open(os.path.join(d, name), "w") as f:
            f.write(text)


def found(df):
    return {r["seller_id"]: (r["seller_zip_code_prefix"], r["seller_city"], r["seller_state"],
                             r["data_quality_flag"]) for r in df.collect()}


def test_batch_binds_each_file(spark):
    d = folder(spark, FILES)
    b = bronze.bronze_dataset(spark, d, "sellers", path=d)
    assert found(silver.sellers(b)) == WANT
    kept = {r["seller_id"]: (r[CORRUPT_RECORD], os.path.basename(r["_source_file"])) for r in b.collect()}
    assert kept["s5"] == ("s5,SP,stray", "d.csv") and kept["s3"][0] is None
    assert b.columns[-3:] == ["_source_file", "_ingestion_time", "_processed_at"]


def test_stream_equals_batch(spark):
    d = folder(spark, {k: FILES[k] for k in ("a.csv", "c.csv", "e.csv")})
    out, ck = scratch_path(spark, "mixed-out"), scratch_path(spark, "mixed-ck")
    refresh_silver(spark, d, "sellers", out, ck).awaitTermination()
    assert set(found(read_refreshed(spark, out))) == {"s1", "s9", "s3"}
    add(d, {k: FILES[k] for k in ("b b.csv", "d.csv", "f.csv")})
    q = refresh_silver(spark, d, "sellers", out, ck, max_files_per_trigger=1)
    q.awaitTermination()
    got = read_refreshed(spark, out)
    assert found(got) == WANT and got.count() == len(WANT)
    batch = silver.sellers(bronze.bronze_dataset(spark, d, "sellers", path=d))
    assert sorted(got.columns) == sorted(batch.columns)
    refresh_silver(spark, d, "sellers", out, ck).awaitTermination()  # nothing new
    assert read_refreshed(spark, out).count() == len(WANT)


def test_chain_keeps_broken_rows(spark):
    d = folder(spark, FILES)
    bz, sv = scratch_path(spark, "mixed-bz"), scratch_path(spark, "mixed-sv")
    ckb, cks = scratch_path(spark, "mixed-ckb"), scratch_path(spark, "mixed-cks")
    refresh_bronze(spark, d, "sellers", bz, ckb).awaitTermination()
    refresh_silver_from_bronze(spark, bz, "sellers", sv, cks).awaitTermination()
    assert found(read_refreshed(spark, sv)) == WANT


def test_batch_run_again_replaces_its_rows(spark):
    """A batch whose commit was lost runs again over the same files."""
    d = folder(spark, {"a.csv": FILES["a.csv"]})
    out, ck = scratch_path(spark, "again-out"), scratch_path(spark, "again-ck")
    bz, ckb = scratch_path(spark, "again-bz"), scratch_path(spark, "again-ckb")
    sv, cks = scratch_path(spark, "again-sv"), scratch_path(spark, "again-cks")
    refresh_silver(spark, d, "sellers", out, ck).awaitTermination()
    refresh_bronze(spark, d, "sellers", bz, ckb).awaitTermination()
    refresh_silver_from_bronze(spark, bz, "sellers", sv, cks).awaitTermination()
    for c in (ck, ckb):
        for f in ("0", ".0.crc"):
            os.remove(os.path.join(c, "commits", f))
    refresh_silver(spark, d, "sellers", out, ck).awaitTermination()
    refresh_bronze(spark, d, "sellers", bz, ckb).awaitTermination()
    refresh_silver_from_bronze(spark, bz, "sellers", sv, cks).awaitTermination()
    for path in (out, bz, sv):
        assert sorted(r.seller_id for r in read_refreshed(spark, path).collect()) == ["s1", "s9"]


def test_headers_of_odd_files(spark, tmp_path):
    (tmp_path / "bom.csv").write_text("﻿id,x\n1,2\n")
    (tmp_path / "lines.csv").write_text('"id","a\nb"\n1,2\n')
    with gzip.open(tmp_path / "z.csv.gz", "wt") as f:
        f.write("id,zipped\n1,2\n")
    got = file_headers(spark, csv_files(spark, str(tmp_path)))
    assert set(got) == {("id", "x"), ("id", "a\nb"), ("id", "zipped")}
    rows = csv_scan_permissive(spark, str(tmp_path / "z.csv.gz"), "zipped int, id int").collect()
    assert [(r.id, r.zipped) for r in rows] == [(1, 2)]
    latin = tmp_path / "latin.csv"
    latin.write_bytes("chão,id\né,1\n".encode("latin-1"))
    rows = csv_scan_permissive(spark, str(latin), "id int, `chão` string", encoding="ISO-8859-1").collect()
    assert [(r.id, r["chão"]) for r in rows] == [(1, "é")]


def test_repeated_and_unknown_header_names():
    schema = StructType.fromDDL("id int, x string")
    assert bound_by_header(["X", "id", "x", "y"], schema).names == ["x", "id", "__other_2", "__other_3"]


def test_folder_without_rows(spark):
    d = folder(spark, {"e.csv": ""}, "hollow")
    b = bronze.bronze_dataset(spark, d, "sellers", path=d)
    assert b.count() == 0 and silver.sellers(b).count() == 0


def test_missing_folder_fails(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        csv_scan_permissive(spark, "/no/such/folder", "id int")
