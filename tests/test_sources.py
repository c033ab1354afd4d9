"""Sources and sinks round trips."""

import os
import tempfile

import pytest
from pyspark.errors import AnalysisException

from gapscan import sources as S


def _tmp():
    return tempfile.mkdtemp(prefix="gapscan-test-", dir="/tmp")


def test_surface_tsv_round_trip(spark):
    d = _tmp()
    path = os.path.join(d, "surf.tsv")
    cols = ["bio1", "bio2"]
    df = spark.createDataFrame([(10.0, 20.0, 1.5, None), (-0.1, 0.1, 2.0, 3.0)],
                               "decimallatitude double, decimallongitude double, bio1 double, bio2 double")
    S.write_tsv(df, path)
    back = S.read_surfaces(spark, path, S.surface_schema(cols)).orderBy("decimallatitude").collect()
    assert back[0].asDict() == {"decimallatitude": -0.1, "decimallongitude": 0.1, "bio1": 2.0, "bio2": 3.0}
    assert back[1].bio2 is None


def test_export_fails_if_exists_and_stage(spark):
    d = _tmp()
    path = os.path.join(d, "export.parquet")
    df = spark.range(5)
    S.write_export(df, path)
    with pytest.raises(AnalysisException):
        S.write_export(df, path)
    assert S.read_parquet(spark, path).count() == 5
    staged = S.stage(df.selectExpr("id * 2 AS v"), os.path.join(d, "staged.parquet"))
    assert sorted(r.v for r in staged.collect()) == [0, 2, 4, 6, 8]
    ck = S.stage(df.selectExpr("id + 1 AS v"))
    assert ck.count() == 5


def test_csv_and_catalog_and_dim(spark):
    d = _tmp()
    path = os.path.join(d, "ids.csv")
    with open(path, "w") as fh:
        fh.write("rec_id,name\n1,a\n2,b\n")
    df = S.read_records_csv(spark, path, "rec_id long, name string")
    assert [r.rec_id for r in df.collect()] == [1, 2]
    df.createOrReplaceTempView("occ_test")
    assert S.read_records(spark, "occ_test").count() == 2
    dim = S.surface_dim(spark).collect()
    assert len(dim) == 19 and dim[11].surface == "bio12" and dim[11].surface_no == 12
