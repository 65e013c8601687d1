import numpy as np
from pyspark.sql import functions as F

from larkspur.functions import vectors as V


def test_quantize_ties_go_to_even(spark):
    values = [0.5 / 127, 1.5 / 127, -0.5 / 127, 2.0, -2.0, 1.0]
    row = spark.createDataFrame([(values,)], "v array<float>").select(V.quantize(F.col("v")).alias("q")).first()
    want = np.clip(np.rint(np.float32(values) * np.float32(127)), -128, 127).astype(int)
    assert [int(x) for x in row["q"]] == want.tolist()


def test_blobs_round_trip(spark):
    df = spark.createDataFrame([([1.0, -2.5, 3.25],), (None,)], "v array<float>")
    back = df.select(V.decode_blob(V.encode_blob("v")).alias("v")).collect()
    assert list(back[0]["v"]) == [1.0, -2.5, 3.25] and back[1]["v"] is None


def test_errors_and_norms(spark):
    df = spark.createDataFrame([([0.6, 0.8],), ([0.0, 0.0],)], "v array<float>")
    rows = df.select(V.norm(F.col("v")).alias("n"), V.quantization_error(F.col("v"), V.quantize(F.col("v"))).alias("e"), V.l2_normalize(F.col("v")).alias("u")).collect()
    assert abs(rows[0]["n"] - 1) < 1e-6 and 0 <= rows[0]["e"]["cosine_error"] < 1e-3
    assert rows[1]["e"] is None and list(rows[1]["u"]) == [0.0, 0.0]


def test_hash_and_hamming(spark):
    pixels = [float(i) for i in range(64)]
    df = spark.createDataFrame([(pixels,)], "p array<double>").select(V.average_hash(F.col("p")).alias("h"))
    assert df.select(V.hamming(F.col("h"), F.lit(0)).alias("d")).first()["d"] == 32
    assert df.first()["h"] == (1 << 32) - 1


def test_diagnostics(spark):
    row = spark.createDataFrame([([float("nan"), 1.0],), ([float("inf"), 1.0],)], "v array<float>").select(V.diagnostics(F.col("v")).alias("d")).collect()
    assert row[0]["d"]["has_nan"] and not row[0]["d"]["has_inf"] and row[1]["d"]["has_inf"]
