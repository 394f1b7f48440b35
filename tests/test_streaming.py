from glimmer.operators import decode
from glimmer.plans import fixtures as fx
from glimmer.streaming import decode as streaming


def test_stream_equals_batch(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    spots = fx.spots_li(spark, d).selectExpr("fov", "ok * 100000 + pk * 10 + ln AS spot_id", "v")
    spots.repartition(3).write.parquet(f"{tmp_path}/in")
    book = fx.codebook_part(spark, d)
    out = streaming.decoded_stream(streaming.read_spots(spark, f"{tmp_path}/in", files_per_batch=1), book)
    streaming.write_decoded(out, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination(120)
    want = decode.mapped(decode.quality_filtered(decode.called(spots)), book).select("spot_id", "gene", "barcode")
    got = spark.read.parquet(f"{tmp_path}/out").select("spot_id", "gene", "barcode")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
