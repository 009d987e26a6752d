import random

from tilewright import streaming


def test_stream_equals_table(spark, tmp_path):
    rng = random.Random(0)
    rows = [(f"s{i}", "".join(rng.choice("ACGT") for _ in range(90 + i))) for i in range(6)]
    (tmp_path / "in").mkdir()
    for k in range(2):
        (tmp_path / "in" / f"{k}.tsv").write_text("".join(f"{i}\t{s}\n" for i, s in rows[3 * k : 3 * k + 3]))
    query = streaming.screen_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(120)
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert got == sorted(map(tuple, streaming.screen(spark.createDataFrame(rows, "id string, seq string")).collect())) and got
