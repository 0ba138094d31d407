"""Rows that arrive later get the next codes, once, also when a batch is run again."""

from ledgerloom.streaming.appends import append_batch, append_stream, start_table

DDL = "place_code string, name string"


def codes(spark, path):
    return sorted((r["place_code"], r["name"]) for r in spark.read.parquet(path).collect())


def test_arriving_rows_get_codes(spark, rows, tmp_path):
    path, inbox = str(tmp_path / "place"), str(tmp_path / "inbox")
    start_table(rows(DDL, [("pl001", "Paris"), ("pl007", "Lyon")]), path, "place_code")
    rows(DDL, [("given", "Nancy"), (None, "Brest")]).coalesce(1).write.parquet(inbox)
    stream = spark.readStream.schema(DDL).parquet(inbox)

    def run():
        query = append_stream(stream, path, "place_code", ["name"], str(tmp_path / "state"), availableNow=True)
        assert query.awaitTermination(120)

    run()
    first = [("pl001", "Paris"), ("pl007", "Lyon"), ("pl008", "Brest"), ("pl009", "Nancy")]
    assert codes(spark, path) == first
    rows(DDL, [(None, "Metz")]).coalesce(1).write.mode("append").parquet(inbox)
    run()
    assert codes(spark, path) == sorted([*first, ("pl010", "Metz")])
    append_batch(path, "place_code", ["name"], rows(DDL, [(None, "Metz")]), 1)
    assert codes(spark, path) == sorted([*first, ("pl010", "Metz")])
