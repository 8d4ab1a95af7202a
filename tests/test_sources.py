import pytest
from pyspark.sql import functions as F

from spark_triage import schemas, session
from spark_triage.functions import text as tx
from spark_triage.sources import tables
from spark_triage.streaming import incremental

CSV = '''tweet_id,author_id,inbound,created_at,text,response_tweet_id,in_response_to_tweet_id
1,115712,True,Tue Oct 31,"hello, ""you""
second line",2,
2,brand,False,Tue Oct 31,plain,,1.0
3,115713,True,Tue Oct 31,odd,,abc
4,115713,True,Tue Oct 31,big,,119237
'''


def test_csv_scan(spark, tmp_path):
    (tmp_path / "m.csv").write_text(CSV)
    df = tables.read_messages_csv(spark, str(tmp_path / "m.csv"))
    assert df.schema.simpleString() == schemas.MESSAGES.simpleString()
    rows = df.orderBy("tweet_id").collect()
    assert [r.in_response_to_tweet_id for r in rows] == [None, 1, None, 119237]
    assert [r.inbound for r in rows] == [True, False, True, True]
    assert rows[0].text == 'hello, "you"\nsecond line'


def test_publish_and_read_back(spark, tmp_path):
    row = (1, "raw", "t", None, 2, "raw", "t", False, "clean", "")
    df = spark.createDataFrame([row], schemas.CLEAN_PAIRS)
    tables.publish(df, str(tmp_path / "out"), drop=["customer_tweet", "brand_reply"])
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.columns == tables.publishable(df).columns and back.first().brand_reply_clean == ""
    assert tables.read_table(spark, str(tmp_path / "out"), schemas.CLEAN_PAIRS).first().customer_tweet is None


def test_remaining_with_null_ids(spark):
    todo = spark.createDataFrame([(1,), (2,), (3,)], "id bigint")
    done = spark.createDataFrame([(2,), (None,)], "id bigint")
    assert sorted(r.id for r in tables.remaining(todo, done, "id").collect()) == [1, 3]


def test_report_is_one_ordered_file(spark, tmp_path):
    lines = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "line_no int, line string").repartition(3)
    tables.write_report(lines, str(tmp_path / "r"))
    parts = list((tmp_path / "r").glob("part-*"))
    assert len(parts) == 1 and parts[0].read_text() == "a\nb\nc\n"


def test_incremental_stage_takes_only_new_files(spark, tmp_path):
    src, out, ck = (str(tmp_path / p) for p in ("src", "out", "ck"))
    schema = schemas.RESPONSES

    def stage(df):
        return df.select("id", tx.clean_text(F.col("raw")).alias("text"))

    for batch in ([(1, 1, "a &amp; b")], [(2, 1, "see https://x.y/z")]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(src)
        incremental.run_increment(incremental.read_increment(spark, src, schema), stage, out, ck)
    incremental.run_increment(incremental.read_increment(spark, src, schema), stage, out, ck)
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(1, "a & b"), (2, "see <URL>")]


def test_shared_folder_is_the_sessions(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = session.staged(spark.range(5), "five")
    assert df.count() == 5 and session.shared_folder(spark) in df.inputFiles()[0]


def test_shared_folder_must_be_named_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Fake:
        conf = Conf()

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Fake())
