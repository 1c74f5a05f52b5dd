import os

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.vectors import HashEmbedder
from corpusloom.operators.keys import append_new, assign_ids, digits_for
from corpusloom.plans.corpus import CorpusJob
from corpusloom.session import arrow_batch, publish_views, require_rows, stage, table_exists, work_dir
from corpusloom.sources import web
from corpusloom.sources.files import binary_files, land_texts, table_stream
from corpusloom.streaming.drain import drain


def write(folder, name, content):
    with open(os.path.join(folder, name), "wb") as f:
        f.write(content)


def test_ingest_takes_matching_files_once(spark, folder):
    landing = os.path.join(folder, "landing")
    os.mkdir(landing)
    write(landing, "a.pdf", b"A")
    write(landing, "b.pdf", b"BB")
    write(landing, "c.txt", b"C")

    def run():
        drain(binary_files(spark, landing), f"{folder}/progress", path=f"{folder}/raw")
        return spark.read.parquet(f"{folder}/raw").count()

    assert run() == 2
    assert run() == 2
    write(landing, "d.pdf", b"D")
    assert run() == 3


@pytest.mark.parametrize("texts", [["a", None, "", "a", "é\nb"], []])
def test_landed_files_equal_those_of_the_text_writer(spark, folder, texts):
    """Without the side files and processes that Spark's writer needs for each on a local disk."""
    rows = spark.createDataFrame([(t,) for t in texts], "html string").coalesce(1)
    rows.write.option("maxRecordsPerFile", 1).text(f"{folder}/plain")
    land_texts(rows, f"file://{folder}/own")
    contents = []
    for name in ("plain", "own"):
        drain(binary_files(spark, f"{folder}/{name}", "*.txt"), f"{folder}/progress-{name}", path=f"{folder}/raw-{name}")
        contents.append(sorted(bytes(r.content) for r in spark.read.parquet(f"{folder}/raw-{name}").collect()))
    assert contents[0] == contents[1] and len(contents[1]) == len(texts)
    # One empty file is read as no row.
    assert len(os.listdir(f"{folder}/own")) == max(1, len(texts))


def test_drain_into_a_table(spark, folder):
    source = f"{folder}/source"
    spark.range(5).write.parquet(source)
    name = "t_" + os.path.basename(folder).replace("-", "_").lower()
    with pytest.raises(ValueError):
        drain(table_stream(spark, source, "id long"), f"{folder}/p0")
    spark.sql(f"create table {name} (id long) using parquet location '{folder}/table'")
    for _ in range(2):
        drain(table_stream(spark, source, "id long"), f"{folder}/p", table=name)
    assert spark.table(name).count() == 5 and table_exists(spark, name)


def test_corpus_job_is_incremental_and_equals_batch(spark, folder):
    landing = os.path.join(folder, "landing")
    os.mkdir(landing)
    for i in range(6):
        write(landing, f"f{i}.pdf", f"Page one of {i}. More  text.\fPage two - yes.".encode())
    write(landing, "bad.pdf", b"\xff\xfe\xff")

    def parser():
        return lambda content: content.decode("utf-8").split("\f")

    job = CorpusJob(
        spark, landing, f"{folder}/home", parser, HashEmbedder(16), 16, max_tokens=6, overlap=2
    )
    first = {(r.url, r.chunk_idx): r for r in job.run().collect()}
    assert sorted(r.id for r in first.values()) == list(range(1, len(first) + 1))
    assert job.failed().count() == 1
    assert {r.n_tokens <= 6 for r in first.values()} == {True}
    write(landing, "new.pdf", b"Something else.")
    second = {(r.url, r.chunk_idx): r for r in job.run().collect()}
    assert len(second) == len(first) + 1
    assert all(second[k] == r for k, r in first.items())
    added = next(r for k, r in second.items() if k not in first)
    assert added.id == len(second) and added.content == "Something else."
    # Nothing new: nothing changes.
    assert job.run().count() == len(second)


@pytest.mark.parametrize("digits", [1, 3])
def test_ids_are_contiguous_and_repeatable(spark, digits):
    rows = spark.range(1000).select(
        F.concat(F.lit("u"), F.floor(F.col("id") / 400)).alias("url"), F.col("id").alias("chunk_idx")
    )
    a = assign_ids(rows, ["url", "chunk_idx"], hex_digits=digits)
    b = assign_ids(rows.repartition(7), ["url", "chunk_idx"], hex_digits=digits)
    assert sorted(r.id for r in a.collect()) == list(range(1, 1001))
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}
    c = assign_ids(rows, ["url", "chunk_idx"], existing=a, hex_digits=digits)
    assert c.agg(F.min("id")).first()[0] == 1001


def test_ids_do_not_depend_on_the_number_of_buckets(spark):
    rows = spark.range(300).selectExpr("concat('u', id % 40) as url", "id div 40 as chunk_idx")
    ids = [
        sorted(map(tuple, assign_ids(rows, ["url", "chunk_idx"], hex_digits=d).collect())) for d in (1, 3, 4, 5)
    ]
    assert ids[0] == ids[1] == ids[2] == ids[3]


def test_bucket_digits_follow_the_size():
    assert [digits_for(n) for n in (0, 10**9, 10**10, 10**12)] == [3, 3, 4, 5]


def test_append_new_can_be_repeated(spark, folder):
    name = "c_" + os.path.basename(folder).replace("-", "_").lower()
    spark.sql(f"create table {name} (url string, chunk_idx long) using parquet location '{folder}/t'")
    rows = spark.range(6).select(F.lit("u").alias("url"), F.col("id").alias("chunk_idx"))
    append_new(rows.limit(4), name, ["url", "chunk_idx"])
    append_new(rows, name, ["url", "chunk_idx"])
    append_new(rows, name, ["url", "chunk_idx"])
    assert spark.table(name).count() == 6


def test_append_new_takes_nulls_as_equal_and_drops_repeats(spark, folder):
    name = "n_" + os.path.basename(folder).replace("-", "_").lower()
    spark.sql(f"create table {name} (url string, chunk_idx long) using parquet location '{folder}/t'")
    rows = spark.createDataFrame([(None, 1), (None, 1), ("u", None)], "url string, chunk_idx long")
    for _ in range(2):
        append_new(rows, name, ["url", "chunk_idx"])
    assert spark.table(name).count() == 2


def test_sitemap_with_namespace_and_cap(spark):
    xml = (
        '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
        "<url><loc>http://a/1?x=1&amp;y=2</loc></url><url><loc>http://a/2</loc></url></urlset>"
    )
    maps = spark.createDataFrame([(1, xml), (2, xml.replace("http://a", "http://b"))], "n int, xml string")
    urls = [r.url for r in web.sitemap_urls(maps, "n").orderBy("n", "pos").collect()]
    assert urls == ["http://a/1?x=1&y=2", "http://a/2", "http://b/1?x=1&y=2", "http://b/2"]
    assert [r.url for r in web.sitemap_urls(maps, "n", max_documents=3).collect()] == urls[:3]


def test_listing_and_url_frame(spark):
    df = web.url_frame(spark, ["http://h/NOTICE.txt", "http://h/a.pdf", "http://h/NOTICE/b"], 3)
    assert df.rdd.getNumPartitions() == 3
    assert {r.file_name for r in web.listing(df).collect()} == {"a.pdf", "b"}


def test_preview_is_pushed_down_and_ordered(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    df = web.preview(pages, "%.html", "page_id", 3)
    rows = df.collect()
    assert len(rows) <= 3 and all(r.url.endswith(".html") for r in rows)
    assert "StringEndsWith(url,.html)" in df._jdf.queryExecution().toString()


def test_session_helpers(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    with arrow_batch(spark, 10):
        assert spark.conf.get(key) == "10"
    assert spark.conf.get(key) == before
    assert not table_exists(spark, "no_such_table")
    publish_views(three=spark.range(3))
    assert spark.sql("select sum(id) from three").first()[0] == 3
    with pytest.raises(ValueError):
        require_rows(spark.range(0))
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert work_dir(spark).startswith(shared) if shared else work_dir(spark)
    assert stage(spark.range(3), "t").count() == 3
