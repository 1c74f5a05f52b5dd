"""The change feed from files to the index, catalog streams and bounded batches."""

import hashlib
import os
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusloom.functions.vectors import HashEmbedder
from corpusloom.plans.corpus import CorpusJob
from corpusloom.plans.feed import FEED, CorpusFeed
from corpusloom.sources.files import catalog_stream, table_stream
from corpusloom.streaming.drain import drain, drain_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])
DIM = 16
EMBEDDER = HashEmbedder(DIM)


def parser():
    def parse(content):
        text = content.decode("utf-8")
        if "broken" in text:
            raise ValueError("broken")
        return text.split("\f")

    return parse


class Landing:
    def __init__(self, folder):
        self.folder, self.clock = folder, 1_700_000_000
        os.makedirs(f"{folder}/deep", exist_ok=True)

    def put(self, name, text):
        self.clock += 10
        with open(f"{self.folder}/{name}", "w") as out:
            out.write(text)
        os.utime(f"{self.folder}/{name}", (self.clock, self.clock))

    def texts(self):
        out = {}
        for root, _, names in os.walk(self.folder):
            for n in names:
                if n.endswith(".pdf"):
                    with open(f"{root}/{n}") as f:
                        out[f"file:{root}/{n}"] = f.read()
        return out


def held(index):
    return sorted((r.url, r.content) for r in index.table().collect())


def want(landing):
    return sorted((u, t) for u, t in landing.texts().items() if t.strip() and "broken" not in t)


def job(spark, folder, **more):
    return CorpusFeed(spark, f"{folder}/land", f"{folder}/home", parser, EMBEDDER, DIM, rows_per_cell=5, **more)


def test_files_that_come_change_and_go(spark, folder):
    landing = Landing(f"{folder}/land")
    feed = job(spark, folder)
    assert feed.run() is None
    for i in range(12):
        landing.put(f"f{i}.pdf", f"file {i} says hello")
    landing.put("deep/inner.pdf", "an inner file")
    landing.put("bad.pdf", "broken file")
    landing.put("note.txt", "of another kind")
    assert held(feed.run()) == want(landing)
    assert [r.path.rpartition("/")[2] for r in feed.failed().collect()] == ["bad.pdf"]
    first = {r.url: r.id for r in feed.index().table().collect()}
    assert sorted(first.values()) == list(range(1, 14))

    landing.put("f3.pdf", "file three is another")
    landing.put("bad.pdf", "mended file")
    landing.put("f4.pdf", "broken now")
    landing.put("new.pdf", "a new file")
    os.remove(f"{folder}/land/f5.pdf")
    assert held(feed.run()) == want(landing)
    # Files that did not change keep their ids and were not read again.
    now = {r.url: r.id for r in feed.index().table().collect()}
    untouched = [u for u in first if u in now and not u.endswith("f3.pdf")]
    assert len(untouched) == 10 and all(first[u] == now[u] for u in untouched)
    versions = feed._read(spark, "feed", FEED).groupBy("version").count().collect()
    assert {r.version: r["count"] for r in versions} == {1: 14, 2: 5}

    generation = feed.index().generation
    assert feed.scan() == 0 and feed.drain() == 0 and feed.index().generation == generation
    # A file that went comes back.
    landing.put("f5.pdf", "file 5 says hello")
    assert held(feed.run()) == want(landing)


def test_a_backlog_in_batches_equals_one_batch(spark, folder):
    landing = Landing(f"{folder}/land")
    for i in range(30):
        landing.put(f"f{i}.pdf", f"words of file {i}")
    feed = job(spark, folder, batch_files=8)
    feed.scan()
    assert feed.drain() >= 3
    assert held(feed.index()) == want(landing)
    # The index was trained on the first batch and anew once it had grown.
    assert feed.index().settings["trained_on"] >= 8


def test_a_replayed_batch_changes_nothing(spark, folder):
    landing = Landing(f"{folder}/land")
    landing.put("a.pdf", "first file")
    feed = job(spark, folder)
    feed.run()
    landing.put("a.pdf", "first file again")
    landing.put("b.pdf", "second file")
    feed.scan()
    batch = feed._read(spark, "feed", FEED).where("version = 2")
    # Cut off after the batch was applied, before the stream noted it.
    feed.apply(batch, 1)
    before, generation = held(feed.index()), feed.index().generation
    feed.apply(batch, 1)
    assert held(feed.index()) == before == want(landing) and feed.index().generation == generation
    feed.drain()
    assert held(feed.index()) == want(landing)


def five_files(spark, folder):
    for i in range(5):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.02)


def test_bounded_batches_equal_one(spark, folder):
    five_files(spark, f"{folder}/in")
    counts = []
    stream = table_stream(spark, f"{folder}/in", "id long", files_per_batch=2)
    assert drain_batches(stream, f"{folder}/p1", lambda rows, _: counts.append(rows.count())) == 3
    assert counts == [20, 20, 10]
    small = table_stream(spark, f"{folder}/in", "id long", bytes_per_batch=600)
    seen = []
    assert drain_batches(small, f"{folder}/p2", lambda rows, _: seen.extend(r.id for r in rows.collect())) >= 2
    assert sorted(seen) == list(range(50))


def test_catalog_tables_as_streams(spark, folder):
    name = "t" + hashlib.md5(folder.encode()).hexdigest()
    five_files(spark, f"{folder}/in")
    spark.sql(f"CREATE TABLE {name} (id BIGINT) USING parquet LOCATION '{folder}/in'")
    stream = catalog_stream(spark, name, files_per_batch=2).withColumn("twice", F.col("id") * 2)
    query = drain(stream, f"{folder}/p", f"{folder}/out", f"{name}_out")
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    assert spark.table(f"{name}_out").agg(F.sum("twice")).first()[0] == 2 * sum(range(50))
    spark.range(100, 103).coalesce(1).write.mode("append").insertInto(name)
    drain(catalog_stream(spark, name).withColumn("twice", F.col("id") * 2), f"{folder}/p", table=f"{name}_out")
    assert spark.table(f"{name}_out").count() == 53
    with pytest.raises(ValueError, match="path or a table"):
        drain(stream, f"{folder}/q")


def test_corpus_job_on_an_empty_landing(spark, folder):
    Landing(f"{folder}/land")
    corpus = CorpusJob(spark, f"{folder}/land", f"{folder}/home", parser, EMBEDDER, DIM)
    assert corpus.run().count() == 0
    Landing(f"{folder}/land").put("a.pdf", "now a file")
    assert [r.content for r in corpus.run().collect()] == ["now a file"]
