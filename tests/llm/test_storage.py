"""Tables of one piece of work are not deleted by another."""

import threading

from longtide.llm import exact_dedup, jaccard_join
from longtide.llm.storage import Scope, discard, discard_since, mark, materialise, scope

SF = "/root/testdata/sf0.001"


def test_scopes(spark):
    one, two = Scope(), Scope()
    with one:
        a = materialise(spark.range(3), "a")
        begun = mark()
        with two:
            b = materialise(spark.range(4), "b")
            discard_since(spark, frozenset())
            discard(a)  # another scope's
        c = materialise(spark.range(5), "c")
        d = materialise(spark.range(6), "d")
        discard_since(spark, begun, d)
    assert a.count() == 3 and d.count() == 6 and not two.folders and len(one.folders) == 2
    one.delete_unread(a)
    assert a.count() == 3 and len(one.folders) == 1
    one.close(spark)
    assert not one.folders and scope() is not one
    del b, c


def test_threads(spark):
    """Two operators side by side, each of which deletes what it no longer needs."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found, failed = {}, []

    def work(name, f):
        try:
            for _ in range(2):
                found[name] = f(docs).count()
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=work, args=a) for a in (("exact", exact_dedup.exact_groups), ("near", jaccard_join.near_groups), ("kept", jaccard_join.near_dedup))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and found["exact"] == found["near"] == docs.count() > found["kept"]


def test_two_runs(spark):
    """A result of the pipeline is as good as before after another run."""
    import corpus_pipeline

    a = corpus_pipeline.run(spark, SF)
    before = sorted(map(str, a.collect()))
    b = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, b.collect())) == before == sorted(map(str, a.collect()))
