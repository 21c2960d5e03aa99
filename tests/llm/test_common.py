from pathlib import Path

from oreflow.llm.common import cleared, shuffles_end_with_writes, stored

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_intermediates_are_cleared_and_the_setting_comes_back(spark):
    before = spark.conf.get(CLEANUP, None)
    with shuffles_end_with_writes(spark):
        assert spark.conf.get(CLEANUP) == "true"
        first = stored(spark.range(100).repartition(3, "id"), "first")
        second = stored(first.groupBy((first["id"] % 7).alias("k")).count(), "second")
    assert spark.conf.get(CLEANUP, None) == before
    place = first.inputFiles()[0].rsplit("/", 1)[0]
    cleared(spark, place, place)  # what is gone already does no harm
    assert not Path(place.removeprefix("file://")).exists() and second.count() == 7


def test_a_worker_gives_back_what_tasks_left():
    """Arrow's pool and unreachable objects, before a task of another kind begins."""
    import gc
    import weakref

    import pyarrow as pa

    from oreflow.llm import common, exact_dedup, mixing, ngram_join

    class Ring:
        pass

    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([1]), pa.array([b"a b"])], ["d", "t", "text"])
    texts = batch.select(["text"])
    tasks = [
        lambda: list(ngram_join._profiles(3)([batch])), lambda: list(ngram_join._entries(3, 90, frozenset())([texts])),
        lambda: list(exact_dedup._recipes(64)([batch.select(["d", "text"])])), lambda: list(mixing._word_counts([texts])),
        lambda: list(mixing._featured(mixing.Features([b"a"]))([batch.select(["d", "text"])])), lambda: common.kept(object(), list)]
    for task in tasks:
        ring = Ring()
        ring.itself, seen = ring, weakref.ref(ring)
        gc.disable()
        try:
            del ring
            assert seen() is not None
            task()
            assert seen() is None
        finally:
            gc.enable()
