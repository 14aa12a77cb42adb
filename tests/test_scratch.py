"""Written tables and the steps that delete them."""

import contextvars
import threading

import pytest

from heronry import scratch


def in_thread(f, context=None):
    """What ``f`` gives in another thread."""
    out = []
    t = threading.Thread(target=lambda: out.append(context.run(f) if context else f()))
    t.start()
    t.join()
    return out[0]


def test_a_step_leaves_what_other_threads_write(spark):
    with scratch.step(spark):
        own = scratch.written(spark.range(3), "own")
        other = in_thread(lambda: scratch.written(spark.range(5), "other"))
        last = scratch.written(spark.range(7), "last")
    assert other.count() == 5 and last.count() == 7
    with pytest.raises(Exception, match="FILE_NOT_EXIST|PATH_NOT_FOUND|does not exist"):
        own.count()


def test_a_step_takes_in_a_thread_that_runs_in_its_context(spark):
    with scratch.step(spark):
        handed = in_thread(lambda: scratch.written(spark.range(5), "handed"), contextvars.copy_context())
        last = scratch.written(spark.range(7), "last")
    assert last.count() == 7
    with pytest.raises(Exception, match="FILE_NOT_EXIST|PATH_NOT_FOUND|does not exist"):
        handed.count()


def test_steps_of_two_threads_at_once(spark):
    gate = threading.Barrier(2)

    def run(n):
        with scratch.step(spark):
            first = scratch.written(spark.range(n), "first")
            gate.wait(60)
            last = scratch.written(first.where("id > 0"), "last")
            gate.wait(60)
        return last

    found = []
    threads = [threading.Thread(target=lambda n=n: found.append((n, run(n)))) for n in (10, 20)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted((n, df.count()) for n, df in found) == [(10, 9), (20, 19)]


def test_a_folder_of_our_own_is_for_one_process_alone(spark, monkeypatch):
    class Cluster:
        master = "local-cluster[2,1,1024]"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Cluster

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.folder(Session)
