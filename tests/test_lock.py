"""The writer's lock: owner, renewal, takeover."""
import time
from concurrent.futures import ThreadPoolExecutor

import pytest

from herdflow.session import hadoop_fs, path_exists, scratch_path
from herdflow.sinks.master import LOCK, Lock, writing


@pytest.fixture
def folder(spark):
    path = scratch_path(spark, "t-lock")
    jvm, fs = hadoop_fs(spark, path)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(path))
    return path


def _age(spark, path, seconds):
    jvm, fs = hadoop_fs(spark, path)
    fs.setTimes(jvm.org.apache.hadoop.fs.Path(f"{path}/{LOCK}"), int((time.time() - seconds) * 1000), -1)


def test_second_writer_is_refused_and_first_keeps_its_lock(spark, folder):
    with writing(spark, folder) as first:
        with pytest.raises(RuntimeError, match="another run"), writing(spark, folder):
            pass
        assert first.held_by()[0] == first.owner
    assert not path_exists(spark, f"{folder}/{LOCK}")


def test_live_run_renews_its_lock(spark, folder):
    with writing(spark, folder, stale=2.0) as lock:
        time.sleep(3)
        assert lock.held_by()[1] < 2.0
        assert not Lock(spark, folder, stale=2.0).acquire()


def test_one_of_two_takes_a_stale_lock(spark, folder):
    dead = Lock(spark, folder)
    assert dead.acquire()
    _age(spark, folder, 1000)
    rivals = [Lock(spark, folder, stale=100) for _ in range(6)]
    with ThreadPoolExecutor(6) as pool:
        won = [r for r, got in zip(rivals, pool.map(Lock.acquire, rivals), strict=True) if got]
    assert len(won) == 1
    dead.release()                        # not its own any more
    assert not dead.renew()
    assert won[0].held_by()[0] == won[0].owner


def test_run_that_lost_its_lock_says_so(spark, folder):
    with pytest.raises(RuntimeError, match="lost"), writing(spark, folder):
        _age(spark, folder, 1000)
        assert Lock(spark, folder, stale=100).acquire()
    assert path_exists(spark, f"{folder}/{LOCK}")          # the other run's lock stays
