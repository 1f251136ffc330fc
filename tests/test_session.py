"""Sessions without a preset checkpoint folder."""

import os
import subprocess
import sys

SCRIPT = """
import sys; sys.path.insert(0, '.')
from sluice.session import ensure_checkpoint_dir, local_session, scratch_path
{before}
spark = local_session(1)
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert ensure_checkpoint_dir(spark) == ensure_checkpoint_dir(spark)
path = scratch_path(spark, "t")
spark.range(3).write.parquet(path)
assert spark.read.parquet(path).count() == 3
spark.range(3).checkpoint().count()
print("root", ensure_checkpoint_dir(spark))
"""


def run(scratch, before=""):
    os.makedirs(f"{scratch}/conf")
    env = dict(os.environ, SPARK_CONF_DIR=f"{scratch}/conf")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(before=before)], cwd=root, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout.split("root ")[1].strip()


def test_default_folder_where_none_is_set(scratch):
    assert run(scratch) == "file:/tmp/sluice-checkpoints"


def test_folder_set_on_the_context(scratch):
    before = f"from pyspark import SparkContext, SparkConf\nSparkContext(conf=SparkConf().setMaster('local[1]').setAppName('t').set('spark.ui.enabled', 'false')).setCheckpointDir('{scratch}/own')"
    assert run(scratch, before).endswith(f"{scratch}/own")
