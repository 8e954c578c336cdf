import os
import subprocess
import sys
from pathlib import Path

from common import SF

SCRIPT = """
import sys
sys.path.insert(0, {home!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from quotelake.llm.fill_in_middle import op13_fill_in_middle
print("rows", op13_fill_in_middle(spark, {sf!r}).count())
spark.stop()
"""


def test_workers_get_the_package_wherever_the_driver_was_started(tmp_path):
    home = str(Path(__file__).resolve().parents[2])
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(home=home, sf=SF)], cwd=tmp_path, env=clean,
                          capture_output=True, text=True, timeout=300)
    assert "rows 200" in done.stdout, done.stderr[-2000:]
