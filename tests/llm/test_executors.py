"""The queries on workers that cannot import the package."""

import os
import subprocess
import sys

import pytest

from tests.conftest import ROOT

CODE = """
import sys
sys.path.insert(0, {root!r})
from ratingflow.session import local_session
import __spark_entry__ as entry
spark = local_session(cores=4, shuffle_partitions=4)
sf = "/root/testdata/sf0.001"

def importable(batches):
    import importlib.util
    import pyarrow as pa
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("ratingflow") is not None])], ["found"])

assert not spark.range(1).mapInArrow(importable, "found boolean").first().found
for name in {names!r}:
    print(name, entry.queries()[name](spark, sf).count(), flush=True)
"""


@pytest.mark.parametrize("names", [
    ["op1_simhash", "op2_urls", "op3_quality", "op4_toxicity", "op5_decontaminate", "op6_suffix_dedup", "op7_substring_dedup"],
    ["op8_langid", "op9_fingerprints", "op10_packing", "op11_warc", "op12_vector_codes", "op13_importance", "pipeline"]])
def test_workers_need_no_package(tmp_path, names):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT, names=names)], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    assert [x.split()[0] for x in done.stdout.splitlines() if x.split()[0] in names] == names
